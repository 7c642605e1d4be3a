import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from camstat.llm import mixing, queries, secretscan
from camstat.llm.common import written
from pyspark.sql import functions as F
from tests.llm.helpers import SF, WORD_BPE, docs, same
from tests.llm.test_simhash import brute, fingerprint


def run(spark, df, sf_dir):
    """Each stage's input and output, written and read again."""
    out = [df]
    for _, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), "test-stage"))
    return out


def test_names():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [k for k, _ in pipeline.STAGES] == ["toxicity", "simhash_dedup", "secrets", "mixing", "bpe"]
    assert set(entry.oracle_sql()) <= set(names)


def test_against_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    start, clean, unique, redacted, mixed, ids = run(spark, source, SF)
    score = {r["doc_id"]: r["predicted"] for r in queries.op8_toxicity(spark, SF).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, p in score.items() if not p}
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    comp = brute({d: (d, fingerprint(t)) for d, t in texts.items()})
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({c for c in comp.values()})
    names = " ".join(reversed(secretscan.identifiers(unique))).encode()
    before = {r["doc_id"]: r for r in unique.collect()}
    for r in redacted.collect():
        old = before.pop(r["doc_id"])
        assert (r["text"] == old["text"]) == (not secretscan.spans(old["text"], names))
        assert r["n_chars"] == (len(r["text"]) if r["text"] != old["text"] else old["n_chars"])
        assert not secretscan.base_spans(r["text"])
    assert not before
    plan = mixing.mix(redacted, mixing.Target(repeat=queries.REPEAT)).groupBy("doc_id").count().toPandas()
    same(mixed.groupBy("doc_id").count().toPandas(), plan)
    assert mixed.select("doc_id").distinct().count() == redacted.count()
    for df in (clean, unique, redacted, mixed):
        assert df.columns == source.columns
    library = Tokenizer.from_file(WORD_BPE)
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in redacted.collect()}
    got = ids.collect()
    assert len(got) == mixed.count()
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]] and r["n_tokens"] == len(want[r["doc_id"]]) for r in got)
    same(pipeline.run(spark, SF).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("s")).toPandas(),
         ids.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("s")).toPandas())


def test_edge_cases(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    start, clean, unique, redacted, mixed, ids = run(spark, docs(spark), str(tmp_path))
    assert clean.count() == 11
    got = unique.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(["1", "3", "6", "7", "8", "9", "None"])
    assert unique.columns == start.columns
    assert redacted.count() == 7 and mixed.select("doc_id").distinct().count() == 7
    assert ids.count() == mixed.count() and {"fp", "key", "shard", "ids", "n_tokens"} <= set(ids.columns)
    empty = run(spark, docs(spark, []), str(tmp_path))
    assert [x.count() for x in empty] == [0] * 6


def test_group_of_null_ids(spark):
    rows = [(None, "same words in these rows here", "a"), (None, "same words in these rows here", "a"), (3, "other", None), (3, "other", None)]
    got = pipeline.simhash_stage(spark, docs(spark, rows), SF).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "None"]


def test_null_and_repeated_ids_keep_their_groups(spark):
    """Unrelated rows without an id, and an id with two texts of which one is a near copy, all stay once."""
    words = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    rows = [(None, words[0], "a"), (None, words[1], "a"), (None, words[1], "b"), (None, words[2], None),
            (5, words[3], "a"), (5, words[4], "a"), (2, words[3], "a"), (7, words[5], "a"), (7, words[5], "a")]
    got = pipeline.simhash_stage(spark, docs(spark, rows), SF).collect()
    want = [(None, words[0]), (None, words[1]), (None, words[2]), (2, words[3]), (5, words[4]), (7, words[5])]
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(d), t) for d, t in want)


@pytest.mark.parametrize("name", [n for n in sorted(queries.ORACLES)])
def test_oracles_are_registered(name):
    assert name in entry.queries() and name in entry.oracle_sql()
