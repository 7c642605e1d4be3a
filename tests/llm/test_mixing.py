import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from camstat.llm import mixing, queries
from tests.llm.helpers import SF, docs, duck, same


def test_query_against_sql(spark):
    same(queries.op4_mix(spark, SF).toPandas(), duck(queries.ORACLES["op4_mix"]))


def skewed(spark):
    """One source with most of the rows."""
    return spark.range(600).select(
        F.col("id").alias("doc_id"), F.expr("CASE WHEN id < 500 THEN 'big' WHEN id < 580 THEN 'mid' ELSE 'small' END").alias("source"),
        F.expr("repeat('w ', cast(id % 7 as int))").alias("text"))


def test_repeat_target(spark):
    df = skewed(spark)
    out = mixing.mix(df, mixing.Target(repeat=3.0), block_tokens=500).toPandas()
    total = df.select("source", mixing.words(F.col("text")).alias("n")).groupBy("source").sum("n").toPandas().set_index("source")["sum(n)"]
    passes = out.groupby("source").n_tokens.sum() / total
    assert passes.max() <= 3.01 and passes.max() > 2.9 and passes["big"] == 1
    assert out.doc_id.nunique() == 600
    # every block holds its share of each source, up to one row
    n_blocks = out.block.max() + 1
    per = out.groupby(["source", "block"]).n_tokens.sum().unstack(fill_value=0)
    for s in per.index:
        share = -(-int(round(passes[s] * total[s])) // n_blocks)
        assert (abs(per.loc[s].iloc[:-1] - share) <= 14).all()
    for _, g in out.groupby("block"):
        assert sorted(g.slot) == list(range(len(g)))
    # each epoch is a permutation of its own
    first = [out[(out.source == "small") & (out.epoch == e)].sort_values(["block", "slot"]).doc_id.tolist() for e in (0, 1)]
    assert sorted(first[0]) == sorted(first[1]) and first[0] != first[1]


def test_many_cells_equal_one(spark, monkeypatch):
    one = mixing.mix(skewed(spark), mixing.Target(repeat=2.0), block_tokens=300).toPandas()
    monkeypatch.setattr(mixing, "MIN_CELLS", 1)
    same(one, mixing.mix(skewed(spark), mixing.Target(repeat=2.0), block_tokens=300).toPandas())


@pytest.mark.parametrize("entropy", [0.3, 0.8, 1.05])
def test_entropy_target(spark, entropy):
    shares = [0.7, 0.2, 0.1]
    a = mixing.exponent(spark.createDataFrame([(s,) for s in shares], "share double"), mixing.Target(entropy=entropy))
    w = [s**a for s in shares]
    h = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    assert h == pytest.approx(entropy, abs=1e-5)


def test_budget(spark):
    out = mixing.mix(skewed(spark), mixing.Target(repeat=1.0), budget=700, block_tokens=100).toPandas()
    assert 640 <= out.n_tokens.sum() <= 740 and out.epoch.max() == 0


def test_edge_cases(spark):
    out = mixing.mix(docs(spark), mixing.Target(repeat=2.0)).toPandas()
    assert set(out.columns) == {"doc_id", "source", "n_tokens", "epoch", "block", "slot"}
    first = out[out.epoch == 0]
    assert len(first) == 10  # the repeated row is one document
    assert (out.n_tokens >= 1).all()
    assert mixing.mix(docs(spark, []), mixing.Target(repeat=2.0)).count() == 0
    assert mixing.mix(docs(spark, []), mixing.Target(entropy=1.0)).count() == 0


def test_texts_without_ids_all_count(spark):
    """Rows of equal word counts without an id, or with a shared one, differ by their texts."""
    rows = [(None, f"text number{i}", "hot") for i in range(90)] + [(4, f"other number{i}", "hot") for i in range(10)]
    rows += [(i, f"cold text{i}", "cold") for i in range(100)] + [(None, "text number0", "hot")]
    df = docs(spark, rows)
    out = mixing.mix(df, mixing.Target(repeat=2.0)).toPandas()
    first = out[out.epoch == 0].groupby("source").n_tokens.agg(["count", "sum"])
    assert first.loc["hot"].tolist() == [100, 200] and first.loc["cold"].tolist() == [100, 200]
    mixed = pipeline.mixing_stage(spark, df, SF)
    assert {r["text"] for r in mixed.select("text").collect()} == {t for _, t, _ in rows}
    assert mixed.count() == len(out)
