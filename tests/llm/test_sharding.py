import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.llm import queries, sharding
from tests.llm.helpers import SF, docs


def brute(rows, n_shards, cells):
    """rows: (source, hash, key) -> (shard, slot) for each, by ranks and one sort."""
    by = {}
    for k, (s, h, key) in enumerate(rows):
        by.setdefault("n" if s is None else "s" + s, []).append((h, (key is not None, key or 0), k))
    order = []
    for s, own in by.items():
        for r, (h, key, k) in enumerate(sorted(own), 1):
            order.append(((2 * r - 1) * cells // (2 * len(own)), (2 * r - 1) / (2 * len(own)), s, h, key, k))
    out, n = {}, len(rows)
    for pos, x in enumerate(sorted(order)):
        shard = pos * n_shards // n
        out[x[-1]] = (shard, pos - -(-shard * n // n_shards))
    return [out[k] for k in range(n)]


@pytest.mark.parametrize("cell_rows", [1, 7, 20_000])
def test_against_brute_force(spark, cell_rows, monkeypatch):
    monkeypatch.setattr(sharding, "MIN_CELLS", 3)
    df = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 11 == 0, None).otherwise(F.col("source")).alias("source"))
    got = sharding.interleave(df, 7, cell_rows=cell_rows).withColumn(
        "h", F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id"), 1)).collect()
    cells = max(3, -(-len(got) // cell_rows))
    want = brute([(r["source"], r["h"], r["doc_id"]) for r in got], 7, cells)
    assert [(r["shard"], r["slot"]) for r in got] == want


def test_edge_cases(spark):
    got = sharding.interleave(docs(spark), 4).toPandas()
    assert len(got) == 11 and sorted(got.groupby("shard").size()) == [2, 3, 3, 3]
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert set(got.columns) == {"doc_id", "text", "source", "fp", "key", "shard", "slot"}
    assert sharding.interleave(docs(spark, []), 4).count() == 0
    assert sharding.interleave(docs(spark), 100).select("shard").distinct().count() == 11


def test_query(spark):
    df = queries.op9_shard(spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got = df.toPandas()
    n = got.groupby("shard").size()
    assert n.max() - n.min() <= 1 and got.doc_id.is_unique
    per = got.groupby(["source", "shard"]).size().unstack(fill_value=0)
    share = got.groupby("source").size().to_numpy()[:, None] / 24
    assert (np.abs(per.reindex(columns=range(24), fill_value=0).to_numpy() - share) <= 1.5).all()
