import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.operators import cellcover as CC
from camstat.operators import density as D
from camstat.operators import spatial as SP


def ring(spark, rings, zone="z"):
    return SP.polygon_edges(spark.createDataFrame([(zone, r, s, float(x), float(y)) for r, pts in enumerate(rings) for s, (x, y) in enumerate(pts)],
                                                  "zone string, ring int, seq int, x double, y double"))


def star(n, inner, outer, seed=0):
    rng = np.random.default_rng(seed)
    at = np.sort(rng.random(n)) * 2 * np.pi
    radius = rng.uniform(inner, outer, n)
    return list(zip(radius * np.cos(at), radius * np.sin(at)))


def test_same_zones_as_all_edges(spark):
    """Random polygons with holes, points at random and on vertices, edges and grid lines."""
    edges = ring(spark, [star(300, 1.5, 4.0), star(40, 0.3, 1.2, 1)], "a").union(ring(spark, [[(-2, -2), (3, -2), (3, 2.5), (-2, 2.5)]], "b")).union(
        ring(spark, [[(0, 0), (4, 0.5), (0.5, 4)]], "c"))
    rng = np.random.default_rng(2)
    pts = [(float(x), float(y)) for x, y in rng.uniform(-5, 5, (3000, 2))] + [(x / 2, y / 2) for x in range(-9, 10) for y in range(-9, 10)]
    pts += [(r["x1"], r["y1"]) for r in edges.limit(50).collect()] + [(None, 1.0)]
    p = spark.createDataFrame([(i, *xy) for i, xy in enumerate(pts)], "id long, lon double, lat double")
    want = sorted(map(tuple, SP.zone_of(p, edges, "id").select("id", "zone").collect()), key=repr)
    for most in (1, 8, 10_000):
        got = CC.locate(p, CC.cover(edges, 0.5, most)).select("id", "zone")
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_a_point_meets_few_edges(spark):
    """100,000 vertices: border cells are divided until they hold few of them."""
    edges = ring(spark, [star(100_000, 2.99, 3.0)])
    cells = CC.cover(edges, 0.5, 64).cache()
    per = cells.where("edge IS NOT NULL").groupBy("zone", "level", "i", "j").count()
    assert per.agg(F.max("count")).first()[0] <= 64
    assert cells.where("edge IS NULL").count() > 50
    p = spark.range(500).select("id", (F.rand(1) * 8 - 4).alias("lon"), (F.rand(2) * 8 - 4).alias("lat"))
    far = p.where("abs(sqrt(lon * lon + lat * lat) - 2.995) > 0.01")
    got = CC.locate(far, cells)
    assert got.where("(zone IS NOT NULL) <> (sqrt(lon * lon + lat * lat) < 2.995)").count() == 0


def test_empty_cover(spark):
    none = ring(spark, [[(0, 0), (1, 0), (1, 1)]]).limit(0)
    p = spark.createDataFrame([(1, 0.5, 0.5)], "id long, lon double, lat double")
    assert CC.locate(p, CC.cover(none)).first()["zone"] is None


def test_violin_against_the_plain_kernel(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(5, 2, 400), "b": rng.exponential(1, 150), "c": np.full(5, 7.0), None: rng.random(30)}
    df = spark.createDataFrame([(g, float(v)) for g, own in values.items() for v in own] + [("a", None)], "g string, v double")
    got = D.violin(df, "v", ["g"], nodes=128).toPandas()
    for g, own in values.items():
        mine = got[got.g.isna() if g is None else got.g == g].sort_values("node")
        assert len(mine) == 128 and (mine["n"] == len(own)).all() and mine["width"].max() == pytest.approx(1.0)
        sd, iqr = own.std(ddof=1), np.subtract(*np.percentile(own, [75, 25])) / 1.34
        h = 0.9 * (min(sd, iqr) if sd and iqr else 1.0) * len(own) ** -0.2
        assert mine["bandwidth"].iloc[0] == pytest.approx(h)
        if g != "c":
            plain = np.exp(-((mine["value"].to_numpy()[:, None] - own[None]) / h) ** 2 / 2).sum(1) / (len(own) * h * math.sqrt(2 * math.pi))
            assert np.abs(mine["density"] - plain).max() < 0.01 * plain.max()


def test_density_map_against_the_plain_kernel(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(0, 1, 200), rng.normal(1, 0.5, 200)
    df = spark.createDataFrame([("s", float(a), float(b)) for a, b in zip(x, y)] + [("t", 0.0, 0.0), ("s", None, 1.0)], "g string, x double, y double")
    got = D.density_map(df, "x", "y", ["g"], -4, 4, -1, 3, 21).toPandas()
    assert set(got["g"]) == {"s"} and len(got) == 441  # one point has no spread
    h = [1.06 * min(v.std(ddof=1), np.subtract(*np.percentile(v, [75, 25])) / 1.34) * 200 ** -0.2 for v in (x, y)]
    plain = np.array([(np.exp(-((r.x - x) / h[0]) ** 2 / 2 - ((r.y - y) / h[1]) ** 2 / 2)).sum() / (200 * 2 * math.pi * h[0] * h[1]) for r in got.itertuples()])
    assert np.abs(got["density"] - plain).max() < 1e-9
    order = np.argsort(-plain)
    assert np.abs(got["mass"].to_numpy()[order] - plain[order].cumsum() / plain.sum()).max() < 1e-6
