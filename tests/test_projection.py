import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.functions import projection as P
from camstat.operators import coverage as CV


def points(spark, rows):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rows)], "id long, a double, b double")


def run(spark, pair, rows):
    x, y = pair(F.col("a"), F.col("b"))
    return [(r["x"], r["y"]) for r in points(spark, rows).select("id", x.alias("x"), y.alias("y")).orderBy("id").collect()]


def test_known_points_of_transverse_mercator(spark):
    # Ordnance Survey worked example (Airy 1830) and the meridian arc of 45 degrees
    britain = P.TransverseMercator(-2.0, 49.0, 0.9996012717, 400_000.0, -100_000.0, P.Ellipsoid(6377563.396, 1 / 299.32496))
    (e, n), = run(spark, britain.forward, [(0.5, 50.5)])
    assert e == pytest.approx(577274.99, abs=0.01) and n == pytest.approx(69740.50, abs=0.01)
    (e, n), (e0, n0) = run(spark, P.utm(17).forward, [(-81.0, 45.0), (-81.0, 0.0)])
    assert (e, e0, n0) == pytest.approx((500_000, 500_000, 0), abs=1e-6) and n == pytest.approx(0.9996 * 4984944.378, abs=0.001)


def test_known_point_of_lambert_conic(spark):
    # worked example for Texas South Central (NAD27), in US survey feet
    texas = P.LambertConic(-99.0, 27 + 5 / 6, 28 + 23 / 60, 30 + 17 / 60, 2_000_000.0, 0.0, P.Ellipsoid(20925832.16, 1 / 294.97870))
    (e, n), = run(spark, texas.forward, [(-96.0, 28.5)])
    assert e == pytest.approx(2963503.91, abs=0.01) and n == pytest.approx(254759.80, abs=0.01)


@pytest.mark.parametrize("projection", [P.utm(16), P.utm(17), P.CANADA_ATLAS, P.STATISTICS_CANADA, P.utm(33, north=False),
                                        P.LambertConic(10.0, -40.0, -30.0, -50.0), P.LambertConic(0.0, 46.5, 46.5, 46.5)])
def test_round_trip_under_a_millimetre(spark, projection):
    rng = np.random.default_rng(5)
    lat = (-60, 0) if getattr(projection, "lat1", 1) < 0 or projection.north0 == 10_000_000 else (0, 75)
    rows = [(projection.lon0 + a, b) for a, b in zip(rng.uniform(-12, 12, 200), rng.uniform(*lat, 200))]
    there = run(spark, projection.forward, rows)
    back = run(spark, projection.inverse, there)
    for (lon, la), (lon2, la2) in zip(rows, back):
        assert abs(la - la2) * 111_000 < 1e-3 and abs(lon - lon2) * 111_000 < 1e-3


def test_conformal_scale_on_the_standard_parallels(spark):
    step = 1e-5
    a, b = run(spark, P.CANADA_ATLAS.forward, [(-90.0, 49.0), (-90.0 + step, 49.0)])
    nu = P.GRS80.a / math.sqrt(1 - P.GRS80.f * (2 - P.GRS80.f) * math.sin(math.radians(49)) ** 2)
    assert math.dist(a, b) == pytest.approx(nu * math.cos(math.radians(49)) * math.radians(step), rel=1e-6)


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None, 50.0)], "a double, b double")
    for p in (P.utm(16), P.CANADA_ATLAS):
        for pair in (p.forward, p.inverse):
            x, y = pair(F.col("a"), F.col("b"))
            assert df.select((x + y).alias("s")).first()["s"] is None


def test_fractions_sum_to_the_circle(spark):
    """Over a full lattice the covered areas sum to the area of each circle."""
    size, r = 30.0, 100.0
    cells = spark.range(1600).select(((F.col("id") % 40) * size - 600 + 15).alias("cx"), (F.floor(F.col("id") / 40) * size - 600 + 15).alias("cy"))
    rng = np.random.default_rng(6)
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in rng.uniform(-300, 300, (60, 2))] + [(0.0, 0.0), (15.0, 15.0), (-30.0, 45.0), (0.0, 0.0), (None, 1.0)], "px double, py double")
    got = CV.cover_fractions(pts, cells, r, size).collect()
    assert len(got) == 63
    assert all(g["fraction"] * size * size == pytest.approx(math.pi * r * r, rel=1e-9) for g in got)


@pytest.mark.parametrize("r, size", [(10.0, 3.0), (2.0, 7.0)])
def test_fraction_against_counting(spark, r, size):
    cells = spark.createDataFrame([(i * size, j * size, (i + j) % 3) for i in range(-5, 6) for j in range(-5, 6)], "cx double, cy double, value int")
    pts = spark.createDataFrame([(0.4, 0.9), (1.7, -2.2)], "px double, py double")
    got = {(g["px"], g["py"], g["value"]): g["fraction"] for g in CV.cover_fractions(pts, cells, r, size, by=["value"]).collect()}
    at = (np.arange(400) + 0.5) / 400 - 0.5
    for px, py in ((0.4, 0.9), (1.7, -2.2)):
        want = {}
        for c in cells.collect():
            inside = ((c["cx"] + at * size - px)[:, None] ** 2 + (c["cy"] + at * size - py)[None] ** 2 <= r * r).mean()
            want[c["value"]] = want.get(c["value"], 0) + inside
        for v, f in want.items():
            assert got.get((px, py, v), 0) == pytest.approx(f, abs=2e-3)
