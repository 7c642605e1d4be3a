"""Small operators not exercised by the query plans."""

import numpy as np
from pyspark.sql import functions as F

from camstat.operators import filters as O
from camstat.operators import images as IM
from camstat.operators import joins as J
from camstat.operators import quality as Q
from camstat.operators import reshape as R


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, None)], "a int, b_id int, c int, d_id int, to_name string")
    assert O.select_range(df, "b_id", "d_id").columns == ["b_id", "c", "d_id"]
    assert O.select_suffix(df, "_id", keep=["a"]).columns == ["a", "b_id", "d_id"]
    assert O.relocate(df, ["c"]).columns[0] == "c"
    assert O.rename(df, {"a": "x"}).columns[0] == "x"
    assert O.non_empty(df).count() == 0
    assert O.clean_names(spark.createDataFrame([(1, 2)], "`DateTimeOriginal` int, `Source File` int")).columns == [
        "date_time_original", "source_file"]


def test_nest_unnest_and_bind(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 3)], "source_file string, v int")
    n = R.nest(df, ["source_file"])
    assert {r.source_file: r.nr for r in n.collect()} == {"f1": 2, "f2": 1}
    assert sorted(r.v for r in R.unnest(n).collect()) == [1, 2, 3]
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(1, "y")], "k int, b string")
    assert J.bind_by_key(a, b, "k").first().b == "y"


def test_split_write(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "g string, v int")
    R.split_write(df, ["g"], str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.name.startswith("g=")) == ["g=a", "g=b"]


def test_quality_checks(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(r.k for r in Q.expect_same_keys(a, b, "k").collect()) == [1, 3]
    assert Q.expect_rows_match_folders(a, a, "k").count() == 0
    dep = spark.createDataFrame([(1,), (1,), (2,)], "camera_id int")
    assert Q.expect_unique(dep, ["camera_id"]).count() == 1
    try:
        Q.assert_empty(Q.expect_unique(dep, ["camera_id"]), "Q4")
        raise AssertionError("should fail")
    except Q.QualityError:
        pass
    ok = Q.expect_join_conserves(a, a.join(b, "k", "left"))
    Q.assert_ok(ok, "Q1")


def test_crop_manifest_and_pixels(spark, tmp_path):
    from tests.test_sources import _png
    d = tmp_path / "imgs"
    d.mkdir()
    _png(d / "a.png", 10, 8, (10, 20, 30))
    img = IM.read_pixels(spark, str(d))
    path = img.first().path
    anns = spark.createDataFrame([("P1_C_x_1", "Moose", path, 10.0, 8.0, 20.0, 25.0, 50.0, 50.0),
                                  ("P1_C_x_2", "Human", path, 10.0, 8.0, 0.0, 0.0, 10.0, 10.0)],
                                 "id string, species string, path string, original_width double, original_height double,"
                                 " value_x double, value_y double, value_width double, value_height double")
    m = IM.crop_manifest(anns)
    r = {x.id: x for x in m.collect()}
    assert (r["P1_C_x_1"].px_x, r["P1_C_x_1"].px_y, r["P1_C_x_1"].px_w, r["P1_C_x_1"].px_h) == (2, 2, 5, 4)
    assert r["P1_C_x_2"].crop_name is None
    crops = IM.crop_pixels(img, m).collect()
    assert len(crops) == 1 and (crops[0].crop_w, crops[0].crop_h) == (5, 4)
    px = np.frombuffer(crops[0].crop, dtype=np.uint8).reshape(4, 5, 3)
    assert (px[..., 2] == 10).all() and (px[..., 0] == 30).all()


def test_one_hot_groups_and_add_rows(spark):
    from camstat.operators import aggregates as A
    df = spark.createDataFrame([(1, "Moose"), (2, "Red fox"), (3, "Lynx")], "id int, species string")
    groups = spark.createDataFrame([("Moose", "ungulate"), ("Red fox", "carnivore")], "species string, grp string")
    out = {r.id: (r.ungulate, r.carnivore) for r in A.one_hot_groups(df, groups, ["id"], "species", "grp",
                                                                        ["ungulate", "carnivore"]).collect()}
    assert out == {1: (1, 0), 2: (0, 1), 3: (0, 0)}
    assert R.add_rows(df, [(4, "Wolf")]).count() == 4


def test_small_helpers(spark):
    from camstat.functions import ids as I
    from camstat.functions import textfn as X
    from camstat.functions import timefn as Tm
    from camstat.operators import aggregates as A
    from camstat.operators import metrics as M
    from camstat.operators import spatial as SP
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    d = spark.createDataFrame([(None, "N"), ("x", "X")], "t string, lab string")
    assert sorted((r.k, r.lab) for r in J.join_on(a, d, "s", "t", null_safe=True).collect()) == [(1, "N"), (2, "X")]
    assert J.semi(a, d.withColumnRenamed("t", "s"), "s").count() == 1
    assert J.anti(a, d.withColumnRenamed("t", "s"), "s").count() == 1
    assert R.union_strict(a, a).count() == 4
    assert [r.s for r in R.sort_nulls_last(a, ["s"], [True]).collect()] == ["x", None]
    g = SP.grid_points(spark.createDataFrame([(0.6, 1.9), (5.0, 1.0)], "lon double, lat double"), 0.0, 1.0, 0.0, 2.0, 0.5)
    assert [(r.gx, r.gy, r.x_node, r.y_node) for r in g.collect()] == [(1, 3, 0.75, 1.75), (None,) * 4]
    assert O.fill0(spark.createDataFrame([(None,)], "v int")).first().v == 0
    assert A.n_distinct(a, "k").first().n == 2 and A.n_distinct_approx(a, "k").first().n == 2
    f = M.folds(spark.range(100), "id", 10).groupBy("fold").count().collect()
    assert len(f) == 10 and sum(r["count"] for r in f) == 100
    r = spark.createDataFrame([("12", 1, 3, "2022-08-19")], "i string, n int, m int, t string").select(
        I.numeric_value("i").alias("v"), X.pct2("n", "m").alias("p"), Tm.month_label(F.to_date("t")).alias("mo")).first()
    assert (r.v, r.p, r.mo) == (12, 33.33, "Aug")
