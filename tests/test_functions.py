"""Scalar expressions: ids, paths, names, time, geometry, colour, arrays."""

import math

from pyspark.sql import functions as F

from camstat.functions import geometry as G
from camstat.functions import ids as I
from camstat.functions import textfn as X
from camstat.functions import timefn as Tm
from camstat.functions.colour import hue_degrees
from camstat.functions.stats import argmax, softmax


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("v")).collect()


def test_image_and_camera_ids(spark):
    rows = one(spark, I.image_id("id"), [("a_b_c_d_e_f",), ("a_b",), ("abc",)], "id string")
    assert [r.v for r in rows] == ["a_b_c_d_e", "a", "abc"]
    rows = one(spark, I.camera_id("id"), [("P901-1_CAM-1_DCIM_100RECNX_RCNX0001_1",), ("4711",)], "id string")
    assert [r.v for r in rows] == ["CAM-1", None]
    assert [r.v for r in one(spark, I.plot_id("id"), [("INTC02_x",)], "id string")] == ["INTC"]
    assert [r.v for r in one(spark, I.first_tokens("id", 5), [("a_b_c_d_e_f",)], "id string")] == ["a_b_c_d_e"]


def test_manual_and_numeric(spark):
    ids = [("P1_CAM_x_M1",), ("P1_MCAM_x_1",), ("4711",), ("INTC01_x",)]
    assert [r.v for r in one(spark, I.is_manual("id"), ids, "id string")] == [True, True, False, False]
    assert [r.v for r in one(spark, I.is_manual("id", strict=True), ids, "id string")] == [True, False, False, False]
    assert [r.v for r in one(spark, I.is_numeric_id("id"), ids, "id string")] == [False, False, True, False]
    assert [r.v for r in one(spark, I.is_numeric_id("id", "letters"), ids, "id string")] == [False, False, True, True]


def test_standard_image_name_nonwildlife(spark):
    df = spark.createDataFrame([("NonWildlife/DCIM/100RECNX/RCNX0001.JPG", "2022:08:19 10:11:12"),
                                ("Wildlife/DCIM/101RECNX/RCNX0002.jpg", "2022:08:19 10:11:13")], "p string, t string")
    name = I.standard_image_name("p", "t", F.lit("D1"), F.lit("P901"))
    out = df.select("p", name.alias("n")).withColumn("s", I.standard_sub_folder("p", "n", F.lit("D1"), F.lit("P901")))
    r = out.collect()
    assert r[0].n == "D1_P901_NW_100_0001_2022_08_19_10_11_12.JPG"
    assert r[0].s == "D1_P901_NW_100_NW"
    assert r[1].n == "D1_P901_W_101_0002_2022_08_19_10_11_13.JPG"
    assert r[1].s == "D1_P901_W_101_W"


def test_paths_and_text(spark):
    r = spark.createDataFrame([("a/b/c.JPG",)], "p string").select(
        I.basename("p").alias("b"), I.dirname("p").alias("d"),
        X.remove_first("p", "/", fixed=True).alias("r1"), X.replace_all("p", "/", "_", fixed=True).alias("ra"),
        I.crop_name(F.lit("Red fox. sp"), F.lit("id1")).alias("c")).first()
    assert (r.b, r.d, r.r1, r.ra) == ("c.JPG", "a/b", "ab/c.JPG", "a_b_c.JPG")
    assert r.c == "Red_fox_sp_id1.JPG"
    net = spark.createDataFrame([("srv\\share\\a\\b\\c",), ("plain",)], "p string").select(
        I.network_root("p").alias("root"), I.network_path("p").alias("path")).collect()
    assert (net[0].root, net[0].path) == ("share", "a/b/c")
    assert (net[1].root, net[1].path) == (None, None)


def test_time_keys(spark):
    df = spark.createDataFrame([("2022:08:19 13:31:46",)], "t string").withColumn("ts", Tm.parse_capture_time("t"))
    r = Tm.with_date_keys(df, "ts").withColumn("sec", Tm.seconds_of_day("ts")).first()
    assert (r.year, r.month, r.day, r.ymd, r.sec) == (2022, "Aug", 19, "2022_Aug_19", 13 * 3600 + 31 * 60 + 46)
    g = spark.createDataFrame([("2022-03-01", None), ("2022-03-01", "2022-10-05")], "a string, b string").select(
        Tm.deployment_group(F.to_date("a"), F.to_date("b")).alias("g")).collect()
    assert [x.g for x in g] == ["Mar 2022", "Mar 2022 - Oct 2022"]


def test_iou_cases(spark):
    rows = [(0.0, 0.0, 2.0, 2.0, 0.0, 0.0, 2.0, 2.0), (0.0, 0.0, 1.0, 1.0, 5.0, 5.0, 1.0, 1.0),
            (0.0, 0.0, 2.0, 2.0, 1.0, 0.0, 2.0, 2.0)]
    v = one(spark, G.iou("ax", "ay", "aw", "ah", "bx", "by", "bw", "bh"), rows,
            "ax double, ay double, aw double, ah double, bx double, by double, bw double, bh double")
    assert [round(r.v, 9) for r in v] == [1.0, 0.0, round(1 / 3, 9)]


def test_haversine_one_degree(spark):
    v = one(spark, G.haversine_km("a", "b", "c", "d"), [(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    assert abs(v[0].v - 111.195) < 1e-3


def test_hue_and_softmax(spark):
    v = one(spark, hue_degrees("r", "g", "b"), [(255, 0, 0), (0, 255, 0), (0, 0, 255), (10, 10, 10)],
            "r int, g int, b int")
    assert [r.v for r in v] == [0.0, 120.0, 240.0, 0.0]
    r = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "a array<double>").select(
        softmax("a").alias("s"), argmax("a").alias("m")).first()
    assert abs(sum(r.s) - 1) < 1e-12 and r.m == 1
    e = [math.exp(x - 3) for x in (1, 3, 3, 0)]
    assert abs(r.s[1] - e[1] / sum(e)) < 1e-12
