"""Null keys, rows with payload, awkward files, and groups that one task must not hold."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.functions import ids as I
from camstat.operators import aggregates as A
from camstat.operators import images as IM
from camstat.operators import joins as J
from camstat.operators import metrics as M
from camstat.operators import repeats as RP
from camstat.operators import reshape as R
from camstat.operators import spatial as SP
from camstat.operators import stats as ST
from camstat.operators import windows as W
from camstat.operators.reconcile import process_annotations, reconcile, tag_projects
from camstat.schemas import TASK_SCHEMA
from camstat.sources import readers as RD


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_sequence_over_wide_rows(spark, reuse):
    """Ids 1..n exactly once when rows carry other columns, whatever exchanges are reused."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 300_000
        df = spark.range(n).select(
            "id", (F.col("id") * 7919 % 1000).alias("k"), F.md5(F.col("id").cast("string")).alias("payload"),
            F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 7, F.lit(None)).otherwise("cold").alias("g"))
        s = W.seq_id(df, ["k", "id"], partitions=13)
        assert s.agg(F.count_distinct("seq"), F.min("seq"), F.max("seq"), F.count("*")).first() == (n, 1, n, n)
        by = W.seq_id(df, ["k", "id"], partitions=13, by=["g"]).groupBy("g").agg(
            F.count("*").alias("n"), F.count_distinct("seq").alias("d"), F.max("seq").alias("m")).collect()
        assert {r["g"]: (r["n"], r["d"], r["m"]) for r in by} == {
            "hot": (210_000,) * 3, None: (30_000,) * 3, "cold": (60_000,) * 3}
        h = W.halves(df, ["k", "id"]).groupBy("half").count().collect()
        assert {r["half"]: r["count"] for r in h} == {1: n // 2, 2: n // 2}
        assert R.drop_position(df, ["k", "id"], 5).count() == n - 1
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_split_keeps_null_class_and_payload(spark):
    df = spark.range(100).select("id", F.when(F.col("id") >= 25, F.col("id") % 3).alias("c"), F.md5(F.col("id").cast("string")).alias("p"))
    s = M.split_stratified(df, "c", "id", 0.2, 3)
    got = {(r["c"], r["split"]): r["count"] for r in s.groupBy("c", "split").count().collect()}
    assert s.count() == 100 and got[(None, "eval")] == 5 and all(got[(c, "eval")] == 5 for c in range(3))


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("b", 5.0), ("b", 7.0)], "k string, v double")
    assert {(r["k"], r["t"]) for r in W.with_totals(df, ["k"], {"t": F.sum("v")}).collect()} == {(None, 4.0), ("a", 2.0), ("b", 12.0)}
    assert sorted(str(r["k"]) for r in A.get_dupes(df, ["k"]).collect()) == ["None", "None", "b", "b"]
    assert {r["k"]: r["q0"] for r in A.quantiles(df, "v", [0.5], ["k"]).collect()} == {None: 2.0, "a": 2.0, "b": 6.0}
    assert {r["k"]: r["n"] for r in A.box_stats(df, "v", ["k"]).collect()} == {None: 2, "a": 1, "b": 2}
    assert SP.hellinger(df, "k", "v", "v").count() == 5
    assert {r["k"] for r in ST.anova(df.withColumn("g", F.col("v") > 2), "v", "g", by=["k"]).collect()} == {None, "a", "b"}
    t = df.withColumn("ts", F.timestamp_seconds(F.col("v") * 3600))
    assert {(r["k"], r["session"]) for r in W.sessionize(t, ["k"], "ts", 1800).collect()} == {(None, 1), (None, 2), ("a", 1), ("b", 1), ("b", 2)}
    assert tag_projects(spark.createDataFrame([("x/P1_a.csv",), (None,)], "file string")).count() == 2


def test_reconcile_keeps_rows_without_file(spark):
    rows = [(None, 1, "P1_C_x_1", "Moose"), (None, 2, "P1_C_x_1", "Moose"), ("f", 1, "99999999999999999999", None), ("f", 2, "100000000000000000000", None)]
    kept, conflicts = reconcile(spark.createDataFrame(rows, "source_file string, orig int, id string, species string"))
    assert {(r["source_file"], r["id"], r["rule"]) for r in kept.collect()} == {(None, "P1_C_x_1", "D1"), ("f", "99999999999999999999", "D2")}
    assert conflicts.count() == 0


def test_projects_with_one_two_and_three_files(spark):
    rows = [(f"T_P{p}_{e}.csv", f"i{p}", f"P{p}_C_x_1", "Moose") for p, n in ((1, 1), (2, 2), (3, 3)) for e in range(n)]
    out, conflicts = process_annotations(spark.createDataFrame(rows, "file string, source_file string, id string, species string"))
    assert sorted(r["id"] for r in out.collect()) == ["P1_C_x_1", "P2_C_x_1"]
    assert conflicts.count() == 3


def test_numeric_ids_of_any_length(spark):
    ids = ["0", "-3", "+7", "007", "9223372036854775808", "12345678901234567890123456789012345678901", "P1", "1.5", "", "-20"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("num", I.is_numeric_id("id"))
    got = [r["id"] for r in df.filter("num").orderBy(I.numeric_order("id"), "id").collect()]
    assert got == ["-20", "-3", "0", "+7", "007", "9223372036854775808", "12345678901234567890123456789012345678901"]
    assert df.filter("num").select(I.numeric_value("id").alias("v")).filter("v IS NULL").count() == 2


def test_latency_keeps_null_species(spark):
    obs = spark.createDataFrame([(c, s, f"2022-01-0{d}") for c in range(4) for s in ("a", None) for d in (1, 3)],
                                "camera_id int, species string, ymd string").withColumn("date_time", F.to_timestamp("ymd"))
    cams = obs.groupBy("camera_id").agg(F.min("date_time").alias("camera_first_day"))
    got = A.detection_latency(obs, cams).collect()
    assert len(got) == 8 and all(r["total_events"] == 8 and r["n_cameras"] == 4 for r in got)


def test_points_that_share_a_key_or_position(spark):
    edges = SP.polygon_edges(SP.literal_polygons(spark, {"Z": [[(0, 0), (10, 0), (10, 10), (0, 10)]]}))
    pts = spark.createDataFrame([(1, 2.0, 2.0), (1, 2.0, 2.0), (1, 20.0, 2.0), (2, 2.0, 2.0), (3, None, 2.0)], "camera_id int, lon double, lat double")
    got = sorted((r["camera_id"], r["lon"] or 0, r["zone"] or "-") for r in SP.zone_of(pts, edges).collect())
    assert got == [(1, 2.0, "Z"), (1, 2.0, "Z"), (1, 20.0, "-"), (2, 2.0, "Z"), (3, 0, "-")]


def test_cover_sums_equal_pairs(spark):
    rnd = random.Random(2)
    pts = spark.createDataFrame([(i, -80 + rnd.randrange(9) / 10, 56 + rnd.randrange(9) / 10) for i in range(80)], "camera_id int, lon double, lat double")
    cells = spark.createDataFrame([(j, -80 + rnd.randrange(20) / 10, 56 + rnd.randrange(20) / 10, j % 3, rnd.random()) for j in range(400)],
                                  "cell_id int, cx double, cy double, value int, c double")
    aggs = {"n": F.count("*"), "s": F.sum("c")}
    want = SP.within_radius(pts, cells, 30.0).groupBy("camera_id", "value").agg(*[v.alias(k) for k, v in aggs.items()])
    got = SP.cover_near(pts, cells, 30.0, aggs, ["value"])
    assert {(r[0], r[1], r[2], round(r[3], 9)) for r in got.collect()} == {(r[0], r[1], r[2], round(r[3], 9)) for r in want.collect()}


def test_retrieval_day_counts_whole(spark):
    obs = spark.createDataFrame([(1, "2022-03-01 05:00:00"), (1, "2022-03-05 23:00:00"), (1, "2022-03-06 00:00:00")], "camera_id int, t string")
    dep = spark.createDataFrame([(1, "2022-03-01", "2022-03-05")], "camera_id int, a string, b string").select(
        "camera_id", F.to_date("a").alias("date_deployed"), F.to_date("b").alias("date_retrieved"))
    got = J.in_deployment(obs.withColumn("date_time", F.to_timestamp("t")), dep).orderBy("t").collect()
    assert [r["in_deployment"] for r in got] == [True, True, False]


def test_platforms_count_images_once(spark):
    a = spark.createDataFrame([("P1", "Moose", 1), ("P1", "Moose", 1), ("P1", "Moose", 2), (None, "Wolf", 3)], "plot string, species string, image_id int")
    b = spark.createDataFrame([("P1", "Moose", 9), (None, "Wolf", 8)], "plot string, species string, image_id int")
    got = {(r["plot"], r["species"]): (r["n_a"], r["n_b"]) for r in J.compare_platforms(a, b, ["plot"]).collect()}
    assert got == {("P1", "Moose"): (2, 1), (None, "Wolf"): (1, 1)}


def test_jittered_boxes_in_one_cell(spark):
    """Thousands of near-equal boxes: links stay linear and groups whole, over several blocks."""
    rng = np.random.default_rng(3)
    n = 6000
    rows = [(f"b{i:05d}", 1, *(np.array([10, 20, 5, 4]) + rng.random(4) * 0.05).tolist(), 0.5) for i in range(n)]
    rows += [(f"s{i}", 1, 60.0, 60.0, 5.0, 5.0, 0.5) for i in range(50)] + [("lone", 1, 90.0, 1.0, 2.0, 2.0, 0.5), ("odd", None, 10.0, 20.0, 5.0, 4.0, 0.5)]
    df = spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")
    nodes = RP.box_nodes(df, "folder", "box_id", "x", "y", "w", "h")
    assert RP.repeat_links(nodes).count() < 60 * n
    out = RP.suppress_repeats(df, min_count=3).groupBy("repeat_group", "group_size").agg(
        F.count("*").alias("n"), F.max("confidence").alias("c")).collect()
    assert {(r["repeat_group"], r["group_size"], r["n"], r["c"]) for r in out} == {
        ("b00000", n, n, -0.5), ("s0", 50, 50, -0.5), (None, None, 2, 0.5)}


def test_static_box_is_one_pair_row(spark):
    rows = [(f"b{i}", 1, 10.0, 10.0, 5.0, 5.0, 0.6) for i in range(100)] + [(f"c{i}", 1, 10.1, 10.0, 5.0, 5.0, 0.6) for i in range(7)]
    df = spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")
    (r,) = RP.repeat_pairs(df).collect()
    assert (r["a"], r["b"], r["n_a"], r["n_b"]) == ("b0", "c0", 100, 7)


def test_tasks_keep_every_choice(spark):
    def region(i, name, **value):
        return {"id": i, "type": "x", "origin": "manual", "to_name": "image", "from_name": name, "value": value}
    doc = {"data": {"image": "i.JPG"}, "annotations": [{"result": [
        region("r1", "label", x=1, y=2, width=3, height=4, rectanglelabels=["animal"]),
        region("r1", "behavior", choices=["Walking", "Feeding"]), region("r1", "species", choices=["Moose"]),
        region("r1", "comment", text=["a", "b"])]}]}
    t = spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.from_json("j", TASK_SCHEMA).alias("t")).select("t.*")
    long = RD.tasks_to_long(t)
    assert {(r["variable"], r["tag"], r["value_text"]) for r in long.collect()} == {
        ("behavior", "Walking", None), ("behavior", "Feeding", None), ("species", "Moose", None), ("comment", None, "a"), ("comment", None, "b")}
    w = R.widen_tags(long).first()
    assert (w["species"], w["behavior"]) == ("Moose", "Feeding, Walking")


def test_tasks_and_coco_keep_weak_images(spark):
    rows = [("i1.jpg", 0.9, 0, 1, 0.9), ("i1.jpg", 0.9, 1, 1, 0.8), ("i1.jpg", 0.9, 2, 2, 0.7), ("i2.jpg", 0.2, 0, 1, 0.2), ("i3.jpg", 0.0, None, None, None)]
    d = spark.createDataFrame(rows, "file string, max_detection_conf double, box int, category int, conf double").withColumn(
        "bbox", F.array(*[F.lit(0.1)] * 4))
    tasks = {r["file"]: [x["value"]["rectanglelabels"][0] for x in json.loads(r["task"])["predictions"][0]["result"]]
             for r in RD.to_tasks(d, "u/", 0.5).collect()}
    assert tasks == {"i1.jpg": ["animal", "animal", "person"], "i2.jpg": [], "i3.jpg": []}
    coco = RD.to_coco(d, 0.5).collect()
    assert len({r["id"] for r in coco}) == len(coco) == 5
    assert {r["image_id"]: r["isempty"] for r in coco} == {"i1.jpg": False, "i2.jpg": True, "i3.jpg": True}
    doc = json.loads(RD.coco_collections(d, 0.5).filter("image_id = 'i2.jpg'").first()["value"])
    assert doc["images"] == [{"id": "i2.jpg", "file_name": "i2.jpg"}] and doc["annotations"][0]["max_confidence"] == 0.2


def test_exports_with_other_headers_and_line_breaks(spark, tmp_path):
    (tmp_path / "a_output.csv").write_text('id,source_file,variable,tag\np_1,f1.JPG,notes,"two\nlines, ""quoted"""\n')
    (tmp_path / "b_output.csv").write_text("source_file,id,extra,variable,tag\nf2.JPG,p_2,x,species,NA\n")
    (tmp_path / "c_output.csv").write_text("")
    got = {r["id"]: r for r in RD.read_annotations(spark, str(tmp_path)).collect()}
    assert set(got) == {"p_1", "p_2"}
    assert got["p_1"]["source_file"] == "f1.JPG" and got["p_1"]["tag"] == 'two\nlines, "quoted"' and got["p_1"]["extra"] is None
    assert got["p_2"]["source_file"] == "f2.JPG" and got["p_2"]["tag"] is None and got["p_2"]["file"] == "b_output.csv"
    assert RD.read_annotations(spark, str(tmp_path), "*.none").count() == 0


def test_capture_time_behind_long_segments(spark, tmp_path):
    from camstat.plans.sources_q import _jpeg
    (tmp_path / "a.jpg").write_bytes(_jpeg("2022:08:19 10:11:12", 60_000))
    (tmp_path / "b.jpg").write_bytes(_jpeg(None, 10))
    (tmp_path / "c.jpg").write_bytes(b"no image")
    (tmp_path / "d.jpg").write_bytes(b"\xff\xd8\xff\xe1" + struct.pack(">H", 500) + b"Exif")
    got = {r["path"][-5:]: r for r in IM.read_capture_times(spark, str(tmp_path)).collect()}
    assert got["a.jpg"]["exif_date_time_original"] == "2022:08:19 10:11:12"
    assert not got["b.jpg"]["has_time"] and got["b.jpg"]["error"] is None
    assert got["c.jpg"]["error"].startswith("ValueError") and not got["d.jpg"]["has_time"]
    with pytest.raises(Exception, match="no capture time"):
        IM.read_capture_times(spark, str(tmp_path), strict=True).collect()


def test_key_value_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Cameras,272\nPlots,60\n,\nSites,227\n")
    assert [tuple(r) for r in RD.read_key_values(spark, str(tmp_path / "s.csv")).collect()] == [("Cameras", "272"), ("Plots", "60"), ("Sites", "227")]


def test_nest_divides_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(R, "NEST_ROWS", 10)
    df = spark.range(200).select(F.when(F.col("id") < 150, "hot").otherwise(None).alias("k"), "id")
    n = R.nest(df, ["k"])
    assert n.agg(F.max(F.size("data"))).first()[0] < 40
    assert {r["k"]: r["nr"] for r in n.collect()} == {"hot": 150, None: 50}
    assert R.unnest(n).exceptAll(df).count() == 0 and R.unnest(n).count() == 200


def test_checkpoint_folder_is_asked_for_on_clusters(monkeypatch):
    from camstat.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_replayed_sessions_are_all_written(spark, tmp_path):
    from camstat.streaming.sessions import replay
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (1, "2024-01-03 03:00:00"), (2, "2024-01-02 00:05:00"), (None, "2024-01-02 00:05:00")]
    df = spark.createDataFrame(rows, "camera_id int, t string").select("camera_id", F.to_timestamp("t").alias("date_time"))
    got = {(r["camera_id"], str(r["session_start"]), r["n_images"]) for r in replay(df.repartition(4), str(tmp_path)).collect()}
    assert got == {(1, "2024-01-01 00:00:00", 2), (1, "2024-01-03 03:00:00", 1), (2, "2024-01-02 00:05:00", 1)}
