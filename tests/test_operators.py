"""Operators against hand-made cases and brute force."""

import itertools
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import metrics as M
from camstat.operators import reshape as R
from camstat.operators import spatial as SP
from camstat.operators import windows as W
from camstat.operators.reconcile import reconcile
from camstat.operators.repeats import connected_components, repeat_pairs, suppress_repeats


def test_reconcile_rules(spark):
    rows = [
        # Same rows both exports -> export 1
        ("f1", 1, "P1_C_x_1", "Moose"), ("f1", 2, "P1_C_x_1", "Moose"),
        # One None row each, numeric ids 10 and 9 -> 9 (numeric order)
        ("f2", 1, "10", None), ("f2", 2, "9", None),
        # D3: None rows, one numeric id -> the P row
        ("f3", 1, "10", None), ("f3", 2, "P901-1_C_x_1", None),
        # File only in one export
        ("f4", 1, "P1_C_y_1", "Caribou"), ("f5", 2, "P1_C_z_1", "Caribou"),
        # 1 vs 2 rows, all None, one numeric id -> non-numeric rows
        ("f6", 1, "77", None), ("f6", 2, "P1_C_w_1", None), ("f6", 2, "P1_C_w_2", None),
        # E: species differ
        ("f7", 1, "P1_C_v_1", "Moose"), ("f7", 2, "P1_C_v_1", "Caribou"),
    ]
    df = spark.createDataFrame(rows, "source_file string, orig int, id string, species string")
    kept, conflicts = reconcile(df)
    got = {(r.source_file, r.id, r.species, r.rule) for r in kept.collect()}
    assert got == {("f1", "P1_C_x_1", "Moose", "D1"), ("f2", "9", None, "D2"), ("f3", "P901-1_C_x_1", None, "D3"),
                   ("f4", "P1_C_y_1", "Caribou", "D4"), ("f5", "P1_C_z_1", "Caribou", "D5"),
                   ("f6", "P1_C_w_1", None, "D6"), ("f6", "P1_C_w_2", None, "D6")}
    assert {r.source_file for r in conflicts.collect()} == {"f7"}


def test_deployment_status(spark):
    df = spark.createDataFrame([("2022-03-01", None), ("2022-03-01", "2022-02-01"), ("2022-03-01", "2022-09-01")],
                               "d string, r string").select(F.to_date("d").alias("date_deployed"),
                                                            F.to_date("r").alias("date_retrieved"))
    assert [r.status for r in O.deployment_status(df).collect()] == ["invalid", "invalid", "valid"]


def test_histogram_clamps_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "v double")
    bins = {r.bin: r.n for r in A.histogram(df, "v", 10, 0.0, 1.0).collect()}
    assert bins == {1: 1, 6: 1, 10: 1}


def test_burst_keeps_whole_burst(spark):
    rows = [(1, i, f"2022-01-01 00:00:0{i}", 0.05 if i != 3 else 0.5) for i in range(5)]
    rows += [(1, 10 + i, f"2022-01-01 01:00:0{i}", 0.05) for i in range(5)]
    df = spark.createDataFrame(rows, "cam int, id int, t string, confidence double").withColumn(
        "ts", F.to_timestamp("t"))
    out = W.expand_bursts(df, ["cam"], "ts", 0.1, burst_gap_seconds=2, tiebreak=["id"])
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]


def test_sessionize_matches_single_window(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(4):
        t = 0
        for i in range(300):
            t += rnd.choice([5, 30, 200, 4000, 9000])
            rows.append((k % 2, k, i, t))
    df = spark.createDataFrame(rows, "hot int, key int, id int, sec long").withColumn(
        "ts", F.timestamp_seconds("sec"))
    got = W.sessionize(df, ["key"], "ts", 1800, ["id"], bucket_seconds=3600)
    w = Window.partitionBy("key").orderBy("ts", "id")
    prev = F.lag("sec").over(w)
    ref = df.withColumn("_n", F.when(prev.isNull() | (F.col("sec") - prev >= 1800), 1).otherwise(0)).withColumn(
        "ref", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    j = got.join(ref.select("key", "id", "ref"), ["key", "id"])
    assert j.count() == len(rows)
    assert j.filter(F.col("session") != F.col("ref")).count() == 0


def test_seq_id_and_halves(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    s = W.seq_id(df, ["k"], partitions=7)
    rows = s.collect()
    assert sorted(r.seq for r in rows) == list(range(1, 1001))
    assert all(r.seq == r.k + 1 for r in rows)
    h = W.halves(df, ["k"]).groupBy("half").count().collect()
    assert {r.half: r["count"] for r in h} == {1: 500, 2: 500}


def test_top1_ties_go_to_first_position(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.9), (1, 2, 0.9), (2, 0, 0.1)], "k int, pos int, s double")
    got = {r.k: r.pos for r in W.top1(df, ["k"], "s", position="pos", payload=["pos"]).collect()}
    assert got == {1: 1, 2: 0}


def test_point_in_polygon_with_hole(spark):
    verts = SP.literal_polygons(spark, {"Z": [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]})
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 20.0, 2.0), (3, 5.0, 5.0)], "camera_id int, lon double, lat double")
    got = {r.camera_id: r.zone for r in SP.zone_of(pts, SP.polygon_edges(verts)).collect()}
    assert got == {1: "Z", 2: None, 3: None}


def test_hellinger_rows_unit_norm(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "a", 5)], "u int, s string, n long")
    h = SP.hellinger(df, "u", "s", "n").groupBy("u").agg(F.sum(F.col("hellinger") ** 2).alias("ss"))
    assert all(abs(r.ss - 1) < 1e-12 for r in h.collect())


def test_within_radius_matches_brute_force(spark):
    rnd = random.Random(5)
    pts = [(i, -90 + rnd.random() * 3, 50 + rnd.random() * 3) for i in range(60)]
    cells = [(j, -90 + rnd.random() * 3, 50 + rnd.random() * 3) for j in range(300)]
    p = spark.createDataFrame(pts, "camera_id int, lon double, lat double")
    c = spark.createDataFrame(cells, "cell_id int, cx double, cy double")
    got = {(r.camera_id, r.cell_id) for r in SP.within_radius(p, c, 20.0).collect()}
    ref = {(i, j) for i, x, y in pts for j, cx, cy in cells if _hav(x, y, cx, cy) <= 20.0}
    assert got == ref and ref


def _hav(lon1, lat1, lon2, lat2):
    import math
    p1, p2, dl = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def test_pairs_within_matches_brute_force(spark):
    rnd = random.Random(9)
    pts = [(i, -180 + rnd.random() * 360, -89.9 + rnd.random() * 179.8) for i in range(150)]
    pts += [(1000 + i, 10 + rnd.random() * 0.5, 89.5 + rnd.random() * 0.4) for i in range(20)]
    df = spark.createDataFrame(pts, "camera_id int, lon double, lat double")
    got = {(r.a, r.b) for r in SP.pairs_within(df, 1500.0).collect()}
    import math

    def hav(a, b):
        p1, p2 = math.radians(a[2]), math.radians(b[2])
        dl = math.radians(b[1] - a[1])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))
    ref = {(a[0], b[0]) for a, b in itertools.combinations(pts, 2) if a[0] < b[0] and hav(a, b) <= 1500.0}
    assert got == ref


def test_repeat_pairs_match_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        f = rnd.randrange(3)
        if rnd.random() < 0.5:
            x, y, w, h = 10 + rnd.random() * 0.4, 20 + rnd.random() * 0.4, 5 + rnd.random() * 0.3, 4 + rnd.random() * 0.3
        else:
            w = 0.5 + rnd.random() * 30
            x, y, h = rnd.random() * 70, rnd.random() * 70, 0.5 + rnd.random() * 30
        rows.append((f"b{i:04d}", f, x, y, w, h, 0.5))
    df = spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")
    got = {(r.a, r.b) for r in repeat_pairs(df, 0.85, 0.1).collect()}

    def iou(a, b):
        iw = max(0.0, min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2]))
        ih = max(0.0, min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3]))
        inter = iw * ih
        return inter / (a[4] * a[5] + b[4] * b[5] - inter)
    ref = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[1] == b[1] and iou(a, b) >= 0.85}
    assert got == ref and len(ref) > 50


def test_connected_components_chain(spark):
    nodes = spark.createDataFrame([(str(i),) for i in range(10)], "node string")
    edges = spark.createDataFrame([("0", "1"), ("1", "2"), ("2", "3"), ("5", "6")], "a string, b string")
    comp = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert comp["3"] == "0" and comp["6"] == "5" and comp["9"] == "9"


def test_suppress_repeats_marks_groups(spark):
    rows = [(f"r{i}", 1, 10.0, 10.0, 5.0, 5.0, 0.6) for i in range(4)]          # identical static box x4
    rows += [("s1", 1, 50.0, 50.0, 5.0, 5.0, 0.6), ("low", 1, 10.0, 10.0, 5.0, 5.0, 0.05)]
    df = spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")
    out = {r.box_id: r.confidence for r in suppress_repeats(df, min_count=3).collect()}
    assert all(out[f"r{i}"] == -0.6 for i in range(4))
    assert out["s1"] == 0.6 and out["low"] == 0.05


def test_class_metrics_and_split(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "truth int, pred int")
    m = {r["class"]: r for r in M.class_metrics(df).collect()}
    assert (m[1].tp, m[1].fp, m[1].fn, m[1].tn) == (2, 2, 0, 1)
    assert m[2].precision is None and m[2].recall == 0.0
    s = M.split_stratified(spark.range(0, 400).withColumn("c", F.col("id") % 4), "c", "id", 0.25, 1)
    cnt = {(r.c, r.split): r["count"] for r in s.groupBy("c", "split").count().collect()}
    assert all(cnt[(c, "eval")] == 25 for c in range(4))


def test_widen_and_unpivot(spark):
    long = spark.createDataFrame([
        ("P1_C_x_1", "f", "species", "Other [See more species]", None),
        ("P1_C_x_1", "f", "other_species", "Red fox", None),
        ("P1_C_x_M2", "f", "species", "Moose", None),
        ("P1_C_x_3", "f", "comment", "blurry", "blurry")],
        "id string, source_file string, variable string, tag string, value_text string")
    w = {r.id: r for r in R.widen_tags(long, drop=()).collect()}
    assert set(w) == {"P1_C_x_1", "P1_C_x_M2"}
    assert w["P1_C_x_1"].species == "Red fox" and w["P1_C_x_M2"].manual and w["P1_C_x_1"].image_id == "P1_C_x"


def test_gower_and_jaccard(spark):
    long = spark.createDataFrame([(1, "a", 2.0), (1, "b", 0.0), (2, "a", 4.0), (3, "b", 2.0)], "u int, s string, v double")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    g = {(r.a, r.b): r.gower for r in SP.gower(long, pairs, "u", "s", "v").collect()}
    # ranges: a in {2,4,0} -> 4; b in {0,0,2} -> 2
    assert abs(g[(1, 2)] - (2 / 4 + 0 / 2) / 2) < 1e-12
    assert abs(g[(1, 3)] - (2 / 4 + 2 / 2) / 2) < 1e-12
    pa = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "u int, s string")
    j = {(r.a, r.b): r.jaccard for r in SP.jaccard(pa, pairs, "u", "s").collect()}
    assert j == {(1, 2): 0.5, (1, 3): 1.0}


def test_seq_id_within_groups(spark):
    df = spark.range(0, 3000).withColumn("g", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 3))
    s = W.seq_id(df, ["id"], by=["g"], partitions=9)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    j = s.join(ref, ["id", "g"])
    assert j.count() == 3000 and j.filter(F.col("seq") != F.col("r")).count() == 0


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rnd = random.Random(4)
    rows = [(g, float(rnd.randint(0, 50))) for g in range(3) for _ in range(rnd.randint(5, 400))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.q0, r.q1, r.q2) for r in A.quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in range(3):
        vals = np.array([v for gg, v in rows if gg == g])
        ref = np.quantile(vals, [0.25, 0.5, 0.9])
        assert np.allclose(got[g], ref)
