"""Rows that the steps of round 3's findings must keep: regions of several tasks, texts read through a compression."""

import gzip
import json
from collections import Counter

import numpy as np
import pytest

from camstat.operators import repeats as RP
from camstat.operators.reshape import widen_tags
from camstat.schemas import TASK_SCHEMA
from camstat.sources import readers as RD
from camstat.sources.fileio import first_line


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def task(image, *results):
    keep = [{"id": i, "type": k, "origin": "manual", "to_name": "image", "from_name": n, "original_width": 10.0, "original_height": 8.0, "value": v}
            for i, k, n, v in results]
    return json.dumps({"data": {"image": image}, "annotations": [{"result": keep}]})


BOX = {"x": 1.0, "y": 2.0, "width": 3.0, "height": 4.0, "rectanglelabels": ["animal"]}


def test_tasks_move_once_and_keep_every_value(spark, tmp_path):
    lines = [task("a.JPG", ("r1", "rectanglelabels", "label", BOX), ("r1", "choices", "behavior", {"choices": ["Lying", "Feeding"]})),
             task("a.JPG", ("r1", "textarea", "comment", {"text": ["one", "two"]}), ("r2", "rectanglelabels", "label", {**BOX, "x": 7.0})),
             task("b.JPG", (None, "rectanglelabels", "label", {**BOX, "x": 9.0}), (None, "choices", "species", {"choices": ["Moose"]}))]
    with gzip.open(tmp_path / "tasks.txt.gz", "wt") as f:
        f.write("\n".join(lines))
    long = RD.tasks_to_long(spark.read.schema(TASK_SCHEMA).json(str(tmp_path)))
    moves = shuffles(long)
    got = sorted(((r.source_file, r.id, r.variable, r.tag, r.value_text, r.value_x, r.value_rectanglelabels) for r in long.collect()), key=str)
    want = [("a.JPG", "r1", "behavior", "Lying", None, 1.0, "['animal']"), ("a.JPG", "r1", "behavior", "Feeding", None, 1.0, "['animal']"),
            ("a.JPG", "r1", "comment", None, "one", 1.0, "['animal']"), ("a.JPG", "r1", "comment", None, "two", 1.0, "['animal']"),
            ("a.JPG", "r2", None, None, None, 7.0, "['animal']"),
            ("b.JPG", None, "species", "Moose", None, 9.0, "['animal']"), ("b.JPG", None, None, None, None, 9.0, "['animal']")]
    assert got == sorted(want, key=str)
    assert moves == 1


def test_rows_to_widen_move_as_they_come(spark):
    long = spark.createDataFrame([("P1_C_1", "f", "species", "Moose", None), ("P1_C_1", "f", "behavior", "b", None), ("P1_C_1", "f", "behavior", "a", None),
                                  ("P1_C_1", "f", "behavior", "a", None), ("P2_C_1", "f", "sex", None, None), (None, None, "age", "Adult", None)],
                                 "id string, source_file string, variable string, tag string, value_text string")
    plain, dealt = widen_tags(long), widen_tags(long, rows=long.count())
    assert shuffles(dealt) == 1 and "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert {r.behavior for r in dealt.collect()} == {"a, b", None}


def test_header_behind_a_compression(tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wb") as f:
        f.write(b"id,tag\r\n1,2\r\n")
    assert first_line(str(tmp_path / "x.csv.gz")) == "id,tag"


def test_annotations_wide_moves_rows_once(spark, sf):
    from camstat.plans import QUERIES, load_all
    load_all()
    assert shuffles(QUERIES["annotations_wide"](spark, sf)) == 1


def test_sites_are_joined_once(spark, sf):
    from camstat.plans import learning_q
    plan = learning_q._site_table(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_folders_of_an_export_do_not_follow_the_cameras(spark, tmp_path, monkeypatch):
    """Each camera folder is in one folder of the export, of a bounded number; corrected ones stay apart."""
    import os

    from camstat.plans import gis_q, quality_q
    from camstat.session import shared_path
    from camstat.sources import adapters as S
    boxes = spark.range(0, 600).selectExpr(
        "cast(id as string) AS box_id", "id AS image_id", "id AS folder", "1.0D AS x", "1.0D AS y", "1.0D AS w", "1.0D AS h",
        "0.5D AS confidence", "id % 4 AS category_id")
    monkeypatch.setattr(S, "boxes", lambda *_: boxes)
    made = []
    for module in (gis_q, quality_q):
        monkeypatch.setattr(module, "shared_path", lambda s, label: made.append(shared_path(s, label)) or made[-1])
    n = {r.category_id: r.n for r in quality_q.stream_ingest_detections(spark, "").collect()}
    assert n == {k: 150 for k in range(4)}
    want = {}
    for i in range(600):
        c = i % 4 + (10 if i % 7 == 0 else 0)
        want[c] = want.get(c, 0) + 1
    assert {r.category_id: r.n for r in gis_q.ingest_replaced_files(spark, "").collect()} == want
    for base, most in zip(made, (quality_q.EXPORT_FOLDERS, gis_q._INGEST_FOLDERS)):
        folders = [f for f in os.listdir(f"{base}/in".removeprefix("file:")) if f.startswith("part=")]
        assert 0 < len(folders) <= most < 600


def _boxes(spark, n, seed):
    rng = np.random.default_rng(seed)
    side = np.exp(rng.uniform(-6, 6, (n, 2)))
    at = rng.uniform(-300, 300, (n, 2))
    like = rng.integers(0, 15, n)
    near = (rng.random(n) < 0.7) & (np.arange(n) >= 15)
    side[near] = side[like][near] * rng.uniform(0.92, 1.08, (n, 2))[near]
    at[near] = at[like][near] + side[near] * rng.uniform(-0.1, 0.1, (n, 2))[near]
    rows = [(f"b{i:04d}", None if i % 97 == 0 else int(rng.integers(0, 2)), *map(float, (*at[i], *side[i])), 0.5) for i in range(n)]
    # grid boxes at the very threshold: 17 of 20 wide, and moved by the whole reach
    rows += [("g0", 7, 3.0, 1.0, 17.0, 2.0, 0.5), ("g1", 7, 3.0, 1.0, 20.0, 2.0, 0.5), ("g2", 7, 6.0, 1.0, 17.0, 2.0, 0.5), ("g3", 8, 3.0, 1.0, 20.0, 2.0, 0.5)]
    rows += [("z0", 0, 1.0, 1.0, 0.0, 2.0, 0.5), ("z1", 0, 1.0, 1.0, 0.0, 2.5, 0.5), ("z2", 0, 1.0, 1.0, None, 2.5, 0.5), ("z3", 0, 1.0, 1.0, -3.0, -2.5, 0.5)]
    return rows, spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")


def _overlaps(rows, t):
    pairs = {}
    for i, (a, f, ax, ay, aw, ah, _) in enumerate(rows):
        for b, g, bx, by, bw, bh, _ in rows[i + 1:]:
            if f is not None and f == g and None not in (aw, bw):
                inter = max(0.0, min(ax + aw, bx + bw) - max(ax, bx)) * max(0.0, min(ay + ah, by + bh) - max(ay, by))
                union = aw * ah + bw * bh - inter
                if union > 0 and inter / union >= t:
                    pairs[a, b] = round(inter / union, 9)
    return pairs


@pytest.mark.parametrize("t, block", [(0.85, 1024), (0.85, 8), (0.5, 1024), (0.5, 20), (0.2, 50)])
def test_repeat_pairs_of_any_size_and_place(spark, monkeypatch, t, block):
    """Each pair once, over tiles, classes and the blocks of crowded tiles; groups are their components."""
    monkeypatch.setattr(RP, "BLOCK", block)
    rows, df = _boxes(spark, 700, 5)
    want = _overlaps(rows, t)
    got = [((r.a, r.b), round(r.iou, 9)) for r in RP.repeat_pairs(df, t).collect()]
    assert len(got) == len(set(got)) and dict(got) == want and len(want) > 200
    low = {}
    for a, b in RP.components(spark.createDataFrame(list(want), "a string, b string")).collect():
        low[a] = b
    size = Counter(low.values())
    groups = {r.box_id: (r.repeat_group, r.group_size) for r in RP.suppress_repeats(df, 3, t).collect() if r.repeat_group}
    assert groups == {a: (b, size[b]) for a, b in low.items() if size[b] >= 3}


def test_a_box_to_join_is_about_two_rows(spark):
    """It was inserted once and probed eight cells, and the names of pairs were joined to it twice."""
    rows, df = _boxes(spark, 700, 6)
    nodes = RP.box_nodes(df, "folder", "box_id", "x", "y", "w", "h")
    pairs = RP.repeat_pairs(df)
    assert shuffles(pairs) == 2
    assert nodes.count() < RP._tiles(nodes, 0.85, [], "folder", "x", "y", "w", "h").count() < 3 * nodes.count()


def test_single_boxes_are_no_nodes_of_groups(spark):
    """Equal boxes without a partner, also with a null, are a group; boxes of a smaller one keep their confidence."""
    rows = [(f"n{i}", 1, 4.0, None, 2.0, 2.0, 0.5) for i in range(3)] + [(f"p{i}", 2, 4.0, 1.0, 2.0, 2.0, 0.5) for i in range(2)]
    rows += [("q0", 2, 4.0, 1.0, 2.1, 2.0, 0.5), ("r0", 2, 40.0, 1.0, 2.1, 2.0, 0.5), ("r1", 2, 40.0, 1.0, 2.0, 2.0, 0.5)]
    df = spark.createDataFrame(rows, "box_id string, folder int, x double, y double, w double, h double, confidence double")
    got = {r.box_id: (r.confidence, r.repeat_group, r.group_size) for r in RP.suppress_repeats(df, 3).collect()}
    assert got == {**{f"n{i}": (-0.5, "n0", 3) for i in range(3)}, **{k: (-0.5, "p0", 3) for k in ("p0", "p1", "q0")},
                   "r0": (0.5, None, None), "r1": (0.5, None, None)}


def test_image_files_are_decoded_once(spark, sf):
    from camstat.plans import QUERIES, load_all
    load_all()
    plan = QUERIES["image_crops"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan image" not in plan and "/decoded-" in plan
