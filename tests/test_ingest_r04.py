"""Disk of the two ingest queries: rows move once on the way to the files, files are compressed, large files are not shuffled."""
import json
import os

import pytest
from pyspark.sql import functions as F

from camstat.sources.readers import read_detections
from camstat.streaming import replace
from camstat.streaming.ingest import coco_documents, export_documents

FIELDS = "box_id string, image_id long, folder long, x double, y double, w double, h double, confidence double, category_id long"
#: Null keys, null values, an image in two folders and rows that come twice.
ODD = [("a", 1, 7, 1.0, 2.0, 3.0, 4.0, 0.5, 1), ("b", 1, 7, 1.0, None, 3.0, 4.0, None, 2), ("b", 1, 7, 1.0, None, 3.0, 4.0, None, 2),
       ("c", 1, 8, 1.0, 2.0, 3.0, 4.0, 0.5, None), (None, None, 8, 1.0, 2.0, 3.0, 4.0, 0.5, 3), ("d", None, 8, 1.0, 2.0, 3.0, 4.0, 0.5, 3),
       ("e", 2, None, 0.0, -0.0, 3.0, 4.0, 0.5, 0), ("f", 2, None, 0.0, 0.0, 3.0, 4.0, 0.5, 0)]


def _boxes(spark, n=4000):
    return spark.range(n).selectExpr(
        "concat('b', id) AS box_id", "id div 3 AS image_id", "id div 3 % 40 AS folder", "id % 50 + 0.5D AS x", "id % 7 + 0D AS y", "1.0D AS w",
        "2.0D AS h", "id % 10 / 10 AS confidence", "id % 4 AS category_id")


def _files(path):
    return [f"{d}/{f}" for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.startswith("part-")]


def test_documents_hold_each_box_once(spark):
    boxes = spark.createDataFrame(ODD, FIELDS)
    for b in (boxes, boxes.repartitionByRange(5, "folder", "image_id")):
        docs = [(r["folder"], json.loads(r["value"])) for r in coco_documents(b).collect()]
        assert len(docs) == 4
        got = sorted(repr((f, a.get("image_id"), a.get("id"), a.get("category_id"), a["bbox"], a.get("confidence"))) for f, d in docs for a in d["annotations"])
        want = sorted(repr((f, None if i is None else str(i), k, c, [x, y, w, h], conf)) for k, i, f, x, y, w, h, conf, c in ODD)
        assert got == want
        for _, d in docs:
            ids = [a.get("id") for a in d["annotations"]]
            assert ids == sorted(ids, key=lambda k: (k is not None, k)) and {a.get("image_id") for a in d["annotations"]} == {d["images"][0].get("id")}


def test_boxes_move_once_to_the_files(spark, tmp_path):
    part = F.col("folder") % 5
    ranges = _boxes(spark).withColumn("part", part).repartitionByRange("part", "folder", "image_id")
    plan = coco_documents(ranges, "part")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1
    export_documents(_boxes(spark), part, str(tmp_path / "in"))
    files = _files(str(tmp_path / "in"))
    assert files and all(f.endswith(".txt.snappy") for f in files)
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {f"part={k}" for k in range(5)}
    text = sum(len(r["value"]) + 1 for r in coco_documents(_boxes(spark)).collect())
    assert sum(map(os.path.getsize, files)) < text / 2
    found = read_detections(spark, str(tmp_path / "in"), "*.txt.snappy", multi_line=False)
    cols = ["id", "image_id", "category_id", "confidence"]
    want = _boxes(spark).select(F.col("box_id").alias("id"), F.col("image_id").cast("string"), F.col("category_id").cast("int"), "confidence")
    assert sorted(found.select(*cols).collect()) == sorted(want.collect())


def test_overwrite_replaces_folders_that_get_rows(spark, tmp_path):
    root, part = str(tmp_path / "in"), F.concat(F.lit("f"), F.col("folder") % 5)
    export_documents(_boxes(spark), part, root, "append")
    some = _boxes(spark).where("folder % 5 = 2").withColumn("category_id", F.col("category_id") + 10)
    for _ in range(2):
        export_documents(some, part, root, "overwrite")
    n = {r["k"]: r["n"] for r in read_detections(spark, root, "*.txt.snappy", multi_line=False).groupBy((F.col("category_id") >= 10).alias("k")).agg(F.count("*").alias("n")).collect()}
    assert n == {True: some.count(), False: 4000 - some.count()}


@pytest.mark.parametrize("large", [True, False])
def test_large_files_are_not_shuffled(spark, tmp_path, monkeypatch, large):
    """Rows and swaps are the same either way; of small files only a few are written."""
    root, sink, ledger = (str(tmp_path / x) for x in ("in", "out", "ledger"))
    monkeypatch.setattr(replace, "LARGE_FILES", 1 if large else 1 << 40)
    hints, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "hint", lambda self, *a, f=frame.hint: hints.append(a) or f(self, *a))
    export_documents(_boxes(spark), F.concat(F.lit("f"), F.col("folder") % 5), root)
    n_files = len(_files(root))
    assert replace.ingest_current(spark, root, sink, ledger, "*.txt.snappy", multi_line=False) == 5
    assert hints == ([] if large else [("rebalance", "folder")])
    assert 5 <= len(_files(sink)) <= n_files
    out = spark.read.parquet(sink)
    assert sorted(out.select("id", "image_id", "folder").collect()) == sorted(
        _boxes(spark).select("box_id", F.col("image_id").cast("string"), F.concat(F.lit("part=f"), F.col("folder") % 5)).collect())
    export_documents(_boxes(spark, 300).where("folder % 5 = 1"), F.concat(F.lit("f"), F.col("folder") % 5), root, "overwrite")
    assert replace.ingest_current(spark, root, sink, ledger, "*.txt.snappy", multi_line=False) == 1
    assert replace.ingest_current(spark, root, sink, ledger, "*.txt.snappy", multi_line=False) == 0
    want = _boxes(spark).where("folder % 5 <> 1").count() + _boxes(spark, 300).where("folder % 5 = 1").count()
    assert spark.read.parquet(sink).count() == want


@pytest.mark.parametrize("module, query", [("quality_q", "stream_ingest_detections"), ("gis_q", "ingest_replaced_files")])
def test_disk_of_the_ingest_queries(spark, monkeypatch, module, query):
    """What a query leaves in its folder is less than the text of its documents."""
    import importlib

    from camstat.session import shared_path
    from camstat.sources import adapters as S
    m, made = importlib.import_module(f"camstat.plans.{module}"), []
    monkeypatch.setattr(S, "boxes", lambda *_: _boxes(spark, 60_000))
    monkeypatch.setattr(m, "shared_path", lambda s, label: made.append(shared_path(s, label)) or made[-1])
    got = getattr(m, query)(spark, "")
    assert sum(r["n"] for r in got.collect()) == 60_000
    text = coco_documents(_boxes(spark, 60_000)).agg(F.sum(F.length("value") + 1)).first()[0]
    files = [f for f in _files(made[0]) if "/in/" in f]
    assert sum(map(os.path.getsize, files)) < text / 2
