import json
import os

import pytest

from camstat.streaming.replace import ingest_current, versions


def put(folder, name, boxes, at=None):
    os.makedirs(folder, exist_ok=True)
    doc = {"images": [{"id": name, "file_name": f"{name}.JPG"}],
           "annotations": [{"id": f"{name}_{k}", "image_id": name, "category_id": c, "bbox": [0.0, 0.0, 1.0, 1.0], "confidence": 0.5} for k, c in enumerate(boxes)]}
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump(doc, f)
    if at:
        os.utime(f"{folder}/{name}.json", (at, at))


def rows(spark, sink):
    return sorted((r["folder"], r["id"], r["category_id"]) for r in spark.read.option("basePath", sink).parquet(sink).select("folder", "id", "category_id").collect())


def test_replaced_added_and_removed_files(spark, tmp_path):
    root, sink, ledger = (str(tmp_path / x) for x in ("in", "out", "ledger"))
    put(f"{root}/A", "a1", [1, 2], 1_700_000_000)
    put(f"{root}/A", "a2", [1], 1_700_000_000)
    put(f"{root}/B", "b1", [3], 1_700_000_000)
    assert ingest_current(spark, root, sink, ledger) == 2
    assert rows(spark, sink) == [("A", "a1_0", 1), ("A", "a1_1", 2), ("A", "a2_0", 1), ("B", "b1_0", 3)]
    assert ingest_current(spark, root, sink, ledger) == 0
    put(f"{root}/A", "a1", [9], 1_700_000_500)  # a corrected file under its old name
    put(f"{root}/C", "c1", [4, 4], 1_700_000_500)
    assert ingest_current(spark, root, sink, ledger) == 2
    want = [("A", "a1_0", 9), ("A", "a2_0", 1), ("B", "b1_0", 3), ("C", "c1_0", 4), ("C", "c1_1", 4)]
    assert rows(spark, sink) == want
    os.remove(f"{root}/C/c1.json")
    os.remove(f"{root}/A/a2.json")
    assert ingest_current(spark, root, sink, ledger) == 2
    assert rows(spark, sink) == [("A", "a1_0", 9), ("B", "b1_0", 3)]
    assert versions(spark, ledger).count() == 2 and ingest_current(spark, root, sink, ledger) == 0


def test_failure_between_swap_and_ledger(spark, tmp_path):
    root, sink, ledger = (str(tmp_path / x) for x in ("in", "out", "ledger"))
    put(f"{root}/A", "a1", [1, 2], 1_700_000_000)
    ingest_current(spark, root, sink, ledger)
    put(f"{root}/A", "a1", [7], 1_700_000_900)

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ingest_current(spark, root, sink, ledger, before_ledger=fail)
    assert ingest_current(spark, root, sink, ledger) == 1
    assert rows(spark, sink) == [("A", "a1_0", 7)]


def test_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ingest_current(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger")) == 0
