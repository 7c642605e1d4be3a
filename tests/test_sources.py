"""Readers, writers and streaming jobs on small files written by the tests."""

import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from camstat.operators import images as IM
from camstat.sources import readers as RD
from camstat.streaming.ingest import ingest_detections
from camstat.streaming.sessions import run_sessions


def test_annotation_csv_keeps_extra_columns(spark, tmp_path):
    d = tmp_path / "ann"
    d.mkdir()
    header = ("id,type,origin,to_name,variable,original_width,original_height,value_x,value_y,value_width,"
              "value_height,value_rectanglelabels,source_file,tag,value_text,source_file_with_dep\n")
    (d / "T1_P901_output.csv").write_text(header + "P901-1_CAM-1_DCIM_100RECNX_RCNX0001_1,choices,prediction,image,"
                                          "species,1920,1080,10,20,30,40,NA,a.JPG,Moose,NA,D1/a.JPG\n")
    (d / "ignored.txt").write_text("x")
    df = RD.read_annotations(spark, str(d))
    r = df.first()
    assert r.original_width == 1920.0 and r.value_rectanglelabels is None and r.source_file_with_dep == "D1/a.JPG"
    assert r.file == "T1_P901_output.csv" and df.count() == 1


def test_coco_detections_and_detector_json(spark, tmp_path):
    sub = tmp_path / "dep" / "loc"
    sub.mkdir(parents=True)
    coco = {"images": [{"id": "i1", "file_name": "a.JPG"}],
            "annotations": [{"id": "d1", "image_id": "i1", "category_id": 1, "bbox": [1, 2, 3, 4],
                             "confidence": 0.9, "max_confidence": 0.9, "isempty": False}]}
    (sub / "x_output_coco.json").write_text(json.dumps(coco))
    (sub / "x_coco_norepeats.json").write_text(json.dumps(coco))
    d = RD.read_detections(spark, str(tmp_path))
    assert d.count() == 1 and d.first().category_id == 1
    det = {"images": [{"file": "a.JPG", "max_detection_conf": 0.8,
                       "detections": [{"category": "1", "conf": 0.8, "bbox": [0.1, 0.1, 0.2, 0.2]},
                                      {"category": "2", "conf": 0.05, "bbox": [0.5, 0.5, 0.1, 0.1]}]},
                      {"file": "b.JPG", "max_detection_conf": 0.0, "detections": []}]}
    p = tmp_path / "det.json"
    p.write_text(json.dumps(det))
    rows = RD.read_detector_json(spark, str(p))
    assert rows.count() == 3
    assert sorted(r.id for r in RD.to_coco(rows, 0.1).collect()) == ["a.JPG_0", "b.JPG_empty"]
    tasks = RD.to_tasks(rows, "http://host/data/", 0.1).collect()
    t = {r.file: json.loads(r.task) for r in tasks}
    assert t["a.JPG"]["data"]["image"] == "http://host/data/a.JPG"
    assert len(t["a.JPG"]["predictions"][0]["result"]) == 1 and t["b.JPG"]["predictions"][0]["result"] == []


def test_tasks_to_long(spark, tmp_path):
    task = {"data": {"image": "img1.JPG"}, "annotations": [{"result": [
        {"id": "r1", "type": "rectanglelabels", "origin": "manual", "to_name": "image", "from_name": "label",
         "original_width": 100, "original_height": 50,
         "value": {"x": 1, "y": 2, "width": 3, "height": 4, "rectanglelabels": ["animal"]}},
        {"id": "r1", "type": "choices", "origin": "manual", "to_name": "image", "from_name": "species",
         "value": {"choices": ["Moose"]}},
        {"id": "r2", "type": "rectanglelabels", "origin": "prediction", "to_name": "image", "from_name": "label",
         "value": {"x": 5, "y": 5, "width": 1, "height": 1, "rectanglelabels": ["animal"]}}]}]}
    p = tmp_path / "tasks.json"
    p.write_text(json.dumps([task]))
    from camstat.schemas import TASK_SCHEMA
    df = spark.read.schema(TASK_SCHEMA).option("multiLine", True).json(str(p))
    rows = {(r.id, r.variable): r for r in RD.tasks_to_long(df).collect()}
    assert rows[("r1", "species")].tag == "Moose" and rows[("r1", "species")].value_x == 1.0
    assert rows[("r2", None)].value_rectanglelabels == "['animal']"


def test_polygons_geojson(spark, tmp_path):
    gj = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "A"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"name": "B"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 2], [3, 2], [3, 3], [2, 2]]],
                                                              [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}}]}
    p = tmp_path / "z.geojson"
    p.write_text(json.dumps(gj))
    v = RD.read_polygons(spark, str(p))
    c = {(r.zone, r.ring): r["count"] for r in v.groupBy("zone", "ring").count().collect()}
    assert c == {("A", 0): 4, ("B", 0): 4, ("B", 1): 4}


def _png(path, w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    path.write_bytes(data)


def test_pixels_one_colour(spark, tmp_path):
    d = tmp_path / "imgs"
    d.mkdir()
    _png(d / "a.png", 4, 3, (200, 100, 50))
    px = IM.read_pixels(spark, str(d))
    r = IM.image_indices(px).first()
    assert (r.r_av, r.g_av, r.b_av) == (200.0, 100.0, 50.0)
    assert r.r_sd == 0.0 and abs(r.gi_av - 100 / 350) < 1e-12


def _jpeg_with_exif(path, dt):
    s = dt.encode() + b"\x00"
    # TIFF: header(8) + IFD0 (2 + 12 + 4) -> exif IFD at 26: (2 + 12 + 4) -> string at 44
    tiff = b"II*\x00" + struct.pack("<I", 8)
    tiff += struct.pack("<H", 1) + struct.pack("<HHII", 0x8769, 4, 1, 26) + struct.pack("<I", 0)
    tiff += struct.pack("<H", 1) + struct.pack("<HHII", 0x9003, 2, len(s), 44) + struct.pack("<I", 0)
    tiff += s
    app1 = b"Exif\x00\x00" + tiff
    path.write_bytes(b"\xff\xd8\xff\xe1" + struct.pack(">H", len(app1) + 2) + app1 + b"\xff\xd9")


def test_capture_times_and_listing(spark, tmp_path):
    root = tmp_path / "dep"
    (root / "P001" / "DCIM" / "100RECNX").mkdir(parents=True)
    (root / "P001_repeat").mkdir()
    _jpeg_with_exif(root / "P001" / "DCIM" / "100RECNX" / "RCNX0001.JPG", "2022:08:19 10:11:12")
    (root / "P001" / "DCIM" / "100RECNX" / "RCNX0002.JPG").write_bytes(b"\xff\xd8\xff\xd9")
    _jpeg_with_exif(root / "P001_repeat" / "x.JPG", "2022:01:01 00:00:00")
    files = RD.list_images(spark, str(root))
    assert sorted(r.rel_path for r in files.collect()) == ["P001/DCIM/100RECNX/RCNX0001.JPG",
                                                          "P001/DCIM/100RECNX/RCNX0002.JPG"]
    t = {r.path.split("/")[-1]: r.exif_date_time_original for r in IM.read_capture_times(spark, str(root / "P001")).collect()}
    assert t == {"RCNX0001.JPG": "2022:08:19 10:11:12", "RCNX0002.JPG": None}


def test_write_and_pending(spark, tmp_path):
    df = spark.range(0, 10).withColumn("part", F.col("id") % 2)
    RD.write_table(df, str(tmp_path / "t"), "parquet", ["part"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 10
    done = spark.range(0, 4)
    assert RD.pending(df, done, "id").count() == 6 and RD.pending(df, done, "id", overwrite=True).count() == 10


def test_stream_ingest_exactly_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k in range(3):
        coco = {"images": [], "annotations": [{"id": f"d{k}{j}", "image_id": f"i{k}", "category_id": 1,
                                               "bbox": [0, 0, 1, 1], "confidence": 0.5} for j in range(2)]}
        (src / f"f{k}_output_coco.json").write_text(json.dumps(coco))
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    ingest_detections(spark, str(src), sink, ck)
    ingest_detections(spark, str(src), sink, ck)           # re-run: nothing new
    assert spark.read.parquet(sink).count() == 6
    (src / "f9_output_coco.json").write_text(json.dumps({"images": [], "annotations": [
        {"id": "z", "image_id": "i9", "category_id": 2, "bbox": [0, 0, 1, 1], "confidence": 0.7}]}))
    ingest_detections(spark, str(src), sink, ck)
    assert spark.read.parquet(sink).count() == 7


def test_stream_sessions_close_with_watermark(spark, tmp_path):
    src = tmp_path / "obs"
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (1, "2024-01-01 03:00:00"),
            (2, "2024-01-01 00:05:00"), (1, "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "camera_id int, t string").select("camera_id", F.to_timestamp("t").alias("date_time"))
    df.coalesce(1).write.parquet(str(src))
    run_sessions(spark, str(src), df.schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    out = {(r.camera_id, r.n_images) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # the last session of camera 1 is still open (watermark), the rest are closed
    assert out == {(1, 2), (1, 1), (2, 1)}


def test_small_table_readers(spark, tmp_path):
    exif = tmp_path / "exif.csv"
    exif.write_text("SourceFile,DateTimeOriginal,MakerNotesUserLabel\n"
                    "/data/store/P901/P901-1/CAM-1/DCIM/100RECNX/RCNX0001.JPG,2022:08:19 10:11:12,CAM-1\n")
    e = RD.read_exif(spark, str(exif), roots=["/data/store/"]).first()
    assert e.source_file == "P901/P901-1/CAM-1/DCIM/100RECNX/RCNX0001.JPG"
    assert e.image_id == "P901-1_CAM-1_DCIM_100RECNX_RCNX0001"
    assert e.maker_notes_user_label == "CAM-1"
    dep = tmp_path / "dep.csv"
    dep.write_text("Plot ID,Camera ID,Date Deployed,Date Retrieved,X,Y\nP901,CAM-1,2022-03-01,2022-10-05,-85.1,52.3\n"
                   "P902,CAM-2,2022-03-02,,-85.2,52.4\n")
    d = {r.camera_id: r for r in RD.read_deployments(spark, str(dep)).collect()}
    assert str(d["CAM-1"].date_retrieved) == "2022-10-05" and d["CAM-2"].date_retrieved is None
    assert d["CAM-1"].longitude == -85.1
    leg = tmp_path / "legend.csv"
    leg.write_text("Code,Category Code,Label\n1,WAT,Clear open water\n")
    g = RD.read_legend(spark, str(leg)).first()
    assert g.code == "1" and g.category_code == "WAT"
    cells = spark.createDataFrame([(16, -85.0, 52.0, 3, 0.5)], "utm int, cx double, cy double, value int, coverage_fraction double")
    cells.write.parquet(str(tmp_path / "cells"))
    assert RD.read_cells(spark, str(tmp_path / "cells")).count() == 1
    lab = tmp_path / "labels.csv"
    lab.write_text("id,filepath,species,Moose,Caribou\n1,a.jpg,Moose,1,0\n")
    assert RD.read_table_csv(spark, str(lab)).first().Moose == 1


def test_image_greenness_matches_pixel_rows(spark, tmp_path):
    d = tmp_path / "g"
    d.mkdir()
    _png(d / "a.png", 3, 2, (40, 200, 60))
    img = IM.read_pixels(spark, str(d))
    r = IM.image_greenness(img).first()
    px = spark.createDataFrame([(1, 40, 200, 60)] * 6, "k int, r int, g int, b int")
    ref = IM.greenness(px, ["k"]).first()
    assert abs(r.hue_mean - ref.hue_mean) < 1e-9 and r.hue_green_share == ref.hue_green_share == 1.0
    assert abs(r.green_ratio - 200 / 100) < 1e-12 and abs(r.green_ratio_as_source - 40 / 260) < 1e-12


def test_stream_sessions_drop_late_images(spark, tmp_path):
    """Images later than the watermark allows are dropped; on-time ones counted."""
    src = tmp_path / "obs2"
    src.mkdir()
    schema = "camera_id int, date_time timestamp"

    def batch(name, rows):
        df = spark.createDataFrame(rows, "camera_id int, t string").select("camera_id", F.to_timestamp("t").alias("date_time"))
        df.coalesce(1).write.mode("overwrite").parquet(str(src / name))

    batch("b1", [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 05:00:00")])
    run_sessions(spark, str(src) + "/*", schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    # 00:10 is more than one hour behind the latest time seen (05:00): too late
    batch("b2", [(1, "2024-01-01 00:10:00"), (1, "2024-01-01 09:00:00")])
    run_sessions(spark, str(src) + "/*", schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    out = sorted((r.session_start.strftime("%H:%M"), r.n_images) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert out == [("00:00", 1), ("05:00", 1)]
