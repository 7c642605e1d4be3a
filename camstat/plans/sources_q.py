"""Sources and sinks as round trips: a given table is written in each format under the shared
folder, read back by the reader, and compared with the table (S1, S2, S4-S18)."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import functions as F

from camstat.functions.ids import is_numeric_id
from camstat.operators.filters import OTHER_SPECIES
from camstat.operators import images as IM
from camstat.operators.reconcile import process_annotations
from camstat.operators.reshape import widen_tags
from camstat.plans import classify_q as CQ
from camstat.plans.extras_q import _EXIF_SQL, _annotation_flow_sql, _exif, _export_files
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.schemas import ANNOTATION_FIELDS, TASK_SCHEMA
from camstat.session import shared_path, written
from camstat.sources import adapters as S
from camstat.sources import readers as RD
from camstat.sources.fileio import write_bytes

THR = 0.5
NOTE = 'first line\nsecond "quoted" line, with a comma'
_NOTE_SQL = "'first line' || chr(10) || 'second \"quoted\" line, with a comma'"
# rows whose notes hold a line break, doubled quotes and a comma
_NOTED_SQL = "length(id) % 5 = 0"


def _csv(df, path, folder=None, compression="none"):
    """CSV as the export tool writes it; ``folder``: one folder per value of that column."""
    w = (df.hint("rebalance", folder).write.partitionBy(folder) if folder else df.write)
    w.options(header=True, quote='"', escape='"', nullValue="NA", compression=compression).csv(path)


def _export_rows(spark, sf):
    """The two exports in the export's long shape: species, other species and notes rows of every box."""
    e = _export_files(spark, sf)
    notes = F.when(F.expr(_NOTED_SQL), F.lit(NOTE))
    tags = F.array(F.struct(F.lit("species").alias("variable"), F.col("species").alias("tag")),
                   F.struct(F.lit("other_species").alias("variable"), F.when(F.col("species") == OTHER_SPECIES, F.lit(S.OTHER_TEXT)).alias("tag")),
                   F.struct(F.lit("notes").alias("variable"), notes.alias("tag")))
    e = e.withColumn("v", F.explode(tags)).select("file", "source_file", "id", "v.variable", "v.tag").withColumns({
        "type": F.lit("choices"), "origin": F.lit("manual"), "to_name": F.lit("image"), "value_text": F.lit(None).cast("string"),
        "value_rectanglelabels": F.when(~is_numeric_id("id"), F.lit("['animal']")),
        **{c: F.lit(float(i)) for i, (c, t) in enumerate(ANNOTATION_FIELDS) if t == "double"}})
    return e.select("file", *[c for c, _ in ANNOTATION_FIELDS])


def _flow_sql():
    inner = _annotation_flow_sql("DISTINCT")  # a box that a file holds twice is one row once widened
    notes = f", CASE WHEN {_NOTED_SQL} THEN {_NOTE_SQL} END AS notes"
    label = "CASE WHEN regexp_matches(id, '^[+-]?[0-9]+$') THEN NULL ELSE 'animal' END AS value_rectanglelabels"
    species = f"CASE WHEN species = '{OTHER_SPECIES}' THEN '{S.OTHER_TEXT}' ELSE species END AS species"
    return f"SELECT project, source_file, id, {species}, {label}{notes} FROM ({inner}) flow"


@register("annotations_from_files", _flow_sql())
def annotations_from_files(spark, sf):
    """S1 + S3 + R1 + section 2.9 + U1: export CSVs read, labels stripped, widened, reconciled and
    united.  Files of odd projects have another column order and one more column."""
    path = shared_path(spark, "exports")
    rows = _export_rows(spark, sf)
    odd = F.regexp_extract("file", r"_P(\d+)_", 1).cast("int") % 2 == 1
    cols = [c for c, _ in ANNOTATION_FIELDS]
    _csv(rows.filter(~odd).select("file", *cols), path + "/even", "file", "gzip")
    _csv(rows.filter(odd).select("file", *reversed(cols), F.col("source_file").alias("source_file_with_dep")), path + "/odd", "file", "gzip")
    name = F.regexp_extract("_metadata.file_path", r"file=([^/]+)/", 1)
    long = RD.strip_labels(RD.read_annotations(spark, path, "*.csv.gz", file=name))
    wide = widen_tags(long.drop("source_file_with_dep")).select("file", "source_file", "id", "species", "value_rectanglelabels", "notes")
    # the flow below uses the rows several times: files are read and widened once
    out, _ = process_annotations(written(wide, "wide-annotations"), "file", ["project", "source_file"])
    return out.select("project", "source_file", "id", "species", "value_rectanglelabels", "notes")


@register("coco_detections_read", with_views(["boxes"], """
SELECT box_id AS id, CAST(image_id AS VARCHAR) AS image_id, category_id, x, y, w, h, confidence FROM boxes"""))
def coco_detections_read(spark, sf):
    """COCO documents, one per line, read in batch."""
    from camstat.streaming.ingest import coco_documents
    path = shared_path(spark, "coco")
    coco_documents(S.boxes(spark, sf)).select("value").write.text(path)
    d = RD.read_detections(spark, path, "*.txt", multi_line=False)
    return d.select("id", "image_id", "category_id", *[F.col("bbox")[i].alias(c) for i, c in enumerate("xywh")], "confidence")


@register("exif_read", with_views([], f"""
SELECT 'P901/' || source_file AS source_file, 'P901_img_' || image_id AS image_id, exif_date_time_original, maker_notes_user_label
FROM ({_EXIF_SQL}) e"""))
def exif_read(spark, sf):
    """EXIF table as CSV with the tool's column names."""
    path = shared_path(spark, "exif")
    e = _exif(spark, sf).select(
        F.concat(F.lit("/store/x/P901/"), F.col("source_file")).alias("SourceFile"),
        F.col("exif_date_time_original").alias("EXIF:DateTimeOriginal"), F.col("maker_notes_user_label").alias("MakerNotes:UserLabel"))
    _csv(e, path)
    # the storage root is removed from the path; its tokens from the image id, whose first token is then dropped
    r = RD.read_exif(spark, path, roots=["/store/x/"])
    return r.select("source_file", F.concat(F.lit("P901_"), F.col("image_id")).alias("image_id"),
                    "exif_date_time_original", "maker_notes_user_label")


@register("deployments_read", with_views(["deployments", "cameras"], """
SELECT d.camera_id, strftime(d.date_deployed, '%Y-%m-%d') AS date_deployed, strftime(d.date_retrieved, '%Y-%m-%d') AS date_retrieved,
       c.lon AS longitude, c.lat AS latitude FROM deployments d JOIN cameras c ON d.camera_id = c.camera_id"""))
def deployments_read(spark, sf):
    """Deployment log sheet as CSV."""
    path = shared_path(spark, "deployments")
    d = S.deployments(spark, sf).join(S.cameras(spark, sf).select("camera_id", "lon", "lat"), "camera_id")
    d.select(F.col("camera_id").alias("Camera ID"), F.col("date_deployed").alias("Date Deployed"),
             F.col("date_retrieved").alias("Date Retrieved"), F.col("lon").alias("X"), F.col("lat").alias("Y")
             ).write.option("header", True).csv(path)
    r = RD.read_deployments(spark, path)
    return r.select(F.col("camera_id").cast("bigint").alias("camera_id"),
                    *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("date_deployed", "date_retrieved")], "longitude", "latitude")


@register("legend_read", with_views([], "SELECT CAST(n_nationkey AS VARCHAR) AS code, upper(n_name) AS category_code, n_name AS label FROM nation"))
def legend_read(spark, sf):
    """Class legend as CSV, codes kept as text (nations stand for classes)."""
    path = shared_path(spark, "legend")
    S.table(spark, sf, "nation").select(F.col("n_nationkey").alias("Code"), F.upper("n_name").alias("Category Code"),
                                        F.col("n_name").alias("Label")).write.option("header", True).csv(path)
    return RD.read_legend(spark, path).select("code", "category_code", "label")


@register("polygons_read", with_views(["cameras"], """
WITH b AS (SELECT plot_id, min(lon) - 1 AS x0, max(lon) + 1 AS x1, min(lat) - 1 AS y0, max(lat) + 1 AS y1 FROM cameras GROUP BY plot_id)
SELECT CAST(plot_id AS VARCHAR) AS zone, v.ring, v.seq, v.x, v.y FROM b,
LATERAL (VALUES (0, 0, x0, y0), (0, 1, x1, y0), (0, 2, x1, y1), (0, 3, x0, y0),
                (1, 0, x0 + 50, y0), (1, 1, x1 + 50, y0), (1, 2, x1 + 50, y1), (1, 3, x0 + 50, y0)) AS v(ring, seq, x, y)
WHERE v.ring = 0 OR plot_id % 2 = 1"""))
def polygons_read(spark, sf):
    """GeoJSON triangles of each plot; odd plots are multi-polygons of two parts."""
    from camstat.operators.spatial import padded_bbox
    path = shared_path(spark, "polygons")
    b = padded_bbox(S.cameras(spark, sf), ["plot_id"], 1.0)

    def ring(dx):
        x0, x1 = F.col("xmin") + dx, F.col("xmax") + dx
        return F.array(*[F.array(x, y) for x, y in ((x0, F.col("ymin")), (x1, F.col("ymin")), (x1, F.col("ymax")), (x0, F.col("ymin")))])

    def collection(kind, coords):
        feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("plot_id").cast("string").alias("name")).alias("properties"),
                           F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")).alias("geometry"))
        return F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))

    odd = F.col("plot_id") % 2 == 1
    b.select(F.when(odd, collection("MultiPolygon", F.array(F.array(ring(0.0)), F.array(ring(50.0)))))
             .otherwise(collection("Polygon", F.array(ring(0.0)))).alias("value")).write.text(path)
    return RD.read_polygons(spark, path, multi_line=False)


@register("cells_read", with_views(["cells"], """
SELECT cell_id, utm, cx, cy, value, coverage_fraction, fmt FROM cells, (VALUES ('csv'), ('parquet')) AS f(fmt)"""))
def cells_read(spark, sf):
    """S8 + S17: raster cells written as CSV and Parquet and read back."""
    path, c = shared_path(spark, "cells"), S.cells(spark, sf)
    out = None
    for fmt in ("csv", "parquet"):
        RD.write_table(c, f"{path}/{fmt}", fmt)
        r = RD.read_cells(spark, f"{path}/{fmt}", fmt).withColumn("fmt", F.lit(fmt))
        out = r if out is None else out.unionByName(r)
    return out


def _jpeg(time: str | None, filler: int) -> bytes:
    """A JPEG header with an EXIF time behind a comment segment of ``filler`` bytes, no image data."""
    comment = b"\xff\xfe" + struct.pack(">H", filler + 2) + b"x" * filler
    if time is None:
        return b"\xff\xd8" + comment + b"\xff\xd9"
    s = time.encode() + b"\x00"
    tiff = b"II*\x00" + struct.pack("<I", 8) + struct.pack("<H", 1) + struct.pack("<HHII", 0x8769, 4, 1, 26) + struct.pack("<I", 0)
    tiff += struct.pack("<H", 1) + struct.pack("<HHII", 0x9003, 2, len(s), 44) + struct.pack("<I", 0) + s
    app1 = b"Exif\x00\x00" + tiff
    return b"\xff\xd8" + comment * 2 + b"\xff\xe1" + struct.pack(">H", len(app1) + 2) + app1 + b"\xff\xd9"


def _write_files(df, make):
    """Write one file per row (columns of ``df`` are the arguments of ``make`` -> path, bytes)."""
    def run(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                write_bytes(*make(*row))
            yield pd.DataFrame({"n": [len(b)]})
    return df.mapInPandas(run, "n long").agg(F.sum("n")).first()[0]


def _image_tree(spark, sf):
    """One image file per supplier: location folders, some with repeats or crops to be skipped."""
    path = shared_path(spark, "images")
    k = F.col("s_suppkey")
    s = S.table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), (k % 9).cast("string"), F.when(k % 9 == 4, "_repeat").when(k % 9 == 5, "_crop").otherwise("")).alias("loc"),
        k.cast("string").alias("k"), F.when(k % 4 != 0, F.date_format(F.timestamp_seconds(k * 86399), "yyyy:MM:dd HH:mm:ss")).alias("t"))
    _write_files(s, lambda loc, n, t: (f"{path}/{loc}/DCIM/IMG_{n}.{'txt' if n.endswith('3') else 'JPG'}", _jpeg(t, 40_000)))
    return path


_TREE_SQL = """
SELECT 'P' || CAST(s_suppkey % 9 AS VARCHAR) || CASE s_suppkey % 9 WHEN 4 THEN '_repeat' WHEN 5 THEN '_crop' ELSE '' END AS location,
       s_suppkey AS k, CASE WHEN s_suppkey % 4 <> 0 THEN strftime(make_timestamp(CAST(s_suppkey AS BIGINT) * 86399000000), '%Y:%m:%d %H:%M:%S') END AS t
FROM supplier WHERE s_suppkey % 10 <> 3"""


@register("image_listing", with_views([], f"""
SELECT location, location || '/DCIM/IMG_' || CAST(k AS VARCHAR) || '.JPG' AS rel_path FROM ({_TREE_SQL}) t
WHERE NOT contains(location, 'repeat') AND NOT contains(location, 'crop')"""))
def image_listing(spark, sf):
    """Images under a folder, skipped folders and other files left out."""
    return RD.list_images(spark, _image_tree(spark, sf)).select("location", "rel_path")


@register("capture_times", with_views([], f"""
SELECT k, t AS exif_date_time_original, t IS NOT NULL AS has_time FROM ({_TREE_SQL}) t"""))
def capture_times(spark, sf):
    """S10 + P4: capture time from EXIF headers that stand behind 80 KB of other segments."""
    t = IM.read_capture_times(spark, _image_tree(spark, sf))
    return t.select(F.regexp_extract("path", r"IMG_(\d+)", 1).cast("bigint").alias("k"), "exif_date_time_original", "has_time")


def _png(rgb: bytes, width: int, height: int) -> bytes:
    raw = b"".join(b"\x00" + rgb[i * width * 3:(i + 1) * width * 3] for i in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def _pixel_files(spark, sf):
    """Every vector as an image file of its 22 pixels (11 x 2)."""
    path = shared_path(spark, "pixels")
    px = CQ._pixels(spark, sf).groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("pixel", "r", "g", "b"))).alias("p"))
    flat = px.select("vec_id", F.flatten(F.transform("p", lambda x: F.array(x["r"], x["g"], x["b"]))).alias("rgb"))
    _write_files(flat, lambda k, rgb: (f"{path}/{k}.png", _png(bytes(int(v) for v in rgb), 11, 2)))
    return IM.read_pixels(spark, path)


def _vec_id():
    return F.regexp_extract("path", r"(\d+)\.png$", 1).cast("bigint").alias("vec_id")


@register("image_colour_indices", with_views([], CQ._ci_sql(), {"px": CQ._PIX_SQL}))
def image_colour_indices(spark, sf):
    """S11 + A29 + P2: colour statistics of decoded image files."""
    return IM.image_indices(_pixel_files(spark, sf)).select(_vec_id(), *IM.INDEX_COLUMNS)


@register("image_greenness", CQ.GREENNESS_SQL)
def image_greenness(spark, sf):
    """S11 + A30 + P2: greenness of decoded image files."""
    g = IM.image_greenness(_pixel_files(spark, sf))
    return g.select(_vec_id(), "hue_mean", "hue_green_share", "green_ratio_as_source", "green_ratio")


@register("image_crops", with_views([], """
SELECT k AS vec_id, 'Moose_' || CAST(k AS VARCHAR) || '_1.JPG' AS crop_name, 5 AS crop_w, 1 AS crop_h,
       r AS first_red FROM (SELECT vec_id AS k, r FROM px WHERE pixel = 3) x WHERE k % 3 <> 0""", {"px": CQ._PIX_SQL}))
def image_crops(spark, sf):
    """P3 + S18 + F20: crops still to be made, cut from decoded images (5 pixels of the first row).
    Each file is opened and decoded once: manifest and crops read the decoded images."""
    img = _pixel_files(spark, sf)
    # the reader packs 32 small files to a task; fewer, longer tasks write as many fewer tables
    img = written(img.coalesce(8 * spark.sparkContext.defaultParallelism), "decoded")
    anns = img.select("path", F.concat_ws("_", _vec_id(), F.lit("1")).alias("id"), F.lit("Moose").alias("species"),
                      F.lit(11.0).alias("original_width"), F.lit(2.0).alias("original_height"),
                      F.lit(3 * 100 / 11 + 0.1).alias("value_x"), F.lit(0.0).alias("value_y"),
                      F.lit(5 * 100 / 11 - 0.1).alias("value_width"), F.lit(50.0).alias("value_height"))
    todo = IM.crop_manifest(anns)
    done = todo.filter(F.regexp_extract("crop_name", r"_(\d+)_", 1).cast("bigint") % 3 == 0).select("crop_name")
    c = IM.crop_pixels(img, RD.pending(todo, done, "crop_name"))
    return c.select(F.regexp_extract("crop_name", r"_(\d+)_", 1).cast("bigint").alias("vec_id"), "crop_name", "crop_w", "crop_h",
                    F.conv(F.hex(F.substring("crop", 3, 1)), 16, 10).cast("bigint").alias("first_red"))


def _detector_images(spark, sf):
    """Detector output with one image per document: its boxes, none for images divisible by 5."""
    b = S.boxes(spark, sf)
    det = F.struct("box_id", (F.col("category_id") % 3 + 1).cast("string").alias("category"), (F.col("confidence") / 1.0).alias("conf"),
                   F.array(F.col("x") / 100, F.col("y") / 100, F.col("w") / 100, F.col("h") / 100).alias("bbox"))
    g = b.groupBy("image_id").agg(F.sort_array(F.collect_list(F.when(F.col("image_id") % 5 != 0, det))).alias("d"), F.max("confidence").alias("m"))
    return g.select("image_id", F.concat(F.col("image_id").cast("string"), F.lit(".JPG")).alias("file"), F.col("m").alias("max_detection_conf"),
                    F.transform("d", lambda x: x.dropFields("box_id")).alias("detections"))


def _detector_rows(spark, sf):
    path = shared_path(spark, "detector")
    im = F.struct("file", "max_detection_conf", "detections")
    _detector_images(spark, sf).select(F.to_json(F.struct(F.array(im).alias("images"))).alias("value")).write.text(path)
    return RD.read_detector_json(spark, path, multi_line=False)


_DET_SQL = """
SELECT CAST(i.image_id AS VARCHAR) || '.JPG' AS file, i.m AS max_detection_conf, b.box, b.category, b.conf, b.x, b.y, b.w, b.h
FROM (SELECT image_id, max(confidence) AS m FROM boxes GROUP BY image_id) i LEFT JOIN (
  SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY box_id, category_id % 3, confidence, x, y, w, h) - 1 AS box, category_id % 3 + 1 AS category, confidence AS conf,
         x / 100 AS x, y / 100 AS y, w / 100 AS w, h / 100 AS h FROM boxes WHERE image_id % 5 <> 0) b ON i.image_id = b.image_id"""


@register("detector_json_read", with_views(["boxes"], _DET_SQL))
def detector_json_read(spark, sf):
    """Detector JSON to one row per detection, images without one kept."""
    r = _detector_rows(spark, sf)
    return r.select("file", "max_detection_conf", "box", "category", "conf", *[F.col("bbox")[i].alias(c) for i, c in enumerate("xywh")])


@register("detections_to_coco", with_views(["boxes"], f"""
SELECT file || '_' || CAST(box AS VARCHAR) AS id, file AS image_id, category AS category_id, x, conf AS confidence,
       max_detection_conf AS max_confidence, FALSE AS isempty FROM det WHERE conf >= {THR}
UNION ALL
SELECT file || '_empty', file, 0, NULL, NULL, max(max_detection_conf), TRUE FROM det GROUP BY file
HAVING count(*) FILTER (WHERE conf >= {THR}) = 0""", {"det": _DET_SQL}))
def detections_to_coco(spark, sf):
    """S14 + S2: detections to COCO documents and back; unique ids, empty images kept."""
    path = shared_path(spark, "to-coco")
    RD.coco_collections(_detector_rows(spark, sf), THR).select("value").write.text(path)
    d = RD.read_detections(spark, path, "*.txt", multi_line=False)
    return d.select("id", "image_id", "category_id", F.col("bbox")[0].alias("x"), "confidence", "max_confidence", "isempty")


@register("detections_to_tasks", with_views(["boxes"], f"""
SELECT 'http://host/data/' || i.file AS image, d.label, d.x, d.score FROM (SELECT DISTINCT file FROM det) i LEFT JOIN (
  SELECT file, CASE category WHEN 1 THEN 'animal' WHEN 2 THEN 'person' WHEN 3 THEN 'vehicle' END AS label, x * 100 AS x, conf AS score
  FROM det WHERE conf >= {THR}) d ON i.file = d.file""", {"det": _DET_SQL}))
def detections_to_tasks(spark, sf):
    """One task per image, boxes labelled by category, images without a strong box kept."""
    t = RD.to_tasks(_detector_rows(spark, sf), "http://host/data/", THR)
    kind = ("data struct<image: string>, predictions array<struct<result: array<struct<type: string, "
            "value: struct<x: double, rectanglelabels: array<string>>, score: double>>>>")
    p = t.select(F.from_json("task", kind).alias("t")).select(F.col("t.data.image").alias("image"), F.explode_outer(F.col("t.predictions")[0]["result"]).alias("r"))
    return p.select("image", F.col("r.value.rectanglelabels")[0].alias("label"), F.col("r.value.x").alias("x"), F.col("r.score").alias("score"))


_BEHAVIOR_SQL = "['Feeding', 'Lying', 'Standing', 'Travelling'][1:CAST(l_partkey % 3 + 1 AS INTEGER)]"


def _task_rows(spark, sf):
    """Annotation tasks, one per image, with a rectangle, a single choice, a multiple choice and a comment."""
    # only the keys of a task's regions are gathered; its results are built from them afterwards
    g = S.annotation_ids(spark, sf).groupBy("l_orderkey").agg(F.collect_list(F.struct("id", "l_partkey")).alias("regions"))
    nothing = {"x": "double", "y": "double", "width": "double", "height": "double", "rectanglelabels": "array<string>",
               "choices": "array<string>", "text": "array<string>"}

    def result(id_, name, kind, **value):
        v = F.struct(*[(value.get(c, F.lit(None)).cast(t)).alias(c) for c, t in nothing.items()])
        return F.struct(id_.alias("id"), F.lit(kind).alias("type"), F.lit("manual").alias("origin"), F.lit("image").alias("to_name"),
                        F.lit(name).alias("from_name"), F.lit(1920.0).alias("original_width"), F.lit(1080.0).alias("original_height"),
                        v.alias("value"))

    def results(region):
        id_, k = region["id"], region["l_partkey"]
        behaviors = F.slice(F.array(*map(F.lit, ("Feeding", "Lying", "Standing", "Travelling"))), 1, (k % 3 + 1).cast("int"))
        return F.array_compact(F.array(
            result(id_, "label", "rectanglelabels", x=k % 90, y=k % 80, width=F.lit(5), height=F.lit(6), rectanglelabels=F.array(F.lit("animal"))),
            F.when(k % 4 != 0, result(id_, "species", "choices", choices=F.array(F.lit("Moose")))),
            F.when(k % 4 != 0, result(id_, "behavior", "choices", choices=behaviors)),
            F.when(k % 7 == 0, result(id_, "comment", "textarea", text=F.array(F.lit("one"), F.lit("two"))))))

    g = g.select("l_orderkey", F.flatten(F.transform("regions", results)).alias("result"))
    return g.select(F.to_json(F.struct(
        F.struct(F.concat(F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit(".JPG")).alias("image")).alias("data"),
        F.array(F.struct("result")).alias("annotations"))).alias("value"))


_TASK_SQL = f"""
SELECT 'img_' || CAST(l_orderkey AS VARCHAR) || '.JPG' AS source_file, id, variable, tag, value_text, l_partkey % 90 AS value_x FROM (
  SELECT *, 'species' AS variable, 'Moose' AS tag, NULL AS value_text FROM annotation_ids WHERE l_partkey % 4 <> 0
  UNION ALL SELECT *, 'behavior', unnest({_BEHAVIOR_SQL}), NULL FROM annotation_ids WHERE l_partkey % 4 <> 0
  UNION ALL SELECT *, 'comment', NULL, unnest(['one', 'two']) FROM annotation_ids WHERE l_partkey % 7 = 0
  UNION ALL SELECT *, NULL, NULL, NULL FROM annotation_ids WHERE l_partkey % 4 = 0 AND l_partkey % 7 <> 0) t"""


def _task_long(spark, sf):
    path = shared_path(spark, "tasks")
    _task_rows(spark, sf).write.option("compression", "gzip").text(path)
    return RD.tasks_to_long(spark.read.schema(TASK_SCHEMA).json(path))


@register("tasks_long_multichoice", with_views(["annotation_ids"], _TASK_SQL))
def tasks_long_multichoice(spark, sf):
    """Annotation tasks to long rows, every choice and every text entry kept."""
    return _task_long(spark, sf).select("source_file", "id", "variable", "tag", "value_text", "value_x")


@register("tags_wide_multichoice", with_views(["annotation_ids"], f"""
SELECT id, species, array_to_string(list_sort(behavior), ', ') AS behavior FROM (
  SELECT id, max(tag) FILTER (WHERE variable = 'species') AS species, list(DISTINCT tag) FILTER (WHERE variable = 'behavior') AS behavior
  FROM ({_TASK_SQL}) t WHERE value_text IS NULL AND variable IS NOT NULL GROUP BY id) w"""))
def tags_wide_multichoice(spark, sf):
    """S13 + R1: multiple choices joined in one cell."""
    long = _task_long(spark, sf).filter(F.col("variable").isNotNull())
    return widen_tags(long).select("id", "species", "behavior")


@register("label_csv_read", with_views([], "SELECT doc_id, quality, toxic FROM labels"))
def label_csv_read(spark, sf):
    """Label table as CSV with inferred types."""
    path = shared_path(spark, "labels")
    S.table(spark, sf, "labels").write.option("header", True).csv(path)
    return RD.read_table_csv(spark, path)


@register("table_sinks", with_views([], """
SELECT f.fmt, event_type, count(*) AS n, min(event_id) AS first_id FROM events, (VALUES ('csv'), ('json'), ('parquet')) AS f(fmt)
GROUP BY f.fmt, event_type"""))
def table_sinks(spark, sf):
    """S17 + R5: a table split by value into folders in three formats, read back."""
    path, e = shared_path(spark, "sinks"), S.table(spark, sf, "events").select("event_id", "event_type", "user_id")
    out = None
    for fmt in ("csv", "json", "parquet"):
        RD.write_table(e.hint("rebalance", "event_type"), f"{path}/{fmt}", fmt, partition_by=["event_type"])
        r = spark.read.format(fmt).schema("event_id long, user_id long, event_type string").option("header", True).load(f"{path}/{fmt}")
        g = r.groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id")).withColumn("fmt", F.lit(fmt))
        out = g if out is None else out.unionByName(g)
    return out


@register("pending_images", with_views(["boxes"], """
SELECT DISTINCT image_id FROM boxes WHERE image_id NOT IN (SELECT image_id FROM boxes WHERE origin = 'manual')"""))
def pending_images(spark, sf):
    """Images without any finished (manual) box."""
    b = S.boxes(spark, sf)
    return RD.pending(b.select("image_id").distinct(), b.filter(F.col("origin") == "manual").select("image_id"), "image_id")
