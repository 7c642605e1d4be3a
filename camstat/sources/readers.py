"""Scans (S1, S2, S4-S9, S12, S13, S16) and writers.

Every reader is a declarative Spark scan (schema given, not inferred, where the
format is known) followed by expressions, so column pruning and filters reach
the file source.  Lists of files are handled by the multi-file scan itself
(glob / ``recursiveFileLookup`` / ``pathGlobFilter``), never by a driver loop
that grows a frame.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camstat.functions.ids import drop_first_token
from camstat.operators.filters import category_label, clean_names
from camstat.operators.joins import join_back
from camstat.operators.reshape import union_fill
from camstat.session import written
from camstat.sources.fileio import first_line
from camstat.schemas import ANNOTATION_FIELDS, COCO_SCHEMA, DETECTOR_SCHEMA, GEOJSON_SCHEMA, TASK_SCHEMA  # noqa: F401


def read_annotations(spark: SparkSession, path: str, pattern: str = "*output.csv",
                     file: Column | None = None) -> DataFrame:
    """Annotation export CSVs.  The 15 known columns get their fixed types; any extra
    columns are kept as text; ``NA`` is null; the export file name is kept in ``file`` (or
    what the given expression makes of ``_metadata``).

    Files may differ in column order and in extra columns: they are grouped by their header
    line (read from the file start in tasks), each kind of header is scanned with its own schema
    and keeps the rows of its files (a table of paths, not a list), and the kinds are joined by
    name, missing columns null.  Fields may hold line breaks and
    doubled quotes.  No files give an empty table of the known columns."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
             .load(path).select("path", F.col("_metadata.file_path").alias("uri")))

    def heads(batches):
        for b in batches:
            yield b.assign(header=[first_line(p) for p in b["path"]])

    headed = written(files.mapInPandas(heads, "path string, uri string, header string"), "headers")
    kinds = [r["header"] for r in headed.select("header").distinct().orderBy("header").collect()]  # one row per kind of header
    few = headed.count() <= 100_000
    known = dict(ANNOTATION_FIELDS)
    name = F.col("_metadata.file_name") if file is None else file
    parts = []
    for head in kinds:
        names = next(csv.reader([head]))
        if not any(names):
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        df = (spark.read.schema(schema).option("header", True).option("nullValue", "NA").option("multiLine", True)
              .option("quote", '"').option("escape", '"').option("pathGlobFilter", pattern).option("recursiveFileLookup", True).csv(path))
        df = df.select("*", name.alias("__name"), F.col("_metadata.file_path").alias("__uri"))
        if len(kinds) > 1:
            own = headed.where(F.col("header") == head).select(F.col("uri").alias("__own"))
            if few:  # paths stay a table; a small one goes to the rows
                own = F.broadcast(own)
            df = df.join(own, F.col("__uri") == F.col("__own"), "left_semi")
        cols = [F.col(f"`{c}`").cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in names]
        missing = [F.lit(None).cast(t).alias(c) for c, t in ANNOTATION_FIELDS if c not in names]
        parts.append(df.select(*cols, *missing, F.col("__name").alias("file")))
    if not parts:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T._parse_datatype_string(t)) for c, t in [*ANNOTATION_FIELDS, ("file", "string")]]))
    return union_fill(*parts)


def strip_labels(df: DataFrame, col: str = "value_rectanglelabels") -> DataFrame:
    """The export writes a label list as ``['animal']``; keep what stands between the brackets."""
    return df.withColumn(col, F.regexp_replace(F.regexp_replace(F.col(col), r"\['", ""), r"'\]", ""))


def read_detections(spark: SparkSession, root: str, pattern: str = "*output_coco.json",
                    multi_line: bool = True) -> DataFrame:
    """COCO detection files anywhere under ``root``: the ``annotations`` array
    flattened to one row per box, names snake-cased, source file kept.  One document per
    file, or (``multi_line=False``) one per line, which large files can be split by."""
    df = (spark.read.schema(COCO_SCHEMA).option("multiLine", multi_line).option("recursiveFileLookup", True)
          .option("pathGlobFilter", pattern).json(root))
    out = df.select(F.explode("annotations").alias("a"), F.col("_metadata.file_path").alias("file")).select("a.*", "file")
    return clean_names(out)


def read_exif(spark: SparkSession, path: str, roots: list[str] | None = None) -> DataFrame:
    """EXIF table (CSV, header; values stay text, so no pass to infer types);
    snake-case names; ``source_file`` made relative to the storage roots; ``image_id`` =
    path with ``/`` -> ``_``, ``.JPG`` removed (a regex, as in the source) and the first
    token dropped."""
    df = clean_names(spark.read.option("header", True).csv(path))
    img = F.regexp_replace(F.replace(F.col("source_file"), F.lit("/"), F.lit("_")), ".JPG", "")
    src = F.col("source_file")
    for r in roots or []:
        src = F.regexp_replace(src, "^" + _re(r), "")
        img = F.regexp_replace(img, "^" + _re(r.replace("/", "_")), "")
    return df.withColumns({"source_file": src, "image_id": drop_first_token(img)})


def read_deployments(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Deployment log exported to CSV / Parquet; names snake-cased, dates
    typed, ``x/y`` renamed to ``longitude/latitude``."""
    r = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = clean_names(r.format(fmt).load(path))
    df = df.withColumns({c: F.to_date(F.col(c)) for c in ("date_deployed", "date_retrieved") if c in df.columns})
    df = df.withColumnsRenamed({"x": "longitude", "y": "latitude"})
    return df.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude") if c in df.columns})


def read_key_values(spark: SparkSession, path: str, skip: tuple[int, ...] = (3,)) -> DataFrame:
    """The log's summary sheet (CSV without header) as ``key, value``; the rows numbered
    ``skip`` (from 1) are no entries.  A sheet is one small file."""
    rows = spark.read.schema("key string, value string").option("header", False).csv(path)
    at = F.monotonically_increasing_id() + 1  # one unsplit file: row numbers
    return rows.coalesce(1).withColumn("_at", at).filter(~F.col("_at").isin(*skip)).drop("_at")


def read_legend(spark: SparkSession, path: str) -> DataFrame:
    """Land-cover legend; all columns, the raster code included, are text."""
    return clean_names(spark.read.option("header", True).csv(path))


def read_polygons(spark: SparkSession, path: str, name_prop: str = "name", multi_line: bool = True) -> DataFrame:
    """GeoJSON polygons (lon/lat) -> vertex rows ``(zone, ring, seq, x, y)``.
    Polygon and MultiPolygon are both read; the rings of a multi-polygon are
    numbered across its parts.  One collection per file, or per line."""
    # coordinates are declared as text: the JSON source keeps the raw nested
    # array, parsed below for either geometry type
    raw = spark.read.schema(GEOJSON_SCHEMA).option("multiLine", multi_line).json(path)
    f = raw.select(F.explode("features").alias("f")).select(
        F.col("f.properties").getItem(name_prop).alias("zone"), F.col("f.geometry.type").alias("gtype"),
        F.col("f.geometry.coordinates").alias("coords"))
    poly = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
    multi = T.ArrayType(poly)
    rings = F.when(F.col("gtype") == "Polygon", F.from_json("coords", poly)).otherwise(
        F.flatten(F.from_json("coords", multi)))
    r = f.select("zone", F.posexplode(rings).alias("ring", "pts"))
    p = r.select("zone", "ring", F.posexplode("pts").alias("seq", "pt"))
    return p.select("zone", "ring", "seq", F.col("pt")[0].alias("x"), F.col("pt")[1].alias("y"))


CELL_FIELDS = "cell_id bigint, utm int, cx double, cy double, value bigint, coverage_fraction double"


def read_cells(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = CELL_FIELDS) -> DataFrame:
    """Raster exported as a cell table ``(cell_id, utm, cx, cy, value, coverage_fraction)``."""
    r = spark.read.schema(schema).option("header", True) if fmt == "csv" else spark.read
    return r.format(fmt).load(path)


# fixed values: image file extensions and folder names skipped by the listing
IMAGE_EXT = r"\.(jpg|jpeg|JPG|JPEG)$"
SKIP_FOLDERS = ["repeat", "crop"]


def list_images(spark: SparkSession, root: str, ext: str = IMAGE_EXT, subset: list[str] | None = None
                ) -> DataFrame:
    """Every image under ``root`` (recursive) with its location folder (first
    level), relative path and size; folders whose name contains ``repeat`` or
    ``crop`` are skipped; optional location subset.  Only metadata columns are
    selected, so file contents are never read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    base = root.rstrip("/") + "/"
    rel = F.regexp_replace(F.regexp_replace(F.col("path"), "^file:", ""), "^.*?" + _re(base.replace("file:", "")), "")
    df = files.withColumn("rel_path", rel).withColumn("location", F.split("rel_path", "/")[0])
    df = df.filter(F.col("path").rlike(ext))
    for s in SKIP_FOLDERS:
        df = df.filter(~F.col("location").contains(s))
    if subset:
        df = df.filter(F.col("location").isin(*subset))
    return df


def read_detector_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Detector batch output (images -> detections) as one row per detection, numbered
    in its image (``box``, from 0); images without detections keep one row with null
    detection fields.  One document per file, or one per line."""
    df = spark.read.schema(DETECTOR_SCHEMA).option("multiLine", multi_line).json(path)
    im = df.select(F.explode_outer("images").alias("im")).filter(F.col("im").isNotNull())
    d = im.select(F.col("im.file").alias("file"), F.col("im.max_detection_conf").alias("max_detection_conf"),
                  F.posexplode_outer("im.detections").alias("box", "d"))
    return d.select("file", "max_detection_conf", "box", F.col("d.category").cast("int").alias("category"),
                    F.col("d.conf").alias("conf"), F.col("d.bbox").alias("bbox"))


def to_coco(dets: DataFrame, thr: float = 0.1) -> DataFrame:
    """Detector rows -> COCO annotation rows at or above a confidence, ids unique by box
    number; an image without such a box keeps one row that says so (``isempty``)."""
    strong = F.col("conf") >= thr
    per_image = dets.groupBy("file").agg(F.max("max_detection_conf").alias("_max"), F.count_if(strong).alias("_n"))
    boxes = dets.filter(strong).select(
        F.concat_ws("_", "file", "box").alias("id"), F.col("file").alias("image_id"), F.col("category").alias("category_id"),
        "bbox", F.col("conf").alias("confidence"), F.col("max_detection_conf").alias("max_confidence"), F.lit(False).alias("isempty"))
    empty = per_image.filter("_n = 0").select(
        F.concat(F.col("file"), F.lit("_empty")).alias("id"), F.col("file").alias("image_id"), F.lit(0).alias("category_id"),
        F.lit(None).cast("array<double>").alias("bbox"), F.lit(None).cast("double").alias("confidence"),
        F.col("_max").alias("max_confidence"), F.lit(True).alias("isempty"))
    return boxes.unionByName(empty)


def coco_collections(dets: DataFrame, thr: float = 0.1) -> DataFrame:
    """One COCO document per image (JSON text in ``value``): ``images``, ``annotations``."""
    rows = to_coco(dets, thr)
    ann = F.struct("id", "image_id", "category_id", "bbox", "confidence", "max_confidence", "isempty")
    img = F.array(F.struct(F.col("image_id").alias("id"), F.col("image_id").alias("file_name")))
    g = rows.groupBy("image_id").agg(F.sort_array(F.collect_list(ann)).alias("annotations"))
    return g.select("image_id", F.to_json(F.struct(img.alias("images"), "annotations")).alias("value"))


def to_tasks(dets: DataFrame, root_url: str, thr: float = 0.1) -> DataFrame:
    """One annotation task (JSON text) per image, images without a box included: image
    URL = root + path, boxes at or above ``thr`` as predictions (percent coordinates), each
    labelled by its category.  Per-image box lists are small (one image's detections)."""
    label = F.lower(category_label("category"))
    res = F.struct(F.col("box"), F.lit("rectanglelabels").alias("type"), F.lit("image").alias("to_name"),
                   F.lit("label").alias("from_name"),
                   F.struct((F.col("bbox")[0] * 100).alias("x"), (F.col("bbox")[1] * 100).alias("y"),
                            (F.col("bbox")[2] * 100).alias("width"), (F.col("bbox")[3] * 100).alias("height"),
                            F.array(label).alias("rectanglelabels")).alias("value"),
                   F.col("conf").alias("score"))
    g = dets.groupBy("file").agg(F.sort_array(F.collect_list(F.when(F.col("conf") >= thr, res))).alias("_r"))
    plain = F.transform("_r", lambda r: r.dropFields("box"))
    task = F.struct(F.struct(F.concat(F.lit(root_url), F.col("file")).alias("image")).alias("data"),
                    F.array(F.struct(plain.alias("result"))).alias("predictions"))
    return g.select(F.col("file"), F.to_json(task).alias("task"))


def tasks_to_long(tasks: DataFrame, source: str = "annotations") -> DataFrame:
    """Nested annotation tasks -> long rows in the export's 15-column shape: one row per
    region, variable and value (every choice of a multiple choice, every text entry).
    Region geometry comes from the rectangle result sharing the region id."""
    t = tasks.select(F.col("data.image").alias("source_file"), F.explode(source).alias("ann"))
    r = t.select("source_file", F.explode("ann.result").alias("r")).select("source_file", "r.*")
    is_box = F.col("value.x").isNotNull()
    label = F.concat(F.lit("['"), F.array_join("value.rectanglelabels", "', '"), F.lit("']"))
    shape = {"original_width": F.col("original_width"), "original_height": F.col("original_height"),
             **{f"value_{c}": F.col(f"value.{c}") for c in ("x", "y", "width", "height")}, "value_rectanglelabels": label}
    # The results move once, to their region, with the values that they hold; rows are made there.
    n_values = F.coalesce(F.array_size("value.choices"), F.lit(0)) + F.coalesce(F.array_size("value.text"), F.lit(0))
    r = r.select("source_file", "id", "type", "origin", "to_name", F.col("from_name").alias("variable"), is_box.alias("_box"),
                 F.when(is_box, F.struct(*[v.alias(c) for c, v in shape.items()])).alias("_shape"),
                 F.col("value.choices").alias("_choices"), F.col("value.text").alias("_texts"), n_values.alias("_n"))
    region = Window.partitionBy("source_file", "id")
    r = r.withColumns({"_tagged": F.sum("_n").over(region) > 0,
                       **{c: F.first(F.col(f"_shape.{c}"), True).over(region) for c in shape}})
    row = "struct<variable: string, tag: string, value_text: string>"
    none = F.lit(None).cast("string")
    # A null id belongs to no region, so a box without an id is untagged.
    alone = F.col("_box") & (~F.col("_tagged") | F.col("source_file").isNull() | F.col("id").isNull())
    rows = F.concat(
        F.coalesce(F.transform("_choices", lambda c: F.struct(F.col("variable"), c.alias("tag"), none.alias("value_text"))), F.array().cast(f"array<{row}>")),
        F.coalesce(F.transform("_texts", lambda c: F.struct(F.col("variable"), none.alias("tag"), c.alias("value_text"))), F.array().cast(f"array<{row}>")),
        F.when(alone, F.array(F.struct(none.alias("variable"), none.alias("tag"), none.alias("value_text")))).otherwise(F.array().cast(f"array<{row}>")))
    long = r.withColumn("_row", F.explode(rows)).drop("variable").select("*", "_row.*")
    return long.select(*[c for c, _ in ANNOTATION_FIELDS])


def read_table_csv(spark: SparkSession, path: str) -> DataFrame:
    """Label / prediction CSVs (header, inferred types)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Table sink (Parquet by default; CSV with header; JSON lines)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def pending(work: DataFrame, done: DataFrame, key: str | list[str], overwrite: bool = False) -> DataFrame:
    """Work items whose output does not exist yet (all items when
    ``overwrite``).  A null key is done where the other side holds one."""
    keys = [key] if isinstance(key, str) else list(key)
    return work if overwrite else join_back(work, done.select(*keys).distinct(), keys, "left_anti")


def _re(s: str) -> str:
    import re
    return re.escape(s)
