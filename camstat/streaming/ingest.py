"""Incremental, exactly-once ingest of new detection files.

New COCO files dropped under a folder are flattened to box rows and appended to
a Parquet table.  The file source tracks processed files in the checkpoint,
and the Parquet sink commits each micro-batch atomically, so re-runs after a
failure neither skip nor duplicate files.  ``availableNow`` processes what is
there and stops -- the batch-style resume of the source workflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from camstat.operators.filters import clean_names
from camstat.schemas import COCO_SCHEMA


def detection_stream(spark: SparkSession, root: str, pattern: str = "*output_coco.json",
                     max_files: int = 10_000, multi_line: bool = True) -> DataFrame:
    """COCO documents as a stream: one document per file (``multi_line``) or one
    per line (JSON lines, e.g. one image per line)."""
    s = (spark.readStream.schema(COCO_SCHEMA).option("multiLine", multi_line).option("pathGlobFilter", pattern)
         .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).json(root))
    out = s.select(F.explode("annotations").alias("a"), F.col("_metadata.file_path").alias("file")).select("a.*", "file")
    return clean_names(out)


def ingest_detections(spark: SparkSession, root: str, sink: str, checkpoint: str,
                      pattern: str = "*output_coco.json", multi_line: bool = True, max_files: int = 10_000):
    """Run once over all files not yet ingested; returns the finished query."""
    q = (detection_stream(spark, root, pattern, max_files, multi_line).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", sink).option("compression", "zstd")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def coco_documents(boxes: DataFrame, *also: str) -> DataFrame:
    """Box rows -> one COCO document per image (JSON text) with its folder (and columns ``also``
    that follow from it); an image's boxes are a small group, put in order of their ids."""
    ann = F.struct(F.col("box_id").alias("id"), F.col("image_id").cast("string").alias("image_id"),
                   F.col("category_id").cast("int").alias("category_id"),
                   F.array("x", "y", "w", "h").alias("bbox"), F.col("confidence").alias("confidence"))
    keys = [*also, "folder", "image_id"]
    # rows are sorted once, by image; a list's first row stands for the image
    w = Window.partitionBy(*keys).orderBy("box_id")
    g = boxes.select(*keys, F.collect_list(ann).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("annotations"),
                     F.row_number().over(w).alias("_row")).where("_row = 1")
    img = F.array(F.struct(F.col("image_id").cast("string").alias("id"),
                           F.concat(F.col("image_id").cast("string"), F.lit(".JPG")).alias("file_name")))
    return g.select(*also, "folder", F.to_json(F.struct(img.alias("images"), "annotations")).alias("value"))


def export_documents(boxes: DataFrame, part: Column, path: str, mode: str = "errorifexists") -> None:
    """Box rows as COCO documents (compressed JSON lines, ``*.txt.snappy``) in one folder for each value
    of ``part``, which follows from the camera folder; ``overwrite`` replaces the folders that get rows.

    The box rows move once: a range of (part, folder, image) holds whole documents of few parts, and a
    large part is cut between its images, so files grow with the bytes and not with the cameras."""
    ranges = boxes.withColumn("part", part).repartitionByRange("part", "folder", "image_id")
    (coco_documents(ranges, "part").select("part", "value").write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy("part").text(path))
