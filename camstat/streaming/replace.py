"""T1 + S18 with overwrite: ingest that follows replaced and removed files.

The file source of a stream reads each path once, so a corrected file under its old name would be missed.  Here a ledger
holds the version (modification time, length) of every file that the sink reflects.  A run compares the folder's listing with it; every
sub-folder with a new, changed or vanished file is read again as it is now and takes the place of its partition in the
sink, and only then do its versions enter the ledger.  A run that fails in between finds the same differences again and swaps the same
partitions once more, so each file's rows are there once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.operators.filters import clean_names
from camstat.schemas import COCO_SCHEMA
from camstat.session import written

# fixed value: files of so many bytes on average are written as they are read
LARGE_FILES = 1 << 20

_VERSIONS = "folder string, path string, changed timestamp, length long, gone boolean, run long"


def listing(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(folder, path, changed, length) of all files in the sub-folders of ``root`` (first level); contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
             .select("path", F.col("modificationTime").alias("changed"), "length"))
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    return files.withColumn("folder", F.split(F.substring_index("path", base + "/", -1), "/")[0])


def versions(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's last word on every path that is not gone."""
    try:
        entries = spark.read.schema(_VERSIONS).parquet(ledger)
    except AnalysisException:  # before the first run
        entries = spark.createDataFrame([], _VERSIONS)
    last = entries.groupBy("path").agg(F.max_by(F.struct("folder", "changed", "length", "gone"), "run").alias("v"), F.max("run").alias("run"))
    return last.where("NOT v.gone").select("v.folder", "path", "v.changed", "v.length", "run")


def ingest_current(spark: SparkSession, root: str, sink: str, ledger: str, pattern: str = "*.json", multi_line: bool = True,
                   before_ledger=None) -> int:
    """Bring ``sink`` (Parquet, partitioned by ``folder``) up to the COCO files under ``root``; returns the number of sub-folders that
    were swapped.  ``before_ledger`` is called between the swap and the ledger (tests of failures)."""
    now = written(listing(spark, root, pattern), "listing")
    known = written(versions(spark, ledger), "versions")
    same = ["path", "changed", "length"]
    fresh = now.join(known, same, "left_anti")
    gone = known.join(now, "path", "left_anti")
    # One name per camera folder, not per file.
    touched = [r["folder"] for r in fresh.select("folder").union(gone.select("folder")).distinct().orderBy("folder").collect()]
    if not touched:
        return 0
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    held = now.where(F.col("folder").isin(touched)).groupBy("folder").agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).collect()
    alive = {r["folder"] for r in held}
    if alive:
        raw = (spark.read.schema(COCO_SCHEMA).option("multiLine", multi_line).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
               .json([f"{root.rstrip('/')}/{f}" for f in sorted(alive)]))
        base = root.rstrip("/").split("://")[-1].removeprefix("file:")
        path = F.col("_metadata.file_path")
        rows = raw.select(F.explode("annotations").alias("a"), path.alias("file")).select("a.*", "file")
        rows = clean_names(rows).withColumn("folder", F.substring_index(F.substring_index("file", base + "/", -1), "/", 1))
        # Small files meet by folder before they are written.  Of large ones no more are written than read, so their rows stay where they are.
        if sum(r["bytes"] for r in held) < LARGE_FILES * sum(r["files"] for r in held):
            rows = rows.hint("rebalance", "folder")
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy("folder").parquet(sink))
    vanished = [f for f in touched if f not in alive]
    if vanished:
        from camstat.session import drop_path
        for f in vanished:
            drop_path(spark, f"{sink}/folder={f}")
    if before_ledger:
        before_ledger()
    entries = fresh.select("folder", "path", "changed", "length", F.lit(False).alias("gone"), F.lit(run).cast("long").alias("run")).unionByName(
        gone.select("folder", "path", "changed", "length", F.lit(True).alias("gone"), F.lit(run).cast("long").alias("run")))
    entries.write.mode("append").parquet(ledger)
    return len(touched)
