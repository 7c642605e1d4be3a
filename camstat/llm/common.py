"""Helpers shared by the operators: table access, session bounds, tables in the shared folder."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.session import drop_path as drop
from camstat.session import shared_path, written, written_at

__all__ = ["digest", "drop", "prepare", "shared_path", "table", "written", "written_at"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text: Column) -> Column:
    """128 bits that tell texts apart where keys are null or repeated; null texts as empty ones."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


#: Rows in an Arrow batch.  Texts are long: the default of 10,000 rows makes batches of tens to
#: hundreds of MB, several of which a worker holds at once.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, unless the session sets them, and let the Python workers of a local
    session find this package from any working folder (on a cluster the package is installed or
    shipped with --py-files)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
