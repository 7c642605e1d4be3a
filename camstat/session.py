"""Session helpers.

A cluster names its shared checkpoint folder in ``spark.checkpoint.dir``; we
read it from the session.  Only a local session without the setting (tests) falls
back to a fresh scratch folder; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: the static planner estimates from
    # compressed file sizes (badly wrong after explode/generate), so static
    # auto-broadcast is off and AQE converts a join to a broadcast only when the
    # runtime-measured shuffle output of a side is under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "camstat",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set.  Only a
    local session (tests) gets a fresh scratch folder; elsewhere a machine-local folder
    would not be seen by other machines, so a missing setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^,]*(,\s*\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="camstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder.  All paths of one application lie in
    one folder, which is removed when the driver ends."""
    top = f"{checkpoint_dir(spark).rstrip('/')}/camstat-{spark.sparkContext.applicationId}"
    if top not in _FOLDERS:
        _FOLDERS.add(top)
        atexit.register(_drop_at_exit, spark, top)
    return f"{top}/{label}-{uuid.uuid4().hex}"


_FOLDERS: set[str] = set()


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path that this library wrote under the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the shared folder and read back, with its path (for
    tables that a loop replaces and drops).  Later steps do not repeat its work, all of them
    see the same rows, and a lost executor costs no more than the reading task."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    return written_at(df, label)[0]
