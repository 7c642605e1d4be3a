"""Visit / burst sessions per camera from a stream of observations.

Sessions close after ``gap`` without a new image (``session_window``); the
watermark bounds the state and drops images later than ``lateness``.  Output is
append-only: a session is emitted once the watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session_counts(stream: DataFrame, key: str = "camera_id", ts: str = "date_time", gap: str = "30 minutes",
                   lateness: str = "1 hour") -> DataFrame:
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    g = s.groupBy(key, F.session_window("_ts", gap).alias("s")).agg(F.count("*").alias("n_images"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_images")


def run_sessions(spark: SparkSession, source_dir: str, schema, sink: str, checkpoint: str,
                 key: str = "camera_id", ts: str = "date_time", gap: str = "30 minutes",
                 lateness: str = "1 hour", max_files: int | None = None):
    """Stream Parquet observation files from ``source_dir`` into a Parquet sink of closed
    sessions (availableNow: process what is there, then stop).  Without ``max_files`` one run
    takes all new files as one batch, so their order does not matter."""
    src = spark.readStream.schema(schema)
    if max_files:
        src = src.option("maxFilesPerTrigger", max_files)
    q = (session_counts(src.parquet(source_dir), key, ts, gap, lateness).writeStream.format("parquet").outputMode("append")
         .option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def replay(obs: DataFrame, folder: str, slices: int = 2, key: str = "camera_id", ts: str = "date_time",
           gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """T2 over a stored table: the backlog arrives in time order, one slice of the time span
    after the other, each slice as one run over the same state.  A last row without a key,
    far behind all others, moves the watermark past every open session, so all sessions are
    written.  Rows without key or time belong to no session."""
    spark = obs.sparkSession
    rows = obs.select(key, ts).filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    lo, hi = rows.agg(F.min(ts), F.max(ts)).first()
    source, sink, state = (f"{folder}/{x}" for x in ("in", "out", "state"))
    schema = rows.schema
    if lo is not None:
        step = (hi - lo) / slices
        for i in range(slices):
            own = F.col(ts) >= F.lit(lo + step * i).cast(schema[ts].dataType)
            if i + 1 < slices:
                own = own & (F.col(ts) < F.lit(lo + step * (i + 1)).cast(schema[ts].dataType))
            rows.filter(own).write.mode("append").parquet(source)
            run_sessions(spark, source, schema, sink, state, key, ts, gap, lateness)
        last = rows.agg((F.max(ts) + F.expr("INTERVAL 7 DAYS")).cast(schema[ts].dataType).alias(ts))
        last.select(F.lit(None).cast(schema[key].dataType).alias(key), ts).write.mode("append").parquet(source)
        run_sessions(spark, source, schema, sink, state, key, ts, gap, lateness)
        out = spark.read.parquet(sink).filter(F.col(key).isNotNull())
    else:
        out = spark.createDataFrame([], session_counts(rows, key, ts, gap, lateness).schema)
    kind = schema[ts].dataType
    return out.withColumns({c: F.col(c).cast(kind) for c in ("session_start", "session_end")})
