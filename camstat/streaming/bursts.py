"""T2 + W7: the burst rule on a stream of detections.

A burst is a run of images of one key whose gaps stay under ``gap``.  Every image of a burst is kept if any of them
passes the confidence threshold.  Once one image passes, the whole burst so far is emitted, and later images of it at
once: whether bursts merge when a straggler falls between them or not, an image once kept stays kept.

State per key: the open bursts (first and last instant, whether they passed) and the images of those that have not
passed yet.  A burst is forgotten when the watermark is ``gap`` past its last image, as no image can join it any
more; with it go the images of a burst that never passed.  Images at or before the watermark are late and dropped
by the engine.  After a failure the micro-batch runs again on the state before it, so nothing is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Open bursts side by side, then the images that wait, each with the number of its burst.
_STATE = "starts array<bigint>, ends array<bigint>, passed array<boolean>, at array<bigint>, burst array<int>, conf array<double>, payload array<string>"
_OUT = "payload string"
#: Instants in payloads keep their microseconds.
_JSON = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class Bursts:
    """The open bursts of one key, in time order (instants in microseconds)."""

    def __init__(self, gap: int, threshold: float):
        self.gap, self.threshold = gap, threshold
        self.open: list[list] = []  # [first, last, passed, [(instant, confidence, payload)]]

    def add(self, at: int, conf: float | None, payload: str) -> None:
        """An image joins all bursts nearer than the gap, which become one."""
        mine = [b for b in self.open if b[0] - self.gap < at < b[1] + self.gap]
        rows = [r for b in mine for r in b[3]] + [(at, conf, payload)]
        one = [min([at, *[b[0] for b in mine]]), max([at, *[b[1] for b in mine]]),
               any(b[2] for b in mine) or (conf is not None and conf > self.threshold), rows]
        self.open = sorted([b for b in self.open if b not in mine] + [one], key=lambda b: b[0])

    def take(self) -> list[str]:
        """Images of bursts that have passed, which need not wait any longer."""
        out = []
        for b in self.open:
            if b[2]:
                out += [p for _, _, p in b[3]]
                b[3] = []
        return out

    def close(self, watermark: int) -> None:
        self.open = [b for b in self.open if b[1] + self.gap > watermark]

    def state(self) -> tuple:
        rows = [(k, r) for k, b in enumerate(self.open) for r in b[3]]
        return ([b[0] for b in self.open], [b[1] for b in self.open], [b[2] for b in self.open],
                [r[0] for _, r in rows], [k for k, _ in rows], [r[1] for _, r in rows], [r[2] for _, r in rows])

    def load(self, state: tuple) -> None:
        starts, ends, passed, at, burst, conf, payload = state
        self.open = [[int(s), int(e), bool(p), []] for s, e, p in zip(starts, ends, passed)]
        for t, k, c, p in zip(at, burst, conf, payload):
            self.open[k][3].append((int(t), None if c is None or c != c else float(c), p))


def burst_stream(stream: DataFrame, keys: list[str], ts: str, threshold: float = 0.1, conf: str = "confidence",
                 gap_seconds: float = 2.0, lateness: str = "1 hour") -> DataFrame:
    """The rows of ``stream`` that the burst rule keeps, as an append stream of the same columns.  Rows without
    a key or an instant belong to no burst and are dropped; a null confidence passes nothing."""
    gap = int(gap_seconds * 1_000_000)
    names = [f"_k{i}" for i in range(len(keys))]
    known = F.lit(True)
    for k in [*keys, ts]:
        known = known & F.col(k).isNotNull()
    rows = stream.where(known).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(ts).cast("timestamp").alias("_ts"),
        F.col(conf).cast("double").alias("_conf"), F.to_json(F.struct(*stream.columns), _JSON).alias("_payload"))
    rows = rows.withColumn("_at", F.unix_micros("_ts")).withWatermark("_ts", lateness)

    def step(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        own = Bursts(gap, threshold)
        if state.exists:
            own.load(state.get)
        out: list[str] = []
        if not state.hasTimedOut:
            for batch in batches:
                for at, c, payload in sorted(zip(batch["_at"], batch["_conf"], batch["_payload"]), key=lambda r: (r[0], r[2])):
                    own.add(int(at), None if c != c or c is None else float(c), payload)
            out = own.take()
        mark = state.getCurrentWatermarkMs()
        own.close(mark * 1000)
        if own.open:
            state.update(own.state())
            first = min(b[1] for b in own.open) + gap
            state.setTimeoutTimestamp(max(-(-first // 1000), mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"payload": pd.Series(out, dtype="object")})

    kept = rows.groupBy(*names).applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return kept.select(F.from_json("payload", stream.schema, _JSON).alias("r")).select("r.*")


def run_bursts(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str, keys: list[str], ts: str,
               threshold: float = 0.1, conf: str = "confidence", gap_seconds: float = 2.0, lateness: str = "1 hour",
               max_files: int | None = None):
    """Detections from the Parquet files of a folder into a Parquet sink (availableNow: what is there, then stop)."""
    src = spark.readStream.schema(schema)
    if max_files:
        src = src.option("maxFilesPerTrigger", max_files)
    q = (burst_stream(src.parquet(source_dir), keys, ts, threshold, conf, gap_seconds, lateness).writeStream.format("parquet")
         .outputMode("append").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def replay_bursts(dets: DataFrame, folder: str, keys: list[str], ts: str, threshold: float = 0.1, conf: str = "confidence",
                  gap_seconds: float = 2.0, slices: int = 3, lateness: str = "1 hour") -> DataFrame:
    """The burst rule over a stored table that arrives in time order, slice by slice, each slice as one run over the same
    state (a restart between any two).  Slices end between bursts or within them alike."""
    spark = dets.sparkSession
    kind = dets.schema[ts].dataType
    lo, hi = dets.agg(F.min(ts), F.max(ts)).first()
    source, sink, state = (f"{folder}/{x}" for x in ("in", "out", "state"))
    if lo is None:
        return dets.limit(0)
    step = (hi - lo) / slices
    for i in range(slices):
        own = F.col(ts) >= F.lit(lo + step * i).cast(kind)
        if i + 1 < slices:
            own = own & (F.col(ts) < F.lit(lo + step * (i + 1)).cast(kind))
        dets.where(own).write.mode("append").parquet(source)
        run_bursts(spark, source, dets.schema, sink, state, keys, ts, threshold, conf, gap_seconds, lateness)
    return spark.read.schema(dets.schema).parquet(sink)
