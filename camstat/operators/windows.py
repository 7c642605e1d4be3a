"""Window-style operators.

A window partitioned by a hot key puts that key's rows into one task.  The
operators here avoid that: top-1 and latest are aggregates (``max`` of a
struct, combined map-side); group totals are an aggregate joined back; and the
gap-based sessioniser works in two levels -- rows are windowed within
``(key, time bucket)`` partitions and only one row per bucket is windowed per
key to carry the previous timestamp and the running offset across buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camstat.functions.timefn import epoch_micros
from camstat.operators.joins import join_back
from camstat.session import written


def top1(df: DataFrame, key: list[str], score: str, position: str | None = None,
         payload: list[str] | None = None) -> DataFrame:
    """The best-scoring row per key; ties go to the smallest ``position``.
    Expressed as ``max(struct(score, -position, payload...))`` -- an aggregate
    with map-side combine, safe for a hot key."""
    payload = payload or [c for c in df.columns if c not in key]
    order = [F.col(score).alias("_s")]
    if position is not None:
        order.append((-F.col(position)).alias("_p"))
    best = F.max(F.struct(*order, *[F.col(c).alias(c) for c in payload])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_best")[c].alias(c) for c in payload])


def with_totals(df: DataFrame, by: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Attach group aggregates (sum, n, mean ...) to every row.  The
    aggregate is computed once per group and joined back on ``by``; null is a group."""
    g = df.groupBy(*by).agg(*[v.alias(k) for k, v in aggs.items()])
    return join_back(df, g, by, "left")


def with_group_mean(df: DataFrame, by: list[str], col: str, out: str | None = None) -> DataFrame:
    """W3."""
    return with_totals(df, by, {out or f"{col}_mean": F.avg(col)})


def share_within(df: DataFrame, by: list[str], n: str = "n", out: str = "share") -> DataFrame:
    """``n / sum(n)`` within ``by``."""
    return with_totals(df, by, {"_tot": F.sum(n)}).withColumn(out, F.col(n) / F.col("_tot")).drop("_tot")


def ranged(df: DataFrame, by: list[str], order: list, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``(by, order)`` once, with ``_pid`` (range
    number) and ``_at`` (0-based place in the range), written to the shared folder.

    Everything derived from it sees the same ranges: repeating the range partitioning in
    another branch would sample other bounds.  One shuffle; the place comes from the
    sorted order itself, so no range meets another in a task."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = F.monotonically_increasing_id()
    r = (df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order).withColumn("_m", m)
         .withColumn("_pid", F.shiftrightunsigned("_m", 33).cast("int"))
         .withColumn("_at", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m"))
    return written(r, "ranged")


def seq_id(df: DataFrame, order: list, out: str = "seq", partitions: int | None = None,
           by: list[str] | None = None) -> DataFrame:
    """Dense sequential row number 1..n in a total order (within each ``by``
    group when given; null is a group), without funnelling a whole group into one task:
    the rows are ``ranged`` once, and a table with one row per range and group says where
    the group starts in the range and how many of its rows lie in earlier ranges."""
    by = by or []
    r = ranged(df, by, order, partitions)
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = r.groupBy("_pid", *by).agg(F.count("*").alias("_sz"), F.min("_at").alias("_from"))
    starts = starts.withColumn("_off", F.coalesce(F.sum("_sz").over(before), F.lit(0))).drop("_sz")
    return (join_back(r, starts, ["_pid", *by], "inner")
            .withColumn(out, F.col("_at") - F.col("_from") + 1 + F.col("_off")).drop("_pid", "_at", "_from", "_off"))


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_seconds: float,
               tiebreak: list[str] | None = None, bucket_seconds: int = 3600,
               out: str = "session", flag_out: str | None = None) -> DataFrame:
    """W6/W7 core: number gap-separated runs per key.  A row starts a new run when
    it is the key's first row or its gap to the previous row is ``>= gap``.
    Runs are numbered 1, 2, ... per key in time order.

    Two-level plan (hot-key safe): rows are windowed only within
    ``(keys, bucket)`` partitions, ``bucket = floor(ts / bucket_seconds)``.  A
    per-bucket summary (first / last time, run starts inside the bucket) is
    windowed per key -- one small row per bucket -- to decide whether the
    bucket's first row starts a run and to carry the running offset; one join
    brings both back.  The result equals a single window over each key.
    The bucket-summary branch re-reads only the key and time columns (column
    pruning), so the second pass is narrow even for wide rows."""
    tiebreak = tiebreak or []
    us = int(bucket_seconds * 1_000_000)
    gap_us = F.lit(int(gap_seconds * 1_000_000))
    x = (df.withColumn("_t", epoch_micros(ts))
         .withColumn("_b", F.floor(F.col("_t") / F.lit(us))))
    w_in = Window.partitionBy(*keys, "_b").orderBy("_t", *tiebreak)
    prev = F.lag("_t").over(w_in)
    x = x.withColumn("_first", prev.isNull()).withColumn(
        "_inew", F.when(prev.isNotNull() & ((F.col("_t") - prev) >= gap_us), 1).otherwise(0))
    x = x.withColumn("_ics", F.sum("_inew").over(w_in.rowsBetween(Window.unboundedPreceding, 0)))
    wb = Window.partitionBy(*keys).orderBy("_b")
    bt = x.groupBy(*keys, "_b").agg(F.min("_t").alias("_bmin"), F.max("_t").alias("_bmax"),
                                    F.sum("_inew").alias("_bn"))
    pb = F.lag("_bmax").over(wb)
    bt = bt.withColumn("_fnew", F.when(pb.isNull() | ((F.col("_bmin") - pb) >= gap_us), 1).otherwise(0))
    bt = bt.withColumn("_off", F.coalesce(F.sum(F.col("_bn") + F.col("_fnew")).over(
        wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = join_back(x, bt.select(*keys, "_b", "_off", "_fnew"), [*keys, "_b"], "inner")
    x = x.withColumn(out, (F.col("_off") + F.col("_fnew") + F.col("_ics")).cast("bigint"))
    if flag_out:
        x = x.withColumn(flag_out, F.when(F.col("_first"), F.col("_fnew") == 1).otherwise(F.col("_inew") == 1))
    return x.drop("_t", "_b", "_first", "_inew", "_ics", "_off", "_fnew")


def independent_detections(obs: DataFrame, keys: list[str], ts: str, gap_seconds: float,
                           count: str | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Same-time same-key rows are merged first (counts summed), then a gap of
    at least ``gap_seconds`` starts a new detection; each detection is summarised
    (start, end, duration, images, mean / max individuals)."""
    cnt = F.col(count) if count else F.lit(1)
    merged = obs.groupBy(*keys, ts).agg(F.sum(cnt).alias("n_individuals"))
    s = sessionize(merged, keys, ts, gap_seconds, tiebreak, out="detection")
    return (s.groupBy(*keys, "detection")
            .agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
                 F.count("*").alias("n_images"), F.avg("n_individuals").alias("avg_animals"),
                 F.max("n_individuals").alias("max_animals"))
            .withColumn("duration_s", F.floor(epoch_micros("end_time") / 1_000_000)
                        - F.floor(epoch_micros("start_time") / 1_000_000)))


def visit_sessions(obs: DataFrame, keys: list[str], ts: str, gap_seconds: float) -> DataFrame:
    """T2 in batch: gap-separated visits per key with start, end (last image plus the gap) and
    image count.  Images of one instant are counted before sessionising."""
    merged = obs.groupBy(*keys, ts).agg(F.count("*").alias("n"))
    s = sessionize(merged, keys, ts, gap_seconds, out="session")
    return (s.groupBy(*keys, "session")
            .agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last"), F.sum("n").alias("n_images"))
            .select(*keys, "session_start", (F.col("_last") + F.expr(f"INTERVAL '{gap_seconds}' SECOND")).alias("session_end"), "n_images"))


def expand_bursts(dets: DataFrame, keys: list[str], ts: str, thr: float = 0.1,
                  conf: str = "confidence", burst_gap_seconds: float = 2.0,
                  burst: str | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Keep every image of a burst in which any image passes ``thr``.  The
    burst id is given (``burst``) or derived from capture gaps per camera; derived ids are
    written once, as both the maxima and the rows need them."""
    if burst is None:
        dets = written(sessionize(dets, keys, ts, burst_gap_seconds, tiebreak, out="burst"), "bursts")
        burst = "burst"
        bkeys = [*keys, burst]
    else:
        bkeys = [*keys, burst] if keys else [burst]
    passing = (dets.groupBy(*bkeys).agg(F.max(conf).alias("burst_max_conf"))
               .filter(F.col("burst_max_conf") > thr))
    return join_back(dets, passing, bkeys, "inner")


def latest(df: DataFrame, key: list[str], ts: str, payload: list[str] | None = None) -> DataFrame:
    """The most recent row per key (aggregate, not a window)."""
    return top1(df, key, ts, payload=payload)


def smooth(df: DataFrame, order: str, col: str, width: int = 10, by: list[str] | None = None,
           out: str | None = None) -> DataFrame:
    """Centred moving average (width 10 = rows -5..+4).  Meant for per-run
    logs (one partition per ``by`` group)."""
    lo = -(width // 2)
    hi = width - 1 + lo
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(lo, hi)
    return df.withColumn(out or f"{col}_smooth", F.avg(col).over(w))


def halves(df: DataFrame, order: list[str], out: str = "half") -> DataFrame:
    """First / second half of the ordered table (1 or 2); the first half
    holds ``ceil(n/2)`` rows."""
    from camstat.operators.aggregates import attach_scalar
    s = seq_id(df, order, out="_seq")
    n = df.agg(F.count("*").alias("_n"))
    return (attach_scalar(s, n)
            .withColumn(out, F.when(F.col("_seq") <= F.ceil(F.col("_n") / 2), 1).otherwise(2))
            .drop("_seq", "_n"))
