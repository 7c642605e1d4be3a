"""Aggregations.

All of these are ``groupBy``/``agg`` plans: Spark combines partially on the map
side before the shuffle, so a key holding a third of the rows still ships only
one partial row per map task.  Shares use a total computed by a second tiny
aggregate, never a global sort or a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camstat.functions.timefn import fractional_days, parse_capture_time
from camstat.operators.joins import join_back
from camstat.session import written


def n_distinct(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """A1: exact distinct count as a one-row frame."""
    return df.agg(F.count_distinct(col).alias(out))


def n_distinct_approx(df: DataFrame, col: str, rsd: float = 0.01, out: str = "n") -> DataFrame:
    return df.agg(F.approx_count_distinct(col, rsd).alias(out))


def with_share(df: DataFrame, n: str = "n", out: str = "pct", by: list[str] | None = None,
               scale: float = 100.0) -> DataFrame:
    """Share of ``n`` within ``by`` (all rows when empty).  Applied to already
    aggregated frequency tables, whose size is the number of categories."""
    if by:
        return df.withColumn(out, F.col(n) * scale / F.sum(n).over(Window.partitionBy(*by)))
    # grand total as a scalar subquery: no single-partition window
    return df.withColumn(out, F.col(n) * scale / df.agg(F.sum(n)).scalar())


def freq_pct(df: DataFrame, col: str, distinct_on: list[str] | None = None,
             n: str = "n", pct: str = "pct") -> DataFrame:
    """A2: distinct rows (optional), then frequency and percent of ``col``;
    nulls are dropped as R ``table()`` does."""
    base = df.select(*(distinct_on or [col])).distinct() if distinct_on else df
    f = base.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(n))
    return with_share(f, n, pct)


def category_breakdown(df: DataFrame, t: float = 0.1, col: str = "category_id",
                       conf: str = "confidence") -> DataFrame:
    """A3: category counts and shares for ``confidence > 0`` and ``> t`` side by side."""
    g = (df.filter(F.col(conf) > 0)
         .groupBy(col)
         .agg(F.count("*").alias("n_all"),
              F.count_if(F.col(conf) > t).alias("n_filtered")))
    tot = g.agg(F.sum("n_all").alias("_ta"), F.sum("n_filtered").alias("_tf"))
    return attach_scalar(g, tot).withColumns({
        "pct_all": F.col("n_all") * 100.0 / F.col("_ta"),
        "pct_filtered": F.col("n_filtered") * 100.0 / F.col("_tf"),
    }).drop("_ta", "_tf")


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as an uncorrelated
    scalar subquery: the aggregate runs once as its own job and its value is
    substituted into the projection -- no join, no shuffle of ``df``."""
    cols = one_row.columns
    s = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_s")).scalar()
    return df.withColumn("_scalar", s).select("*", *[F.col("_scalar")[c].alias(c) for c in cols]).drop("_scalar")


def progress_table(dets: DataFrame, anns_noempty: DataFrame, t: float = 0.1,
                   image: str = "image_id", conf: str = "confidence",
                   empty: str = "isempty", species: str = "species") -> DataFrame:
    """A4 + U5: the five-row tagging progress table (images, detections, false
    positives): one aggregate pass over detections, one over annotations, then
    the scalar rows are stacked as literal rows."""
    c, e = F.col(conf), F.col(empty)
    # per-image partial aggregate first (an image's boxes are a small group), so
    # every distinct-image count below is a plain sum over images
    per_img = dets.groupBy(image).agg(
        F.count_if(c > 0).alias("_d0"), F.max((~e).cast("int")).alias("_ne"),
        F.max(e.cast("int")).alias("_em"), F.count_if(c > t).alias("_dt"))
    d = per_img.agg(
        F.count("*").alias("total_images"), F.sum("_d0").alias("total_dets"),
        F.sum("_ne").alias("with_images"), F.sum("_em").alias("empty_images"),
        F.count_if(F.col("_dt") > 0).alias("filt_images"), F.sum("_dt").alias("filt_dets"))
    d = d.selectExpr(
        "stack(4, 1, 'Total', total_images, total_dets,"
        " 2, 'With detections', with_images, CAST(NULL AS BIGINT),"
        " 3, 'Empty', empty_images, CAST(NULL AS BIGINT),"
        " 4, 'Filtered', filt_images, filt_dets) AS (order, status, images, detections)")
    d = d.withColumn("false_positives", F.lit(None).cast("bigint"))
    a_img = anns_noempty.groupBy(image).agg(F.count("*").alias("_n"),
                                            F.count_if(F.col(species).isNull()).alias("_fp"))
    a = a_img.agg(F.count("*").alias("images"), F.sum("_n").alias("detections"),
                  F.sum("_fp").alias("false_positives"))
    a = a.select(F.lit(5).alias("order"), F.lit("Processed").alias("status"), "images",
                 "detections", "false_positives")
    return d.unionByName(a)


def review_outcome(anns_noempty: DataFrame, species: str = "species", manual: str = "manual") -> DataFrame:
    """A5: false positives (no species), true positives (species, not manual) and
    missed-by-detector boxes (species, manual), with shares, in one pass.
    ``manual_fp`` must be 0 (Q6)."""
    sp, man = F.col(species), F.col(manual)
    return (anns_noempty.agg(
        F.count("*").alias("n"),
        F.count_if(sp.isNull()).alias("false_pos"),
        F.count_if(sp.isNotNull() & ~man).alias("true_pos"),
        F.count_if(sp.isNotNull() & man).alias("missed"),
        F.count_if(sp.isNull() & man).alias("manual_fp"))
        .withColumns({
            "false_pos_pct": F.col("false_pos") * 100.0 / F.col("n"),
            "true_pos_pct": F.col("true_pos") * 100.0 / F.col("n"),
            "missed_pct": F.col("missed") * 100.0 / F.col("n"),
        }))


def origin_breakdown(df: DataFrame, col: str = "origin") -> DataFrame:
    """A6."""
    return freq_pct(df, col)


def presence_absence(obs: DataFrame, unit: str = "camera_id", species: str = "species") -> DataFrame:
    """Long presence table -- one row per (unit, species) seen; pivot at the edge."""
    return (obs.filter(F.col(species).isNotNull())
            .select(unit, species).distinct()
            .withColumn("present", F.lit(1)))


def pivot_wide(long: DataFrame, row: str, col: str, val: str, values: list, fill=0,
               agg: str = "sum") -> DataFrame:
    """Long -> wide with an explicit column list (static schema), 0-filled."""
    fn = {"sum": F.sum, "first": F.first, "max": F.max}[agg]
    wide = long.groupBy(row).pivot(col, values).agg(fn(val))
    return wide.fillna(fill, subset=[str(v) for v in values])


def one_hot(df: DataFrame, key: list[str], cls: str, values: list) -> DataFrame:
    """One-hot columns (1 / 0, a missing class is all 0) for an explicit class list."""
    return df.select(*key, *[F.coalesce((F.col(cls) == F.lit(v)).cast("int"), F.lit(0)).alias(str(v))
                             for v in values])


def one_hot_groups(df: DataFrame, groups: DataFrame, key: list[str], cls: str, group: str,
                   values: list) -> DataFrame:
    """J4 + A8: left-join each row's class to its class group, then one-hot the
    group over an explicit list."""
    return one_hot(df.join(groups.select(cls, group), cls, "left"), key, group, values)


def day_events(obs: DataFrame, unit: str = "camera_id", species: str = "species",
               month: str = "month", day_key: str = "ymd", out: str = "day_count") -> DataFrame:
    """Distinct (unit, species, month, day) then a count per unit x species."""
    return (obs.select(unit, species, month, day_key).distinct()
            .groupBy(unit, species).agg(F.count("*").alias(out)))


def monthly_events(obs: DataFrame, unit: str = "camera_id", species: str = "species",
                   month: str = "month", day_key: str = "ymd") -> DataFrame:
    """Day-events per unit x species x month."""
    return (obs.select(unit, species, month, day_key).distinct()
            .groupBy(unit, species, month).agg(F.count("*").alias("n_days")))


def camera_first_day(exif: DataFrame, camera: str = "maker_notes_user_label",
                     t: str = "exif_date_time_original", parsed: bool = False) -> DataFrame:
    """First capture time per camera (parse, then min)."""
    ts = F.col(t) if parsed else parse_capture_time(t)
    return exif.groupBy(F.col(camera).alias("camera_id")).agg(F.min(ts).alias("camera_first_day"))


def detection_latency(obs: DataFrame, cams: DataFrame, zones: DataFrame | None = None,
                      min_cameras: int = 3, max_days: float = 200.0,
                      camera: str = "camera_id", species: str = "species",
                      ts: str = "date_time", day_key: str = "ymd") -> DataFrame:
    """Per species x camera the first sighting, camera start and distinct
    days; species totals (sum of days, number of cameras); keep species seen at
    more than ``min_cameras`` cameras and latencies under ``max_days``."""
    # distinct days first (a plain aggregate), then per species x camera.  Species totals
    # come from that table before the camera start and zone are attached.
    per_day = obs.groupBy(species, camera, day_key).agg(F.min(ts).alias("_d"))
    g = written(per_day.groupBy(species, camera).agg(F.min("_d").alias("first_day"), F.count("*").alias("camera_events")),
                "latency")
    tot = (g.groupBy(species).agg(F.sum("camera_events").alias("total_events"), F.count("*").alias("n_cameras"))
           .filter(F.col("n_cameras") > min_cameras))
    out = join_back(join_back(g, tot, [species], "inner"), cams.select(camera, "camera_first_day"), [camera])
    if zones is not None:
        out = join_back(out, zones, [camera])
    diff = fractional_days("first_day", "camera_first_day")
    return out.withColumn("diff_days", diff).filter(F.col("diff_days") < max_days)


def mean_sd(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """A14."""
    g = df.groupBy(*(by or []))
    return g.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))


def plot_centroid(points: DataFrame, plot: str = "plot_id", x: str = "x", y: str = "y") -> DataFrame:
    """Mean coordinates per plot."""
    return points.groupBy(plot).agg(F.avg(x).alias(x), F.avg(y).alias(y))


def species_table(events: DataFrame, names: DataFrame | None = None, min_days: int = 50,
                  species: str = "species", n: str = "day_count", inclusive: bool = True) -> DataFrame:
    """Total detection days per species, filtered, sorted descending, with
    scientific names joined."""
    t = events.groupBy(species).agg(F.sum(n).alias("days_detected"))
    t = t.filter(F.col("days_detected") >= min_days if inclusive else F.col("days_detected") > min_days)
    if names is not None:
        t = t.join(names, species, "left")
    return t.orderBy(F.desc("days_detected"), F.asc(species))


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float,
              by: list[str] | None = None) -> DataFrame:
    """Equal-width histogram; the upper edge lands in the last bin."""
    b = F.least(F.width_bucket(F.col(col), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return (df.filter(F.col(col).between(lo, hi))
            .groupBy(*(by or []), b.alias("bin"))
            .agg(F.count("*").alias("n"))
            .withColumns({"bin_lo": F.lit(lo) + (F.col("bin") - 1) * F.lit((hi - lo) / bins),
                          "bin_hi": F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins)}))


def _counted(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """One row per (group, value) with its count and ``_upto``, the rows of the group up to
    and including the value.  Values are counted first (map-side combined), so a frequent
    value is one row; the running sum is taken inside value ranges, and ranges are
    chained through a table with one row per range and group."""
    from camstat.operators.windows import ranged
    v = df.select(*by, F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
    r = ranged(v.groupBy(*by, "_v").agg(F.count("*").alias("_c")), by, ["_v"])
    inside = Window.partitionBy("_pid", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = r.groupBy("_pid", *by).agg(F.sum("_c").alias("_sum"))
    sums = sums.withColumn("_off", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    r = r.withColumn("_in", F.sum("_c").over(inside))
    return written(join_back(r, sums, ["_pid", *by], "inner")
                   .select(*by, "_v", "_c", (F.col("_in") + F.col("_off")).alias("_upto")), "counted")


def _quantiles(counted: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    n = counted.groupBy(*by).agg(F.sum("_c").alias("n"))
    c = join_back(counted, n, by, "inner") if by else attach_scalar(counted, n)

    def at(rank):
        """The value that holds a 1-based rank of its group."""
        return F.max(F.when((F.col("_upto") - F.col("_c") < rank) & (rank <= F.col("_upto")), F.col("_v")))

    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p)) + 1
        aggs += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}")]
    q = c.groupBy(*by, "n").agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p)) + 1
        out.append((F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}"))
    return q.select(*by, "n", *out)


def quantiles(df: DataFrame, col: str, probs: list[float], by: list[str]) -> DataFrame:
    """Exact linear-interpolation quantiles (the usual "type 7": position
    ``(n - 1) p + 1``) per group, null being a group, without buffering a group's values in
    one task: values are counted, counts accumulated in value ranges, and the values at the
    two ranks around each position interpolated.  Output: ``by + [q0, q1, ...]``."""
    return _quantiles(_counted(df, col, by), probs, by).drop("n")


def box_stats(df: DataFrame, col: str, by: list[str], approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Quartiles, IQR and Tukey whiskers (extreme values within 1.5 IQR), from one table
    of value counts.  ``approx`` takes the quartiles from the bounded-memory sketch instead.
    Null is a group; a group without values is left out."""
    v = F.col("_v")
    if approx:
        counted = df.select(*by, F.col(col).alias("_v")).filter(v.isNotNull()).groupBy(*by, "_v").agg(F.count("*").alias("_c"))
        q = df.groupBy(*by).agg(F.percentile_approx(F.col(col), [0.25, 0.5, 0.75], accuracy).alias("_q"), F.count(col).alias("n"))
        q = q.filter("n > 0").select(*by, "n", *[F.col("_q")[i].alias(f"q{i}") for i in range(3)])
    else:
        counted = _counted(df, col, by)
        q = _quantiles(counted, [0.25, 0.5, 0.75], by)
    qs = q.select(*by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
                  (F.col("q2") - F.col("q0")).alias("iqr"))
    fences = qs.withColumns({"_lo": F.col("q1") - 1.5 * F.col("iqr"), "_hi": F.col("q3") + 1.5 * F.col("iqr")})
    j = join_back(counted, fences, by, "inner") if by else attach_scalar(counted, fences)
    keep = [*by, "n", "q1", "median", "q3", "iqr"]
    return j.groupBy(*keep).agg(
        F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_hi"),
        F.sum(F.when((v < F.col("_lo")) | (v > F.col("_hi")), F.col("_c")).otherwise(0)).alias("n_outliers"))


def hit_rate(obs: DataFrame, camera: str = "camera_id", species: str = "species") -> DataFrame:
    """Share of all cameras where each species was seen (percent)."""
    total = obs.agg(F.count_distinct(camera).alias("_tot"))
    per = obs.groupBy(species).agg(F.count_distinct(camera).alias("n_cameras"))
    return (attach_scalar(per, total)
            .withColumn("rate", F.col("n_cameras") * 100.0 / F.col("_tot")).drop("_tot"))


def images_per_location(files: DataFrame, location: str = "location") -> DataFrame:
    """A22."""
    return files.groupBy(location).agg(F.count("*").alias("n_images"))


def get_dupes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the key count; null keys are keys.
    Counts come from a partial aggregate joined back (no window over a hot key)."""
    c = df.groupBy(*keys).agg(F.count("*").alias("dupe_count")).filter(F.col("dupe_count") > 1)
    return join_back(df, c, keys, "inner")


def epoch_loss(log: DataFrame, epoch: str = "epoch", loss: str = "loss",
               by: list[str] | None = None) -> DataFrame:
    """A24."""
    return log.groupBy(*(by or []), epoch).agg(F.avg(loss).alias("mean_loss"))


def split_balance(df: DataFrame, cls: str = "class", split: str = "split",
                  splits=("train", "eval")) -> DataFrame:
    """Class counts and within-split shares per split."""
    g = df.groupBy(cls).pivot(split, list(splits)).agg(F.count(F.lit(1))).fillna(0)
    tot = g.agg(*[F.sum(s).alias(f"_t_{s}") for s in splits])
    g = attach_scalar(g, tot)
    for s in splits:
        g = g.withColumn(f"{s}_share", F.col(s) / F.col(f"_t_{s}"))
    return g.drop(*[f"_t_{s}" for s in splits])
