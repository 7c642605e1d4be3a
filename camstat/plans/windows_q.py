"""Sessions, bursts, top-k, sequences, shares, sorts and set operations
(W1-W10, L1-L5, U1-U6, A24, T2 batch twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import reshape as R
from camstat.operators import windows as W
from camstat.operators.metrics import portable_hash
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

GAP_S = 1800
BURST_THR = 0.5


@register("independent_detections", with_views(["observations"], f"""
WITH m AS (SELECT camera_id, species, date_time, count(*) AS n_individuals FROM observations
           GROUP BY camera_id, species, date_time),
f AS (SELECT *, CASE WHEN lag(date_time) OVER w IS NULL
                       OR epoch_us(date_time) - epoch_us(lag(date_time) OVER w) >= {GAP_S}000000 THEN 1 ELSE 0 END AS new
      FROM m WINDOW w AS (PARTITION BY camera_id, species ORDER BY date_time)),
s AS (SELECT *, sum(new) OVER (PARTITION BY camera_id, species ORDER BY date_time
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS detection FROM f)
SELECT camera_id, species, detection, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS end_time, count(*) AS n_images,
       avg(n_individuals) AS avg_animals, max(n_individuals) AS max_animals,
       date_diff('second', min(date_time), max(date_time)) AS duration_s
FROM s GROUP BY camera_id, species, detection"""))
def independent_detections(spark, sf):
    """Independent detections per camera x species (30-minute gap)."""
    return W.independent_detections(S.observations(spark, sf), ["camera_id", "species"], "date_time", GAP_S)


VISITS_SQL = f"""
WITH f AS (SELECT camera_id, date_time, CASE WHEN lag(date_time) OVER w IS NULL
                   OR epoch_us(date_time) - epoch_us(lag(date_time) OVER w) >= {GAP_S}000000 THEN 1 ELSE 0 END AS new
           FROM observations WINDOW w AS (PARTITION BY camera_id ORDER BY date_time)),
s AS (SELECT *, sum(new) OVER (PARTITION BY camera_id ORDER BY date_time
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess FROM f)
SELECT camera_id, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(date_time) + INTERVAL {GAP_S} SECOND, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n_images
FROM s GROUP BY camera_id, sess"""


@register("visit_sessions", with_views(["observations"], VISITS_SQL))
def visit_sessions(spark, sf):
    """T2 (batch twin): visit sessions per camera with a 30-minute gap."""
    return W.visit_sessions(S.observations(spark, sf), ["camera_id"], "date_time", GAP_S)


@register("burst_expansion", with_views(["observations"], f"""
WITH f AS (SELECT obs_id, camera_id, date_time, confidence, CASE WHEN lag(date_time) OVER w IS NULL
                   OR epoch_us(date_time) - epoch_us(lag(date_time) OVER w) >= {GAP_S}000000 THEN 1 ELSE 0 END AS new
           FROM observations WINDOW w AS (PARTITION BY camera_id ORDER BY date_time, obs_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY camera_id ORDER BY date_time, obs_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM f),
b AS (SELECT camera_id, burst, max(confidence) AS burst_max_conf FROM s GROUP BY camera_id, burst
      HAVING max(confidence) > {BURST_THR})
SELECT s.obs_id, s.camera_id, s.burst, s.confidence, b.burst_max_conf
FROM s JOIN b ON s.camera_id = b.camera_id AND s.burst = b.burst"""))
def burst_expansion(spark, sf):
    """Every image of a burst in which any image passes the threshold."""
    o = S.observations(spark, sf).select("obs_id", "camera_id", "date_time", "confidence")
    e = W.expand_bursts(o, ["camera_id"], "date_time", BURST_THR, burst_gap_seconds=GAP_S, tiebreak=["obs_id"])
    return e.select("obs_id", "camera_id", "burst", "confidence", "burst_max_conf")


@register("top_dimension", with_views([], """
SELECT vec_id, dim, score FROM (
  SELECT vec_id, i - 1 AS dim, CAST(embedding[i] AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) AS rn
  FROM embeddings, range(1, 65) AS t(i)) x WHERE rn = 1"""))
def top_dimension(spark, sf):
    """Best-scoring dimension per vector (ties -> first)."""
    e = S.table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("dim", "score"))
    return W.top1(e, ["vec_id"], "score", position="dim", payload=["dim", "score"])


@register("latest_per_camera", with_views(["observations"], """
SELECT camera_id, strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, obs_id, species FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY date_time DESC, obs_id DESC) AS rn FROM observations) x
WHERE rn = 1"""))
def latest_per_camera(spark, sf):
    """Most recent observation per camera."""
    return W.latest(S.observations(spark, sf), ["camera_id"], "date_time", payload=["date_time", "obs_id", "species"])


def _training_log(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select(F.dayofmonth("ts").alias("epoch"), F.hour("ts").alias("batch"), (F.col("value") / 100).alias("loss"),
                    F.when(F.col("event_type").isin("click", "view"), "train").otherwise("eval").alias("split"))


@register("loss_curve", with_views([], """
SELECT split, epoch, mean_loss, avg(mean_loss) OVER (PARTITION BY split ORDER BY epoch
                                                     ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS mean_loss_smooth
FROM (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'train' ELSE 'eval' END AS split,
             dayofmonth(ts) AS epoch, avg(value / 100) AS mean_loss FROM events GROUP BY 1, 2) l"""))
def loss_curve(spark, sf):
    """A24 + W9: mean loss per epoch and split, centred moving average (10)."""
    l = A.epoch_loss(_training_log(spark, sf), by=["split"])
    return W.smooth(l, "epoch", "mean_loss", 10, by=["split"])


@register("camera_sequence", with_views(["cameras"], """
SELECT camera_id, habitat, row_number() OVER (ORDER BY habitat, camera_id) AS seq FROM cameras"""))
def camera_sequence(spark, sf):
    """Dense sequential ids in a total order (range-partitioned)."""
    return W.seq_id(S.cameras(spark, sf).select("camera_id", "habitat"), ["habitat", "camera_id"])


@register("camera_halves", with_views(["cameras"], """
SELECT camera_id, CASE WHEN row_number() OVER (ORDER BY lat, camera_id) <= ceil(count(*) OVER () / 2) THEN 1 ELSE 2 END AS half
FROM cameras"""))
def camera_halves(spark, sf):
    """First / second half by latitude."""
    return W.halves(S.cameras(spark, sf).select("camera_id", "lat"), ["lat", "camera_id"]).select("camera_id", "half")


@register("species_share_within", with_views(["observations"], """
WITH ev AS (SELECT camera_id, species, count(*) AS day_count FROM (
  SELECT DISTINCT camera_id, species, month, ymd FROM observations) d GROUP BY camera_id, species)
SELECT camera_id, species, day_count, sum(day_count) OVER (PARTITION BY species) AS total_events,
       count(*) OVER (PARTITION BY species) AS n_cameras,
       day_count * 1.0 / sum(day_count) OVER (PARTITION BY camera_id) AS share
FROM ev"""))
def species_share_within(spark, sf):
    """W2 + W4: species totals and camera counts attached to rows; share of each
    species within its camera."""
    ev = A.day_events(S.observations(spark, sf))
    ev = W.with_totals(ev, ["species"], {"total_events": F.sum("day_count"), "n_cameras": F.count("*")})
    return W.share_within(ev, ["camera_id"], "day_count", "share")


@register("camera_plot_means", with_views(["cameras"], """
SELECT camera_id, plot_id, lon, avg(lon) OVER (PARTITION BY plot_id) AS lon_mean FROM cameras"""))
def camera_plot_means(spark, sf):
    """Plot mean longitude attached to each camera."""
    return W.with_group_mean(S.cameras(spark, sf).select("camera_id", "plot_id", "lon"), ["plot_id"], "lon")


@register("top_cameras", with_views(["observations"], """
SELECT camera_id, day_count FROM (
  SELECT camera_id, count(*) AS day_count FROM (SELECT DISTINCT camera_id, ymd FROM observations) d GROUP BY camera_id) c
ORDER BY day_count DESC NULLS LAST, camera_id LIMIT 20"""))
def top_cameras(spark, sf):
    """L1 + L2 + L3: top-20 cameras by active days (a top-k report)."""
    c = S.observations(spark, sf).select("camera_id", "ymd").distinct().groupBy("camera_id").agg(
        F.count("*").alias("day_count"))
    return R.head(c, 20, [F.col("day_count").desc_nulls_last(), F.col("camera_id").asc_nulls_last()])


@register("deployments_sorted_drop_first", with_views(["deployments"], """
SELECT camera_id, strftime(date_retrieved, '%Y-%m-%d') AS date_retrieved FROM (
  SELECT *, row_number() OVER (ORDER BY date_retrieved DESC NULLS LAST, camera_id) AS pos FROM deployments) d
WHERE pos <> 1"""))
def deployments_sorted_drop_first(spark, sf):
    """L1 + L4: sort by retrieval date (nulls last) and drop the first row."""
    d = S.deployments(spark, sf).select("camera_id", "date_retrieved")
    d = R.drop_position(d, [F.col("date_retrieved").desc_nulls_last(), F.col("camera_id")], 1)
    return d.select("camera_id", F.date_format("date_retrieved", "yyyy-MM-dd").alias("date_retrieved"))


@register("camera_sample", with_views(["cameras"], """
SELECT camera_id, habitat FROM cameras
ORDER BY (camera_id * 2654435761 + 42) % 4294967296, camera_id LIMIT 25"""))
def camera_sample(spark, sf):
    """Seeded sample of 25 cameras (stable hash order; sampling is the feature)."""
    c = S.cameras(spark, sf).select("camera_id", "habitat")
    return R.sample_n(c, 25, ["camera_id"], 42, hash_col=portable_hash(F.col("camera_id"), 42))


@register("sources_union", with_views(["observations", "long_observations"], """
SELECT source, species, count(*) AS n, count(confidence) AS n_with_conf FROM (
  SELECT 'events' AS source, species, confidence FROM observations
  UNION ALL SELECT 'orders', species, NULL FROM long_observations) u GROUP BY source, species"""))
def sources_union(spark, sf):
    """U1 + U3: union by name with missing columns null and a source tag."""
    u = R.union_tagged({"events": S.observations(spark, sf).select("species", "confidence"),
                        "orders": S.long_observations(spark, sf).select("species")})
    return u.groupBy("source", "species").agg(F.count("*").alias("n"), F.count("confidence").alias("n_with_conf"))


@register("union_conservation", with_views(["boxes"], """
WITH a AS (SELECT box_id FROM boxes WHERE manual), b AS (SELECT box_id FROM boxes WHERE NOT manual OR species IS NULL)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
       (SELECT count(*) FROM (SELECT box_id FROM a UNION ALL SELECT box_id FROM b) u) AS n_union,
       (SELECT count(DISTINCT box_id) FROM (SELECT box_id FROM a UNION ALL SELECT box_id FROM b) u) AS n_distinct,
       (SELECT count(*) FROM (SELECT box_id FROM a INTERSECT SELECT box_id FROM b) i) AS n_both,
       (SELECT count(*) FROM (SELECT box_id FROM a UNION ALL SELECT box_id FROM b) u) = (SELECT count(*) FROM a) + (SELECT count(*) FROM b)
         AS conserved"""))
def union_conservation(spark, sf):
    """U2 + U4 + U6: row conservation of a union, distinct keys, keys in both."""
    b = S.boxes(spark, sf)
    a = b.filter(F.col("manual")).select("box_id")
    c = b.filter(~F.col("manual") | F.col("species").isNull()).select("box_id")
    return R.conservation(a, c, "box_id")
