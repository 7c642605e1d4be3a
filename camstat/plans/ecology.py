"""Observation tables: day events, presence, abundance, latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import joins as J
from camstat.operators.reshape import named_list
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

SPECIES_MIN_DAYS = 50
PLOT_MIN_DAYS = 50


def _names(spark):
    # literal table of known, fixed size: safe to broadcast
    return F.broadcast(named_list(spark, S.SCIENTIFIC, "species", "scientific_name"))


NAMES_SQL = ("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in S.SCIENTIFIC.items())
             + ") AS t(species, scientific_name)")


@register("species_table", with_views(["observations"], f"""
SELECT e.species, n.scientific_name, e.days_detected FROM (
  SELECT species, sum(day_count) AS days_detected FROM (
    SELECT camera_id, species, count(*) AS day_count FROM (
      SELECT DISTINCT camera_id, species, month, ymd FROM observations) d
    GROUP BY camera_id, species) c
  GROUP BY species HAVING sum(day_count) >= {SPECIES_MIN_DAYS}) e
LEFT JOIN names n ON e.species = n.species""", {"names": NAMES_SQL}))
def species_table(spark, sf):
    """Camera day-events -> days detected per species (>= 50) with scientific names."""
    ev = A.day_events(S.observations(spark, sf), unit="camera_id")
    return A.species_table(ev, _names(spark), min_days=SPECIES_MIN_DAYS)


@register("day_events_camera", with_views(["observations"], """
SELECT camera_id, species, count(*) AS day_count FROM (
  SELECT DISTINCT camera_id, species, month, ymd FROM observations) d
GROUP BY camera_id, species"""))
def day_events_camera(spark, sf):
    return A.day_events(S.observations(spark, sf), unit="camera_id")


@register("day_events_plot_filtered", with_views(["observations"], f"""
WITH ev AS (SELECT plot_id, species, count(*) AS day_count FROM (
  SELECT DISTINCT plot_id, species, month, ymd FROM observations) d GROUP BY plot_id, species)
SELECT * FROM ev WHERE species IN (
  SELECT species FROM ev GROUP BY species HAVING sum(day_count) > {PLOT_MIN_DAYS})"""))
def day_events_plot_filtered(spark, sf):
    """A9 by plot, then O20: keep species whose plot total exceeds 50 days."""
    ev = A.day_events(S.observations(spark, sf), unit="plot_id")
    return O.columns_by_sum(ev, "species", "day_count", PLOT_MIN_DAYS)


def _wide_sql(row, src, val, species):
    cols = ", ".join(f"coalesce(sum(CASE WHEN species = '{s}' THEN {val} END), 0) AS \"{s}\"" for s in species)
    return f"SELECT {row}, {cols} FROM {src} GROUP BY {row}"


@register("abundance_matrix_plot", with_views(["observations"], _wide_sql(
    "plot_id", "(SELECT plot_id, species, count(*) AS day_count FROM (SELECT DISTINCT plot_id, species, month, ymd "
    "FROM observations) d GROUP BY plot_id, species) e", "day_count", S.OBS_SPECIES)))
def abundance_matrix_plot(spark, sf):
    """A10: plot x species day-event matrix, 0-filled, static species list."""
    ev = A.day_events(S.observations(spark, sf), unit="plot_id")
    return A.pivot_wide(ev, "plot_id", "species", "day_count", S.OBS_SPECIES).orderBy("plot_id")


@register("presence_absence", with_views(["observations"], _wide_sql(
    "camera_id", "(SELECT DISTINCT camera_id, species, 1 AS present FROM observations WHERE species IS NOT NULL) p",
    "present", S.OBS_SPECIES)))
def presence_absence(spark, sf):
    """Camera x species 0/1 matrix."""
    pa = A.presence_absence(S.observations(spark, sf))
    return A.pivot_wide(pa, "camera_id", "species", "present", S.OBS_SPECIES).orderBy("camera_id")


@register("monthly_events", with_views(["long_observations", "cameras"], """
SELECT m.camera_id, m.species, m.month, m.n_days, c.lon, c.lat FROM (
  SELECT camera_id, species, month, count(*) AS n_days FROM (
    SELECT DISTINCT camera_id, species, month, ymd FROM long_observations) d
  GROUP BY camera_id, species, month) m
LEFT JOIN cameras c ON m.camera_id = c.camera_id"""))
def monthly_events(spark, sf):
    """A11 + J2: day-events by camera x species x month with coordinates."""
    m = A.monthly_events(S.long_observations(spark, sf))
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    return J.join_dim(m, cams, "camera_id")


LATENCY_MIN_CAMERAS = 3
LATENCY_MAX_DAYS = 200


@register("detection_latency", with_views(["observations", "cameras"], f"""
WITH cam_days AS (SELECT camera_id, min(date_time) AS camera_first_day FROM observations GROUP BY camera_id),
zones AS (SELECT c.camera_id, r.r_name AS zone FROM cameras c JOIN nation n ON c.site_id = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey),
g AS (SELECT o.species, o.camera_id, min(o.date_time) AS first_day, min(cd.camera_first_day) AS camera_first_day,
             count(DISTINCT o.ymd) AS camera_events
      FROM observations o LEFT JOIN cam_days cd ON o.camera_id = cd.camera_id GROUP BY o.species, o.camera_id),
gz AS (SELECT g.*, z.zone FROM g LEFT JOIN zones z ON g.camera_id = z.camera_id),
tot AS (SELECT species, sum(camera_events) AS total_events, count(*) AS n_cameras FROM gz GROUP BY species)
SELECT gz.species, gz.camera_id, strftime(gz.first_day, '%Y-%m-%d %H:%M:%S') AS first_day,
       strftime(gz.camera_first_day, '%Y-%m-%d %H:%M:%S') AS camera_first_day, gz.camera_events, gz.zone,
       tot.total_events, tot.n_cameras,
       round((epoch_us(gz.first_day) - epoch_us(gz.camera_first_day)) / 86400e6, 6) AS diff_days
FROM gz JOIN tot ON gz.species = tot.species
WHERE tot.n_cameras > {LATENCY_MIN_CAMERAS}
  AND (epoch_us(gz.first_day) - epoch_us(gz.camera_first_day)) / 86400e6 < {LATENCY_MAX_DAYS}"""))
def detection_latency(spark, sf):
    """A12 + A13 + J2: days from camera start to each species' first sighting."""
    obs = S.observations(spark, sf)
    cam_days = obs.groupBy("camera_id").agg(F.min("date_time").alias("camera_first_day"))
    zones = _camera_regions(spark, sf)
    return A.detection_latency(obs, cam_days, zones, min_cameras=LATENCY_MIN_CAMERAS,
                               max_days=LATENCY_MAX_DAYS)


def _camera_regions(spark, sf):
    n = S.table(spark, sf, "nation").select(F.col("n_nationkey").alias("site_id"), "n_regionkey")
    r = S.table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                            F.col("r_name").alias("zone"))
    return (S.cameras(spark, sf).select("camera_id", "site_id")
            .join(n, "site_id", "inner").join(r, "n_regionkey", "inner").select("camera_id", "zone"))


@register("species_days_mean_sd", with_views(["observations"], """
SELECT avg(d) AS mean, stddev_samp(d) AS sd FROM (
  SELECT species, sum(day_count) AS d FROM (
    SELECT camera_id, species, count(*) AS day_count FROM (
      SELECT DISTINCT camera_id, species, month, ymd FROM observations) x GROUP BY camera_id, species) y
  GROUP BY species) z"""))
def species_days_mean_sd(spark, sf):
    """A14 over the per-species day totals."""
    ev = A.day_events(S.observations(spark, sf))
    t = ev.groupBy("species").agg(F.sum("day_count").alias("d"))
    return A.mean_sd(t, "d")


@register("plot_centroid", with_views(["cameras"], """
SELECT plot_id, avg(lon) AS lon, avg(lat) AS lat FROM cameras GROUP BY plot_id"""))
def plot_centroid(spark, sf):
    """A15."""
    return A.plot_centroid(S.cameras(spark, sf), "plot_id", "lon", "lat")


@register("hit_rate", with_views(["observations"], """
SELECT species, count(DISTINCT camera_id) AS n_cameras,
       count(DISTINCT camera_id) * 100.0 / (SELECT count(DISTINCT camera_id) FROM observations) AS rate
FROM observations GROUP BY species"""))
def hit_rate(spark, sf):
    """A19."""
    return A.hit_rate(S.observations(spark, sf))
