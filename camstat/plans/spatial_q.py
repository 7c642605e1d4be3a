"""Spatial queries: zones, radius joins, land cover, distances, dissimilarity,
density (J10-J12, J15, J16, A20, A21, O14, F25, F26, F30, X3, X4, X7)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import spatial as SP
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

# fixed values: ecozone polygons (lon, lat) used with the driver tables
ZONES = {
    "Hudson Plains": [[(-90.0, 52.5), (-85.5, 52.5), (-85.5, 56.0), (-90.0, 56.0)],
                      [(-88.5, 53.5), (-87.5, 53.5), (-87.5, 54.5), (-88.5, 54.5)]],
    "Boreal Shield": [[(-90.0, 49.5), (-82.5, 49.5), (-82.5, 52.5), (-90.0, 52.5)]],
    "Taiga Transition": [[(-85.5, 52.5), (-82.5, 52.5), (-85.5, 56.0)]],
}
# fixed values: land-cover legend (raster value, class code, label)
LEGEND = [
    (0, "ND", "No data"), (1, "WAT", "Clear open water"), (2, "XWAT", "Turbid water"),
    (3, "MixTRE", "Mixed treed"), (4, "DecTRE", "Deciduous treed"), (5, "ConTRE", "Coniferous treed"),
    (6, "TrOrSHr", "Disturbance - trees or shrubs"), (7, "NSWood", "Disturbance - non and sparse woody"),
    (8, "ThSWA", "Thicket swamp"), (9, "ConSWA", "Coniferous swamp"), (10, "URB", "Settlement and infrastructure"),
    (11, "MIN", "Mine tailings"),
]
# fixed values: class merges applied to the cover matrix
MERGES = {"WAT": ["WAT", "XWAT"], "MixTRE": ["MixTRE", "DecTRE"], "Dist": ["TrOrSHr", "NSWood"],
          "SWA": ["ThSWA", "ConSWA"], "Anth": ["URB", "MIN", "BED"]}
RADIUS_KM = 25.0
PAIR_KM = 30.0
BBOX_PAD = 1.0

_VERTS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{z}', {r}, {s}, {x}, {y})" for z, rings in ZONES.items() for r, ring in enumerate(rings)
    for s, (x, y) in enumerate(ring)) + ") AS t(zone, ring, seq, x, y)"
_EDGES_SQL = """
SELECT zone, ring, x AS x1, y AS y1,
       coalesce(lead(x) OVER w, first_value(x) OVER (PARTITION BY zone, ring ORDER BY seq)) AS x2,
       coalesce(lead(y) OVER w, first_value(y) OVER (PARTITION BY zone, ring ORDER BY seq)) AS y2
FROM verts WINDOW w AS (PARTITION BY zone, ring ORDER BY seq)"""
_ZONE_OF_SQL = """
SELECT c.camera_id, z.zone FROM cameras c LEFT JOIN (
  SELECT c.camera_id, e.zone FROM cameras c JOIN edges e
    ON c.lat >= least(e.y1, e.y2) AND c.lat < greatest(e.y1, e.y2)
   AND c.lon < e.x1 + (c.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
  GROUP BY c.camera_id, e.zone HAVING count(*) % 2 = 1) z ON c.camera_id = z.camera_id"""
_LEGEND_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({v}, '{c}', '{l}')" for v, c, l in LEGEND) + \
    ") AS t(value, category_code, label)"


def _zone_edges(spark):
    return SP.polygon_edges(SP.literal_polygons(spark, ZONES))


def _legend(spark):
    # literal table of known, fixed size: safe to broadcast
    return F.broadcast(spark.createDataFrame(LEGEND, "value long, category_code string, label string"))


@register("zone_of_camera", with_views(["cameras"], _ZONE_OF_SQL, {"verts": _VERTS_SQL, "edges": _EDGES_SQL}))
def zone_of_camera(spark, sf):
    """Ecozone of each camera by edge-parity point-in-polygon (holes respected)."""
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    return SP.zone_of(cams, F.broadcast(_zone_edges(spark))).select("camera_id", "zone")


@register("zones_with_cameras", with_views(["cameras"], f"""
SELECT DISTINCT v.zone FROM verts v WHERE v.zone IN (SELECT zone FROM ({_ZONE_OF_SQL}) z WHERE zone IS NOT NULL)""",
    {"verts": _VERTS_SQL, "edges": _EDGES_SQL}))
def zones_with_cameras(spark, sf):
    """Zones holding at least one camera."""
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    located = SP.zone_of(cams, F.broadcast(_zone_edges(spark)))
    zones = SP.literal_polygons(spark, ZONES).select("zone").distinct()
    return SP.zones_with_points(zones, located)


@register("zone_bbox", with_views(["cameras"], f"""
SELECT z.zone, min(c.lon) - {BBOX_PAD} AS xmin, max(c.lon) + {BBOX_PAD} AS xmax, min(c.lat) - {BBOX_PAD} AS ymin, max(c.lat) + {BBOX_PAD} AS ymax
FROM cameras c JOIN ({_ZONE_OF_SQL}) z ON c.camera_id = z.camera_id WHERE z.zone IS NOT NULL GROUP BY z.zone""",
    {"verts": _VERTS_SQL, "edges": _EDGES_SQL}))
def zone_bbox(spark, sf):
    """bounding box of the cameras of each zone, padded by one degree."""
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    return SP.padded_bbox(SP.zone_of(cams, F.broadcast(_zone_edges(spark))).filter(F.col("zone").isNotNull()), ["zone"], BBOX_PAD)


@register("plot_bbox", with_views(["cameras"], f"""
SELECT plot_id, min(lon) - {BBOX_PAD} AS xmin, max(lon) + {BBOX_PAD} AS xmax, min(lat) - {BBOX_PAD} AS ymin, max(lat) + {BBOX_PAD} AS ymax
FROM cameras GROUP BY plot_id"""))
def plot_bbox(spark, sf):
    """padded bounding box of each plot's cameras."""
    return SP.padded_bbox(S.cameras(spark, sf), ["plot_id"], BBOX_PAD)


def _hav_sql(a, b, bx="lon", by="lat"):
    return (f"2 * 6371.0 * asin(least(1.0, sqrt(power(sin((radians({b}.{by}) - radians({a}.lat)) / 2), 2) + "
            f"cos(radians({a}.lat)) * cos(radians({b}.{by})) * power(sin((radians({b}.{bx}) - radians({a}.lon)) / 2), 2))))")


def _pairs_sql(where="TRUE"):
    # the latitude test only spares the oracle distances that cannot be within the radius
    return f"""
SELECT c.camera_id, l.cell_id, l.value, l.coverage_fraction, l.utm FROM cameras c JOIN cells l
  ON abs(c.lat - l.cy) <= {RADIUS_KM / 111.0 + 0.01!r} AND {where} AND {_hav_sql('c', 'l', 'cx', 'cy')} <= {RADIUS_KM!r}"""


def _cam_cells(spark, sf, aggs, by=None, cells=None):
    """Cells within 25 km of each camera, summed per camera (and class)."""
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    return SP.cover_near(cams, S.cells(spark, sf) if cells is None else cells, RADIUS_KM, aggs, by)


@register("cells_near_cameras", with_views(["cameras", "cells"], """
SELECT camera_id, count(*) AS n_cells, sum(coverage_fraction) AS coverage FROM pairs GROUP BY camera_id""",
    {"pairs": _pairs_sql()}))
def cells_near_cameras(spark, sf):
    """Raster cells within 25 km of each camera (great-circle, position-first)."""
    return _cam_cells(spark, sf, {"n_cells": F.count("*"), "coverage": F.sum("coverage_fraction")})


@register("cover_props", with_views(["cameras", "cells"], """
WITH n AS (SELECT camera_id, value, count(*) AS k FROM pairs WHERE value IS NOT NULL GROUP BY camera_id, value),
t AS (SELECT camera_id, count(*) AS tot FROM pairs WHERE value IS NOT NULL GROUP BY camera_id),
p AS (SELECT n.camera_id, g.category_code, n.k * 1.0 / t.tot AS props FROM n JOIN t ON n.camera_id = t.camera_id
      LEFT JOIN legend g ON n.value = g.value WHERE g.category_code IS NOT NULL)
SELECT camera_id, CASE WHEN category_code IN ('WAT', 'XWAT') THEN 'WAT' WHEN category_code IN ('MixTRE', 'DecTRE') THEN 'MixTRE'
                       WHEN category_code IN ('TrOrSHr', 'NSWood') THEN 'Dist' WHEN category_code IN ('ThSWA', 'ConSWA') THEN 'SWA'
                       WHEN category_code IN ('URB', 'MIN', 'BED') THEN 'Anth' ELSE category_code END AS category_code,
       sum(props) AS props
FROM p GROUP BY 1, 2""", {"pairs": _pairs_sql(), "legend": _LEGEND_SQL}))
def cover_props(spark, sf):
    """A21 + O14: per-camera land-cover shares in a 25 km buffer, classes merged."""
    p = SP.cover_props(_cam_cells(spark, sf, {"n": F.count("*")}, ["value"]), _legend(spark))
    return O.merge_classes(p, MERGES, ["camera_id"], "category_code", "props")


@register("cover_totals", with_views(["cameras", "cells"], """
WITH tot AS (SELECT value, sum(coverage_fraction) AS total FROM pairs GROUP BY value),
pct AS (SELECT value, round(total / sum(total) OVER () * 100, 2) AS percentage FROM tot)
SELECT g.category_code, g.label, coalesce(p.percentage, 0.0) AS percentage
FROM legend g LEFT JOIN pct p ON g.value = p.value WHERE g.category_code <> 'ND'""",
    {"pairs": _pairs_sql(), "legend": _LEGEND_SQL}))
def cover_totals(spark, sf):
    """Coverage-weighted land-cover percentages over all buffers."""
    return SP.cover_totals(_cam_cells(spark, sf, {"total": F.sum("coverage_fraction")}, ["value"]), _legend(spark))


_EV_SQL = """SELECT camera_id, species, count(*) AS day_count FROM (
  SELECT DISTINCT camera_id, species, month, ymd FROM observations) d GROUP BY camera_id, species"""


@register("hellinger_events", with_views(["observations"], """
SELECT camera_id, species, day_count, sqrt(day_count / sum(day_count) OVER (PARTITION BY camera_id)) AS hellinger FROM ev""",
    {"ev": _EV_SQL}))
def hellinger_events(spark, sf):
    """Hellinger-transformed camera x species day-events."""
    return SP.hellinger(A.day_events(S.observations(spark, sf)), "camera_id", "species", "day_count")


_CAM_PAIRS_SQL = f"""
SELECT a.plot_id, a.camera_id AS a, b.camera_id AS b, {_hav_sql('a', 'b')} AS dist_km
FROM cameras a JOIN cameras b ON a.plot_id = b.plot_id AND a.camera_id < b.camera_id"""


@register("camera_pairs_within", with_views(["cameras"], _CAM_PAIRS_SQL))
def camera_pairs_within(spark, sf):
    """J15 + F26: great-circle distances between the cameras of each plot."""
    return SP.pairs_in_group(S.cameras(spark, sf), "plot_id")


def _obs_cam_pairs(spark, sf):
    cams = S.cameras(spark, sf).join(S.observations(spark, sf).select("camera_id").distinct(), "camera_id", "left_semi")
    return SP.pairs_in_group(cams, "plot_id")


_OBS_PAIRS_SQL = """
SELECT a.camera_id AS a, b.camera_id AS b FROM cameras a JOIN cameras b ON a.plot_id = b.plot_id AND a.camera_id < b.camera_id
WHERE a.camera_id IN (SELECT camera_id FROM observations) AND b.camera_id IN (SELECT camera_id FROM observations)"""


@register("gower_pairs", with_views(["observations", "cameras"], """
WITH units AS (SELECT count(DISTINCT camera_id) AS nu FROM ev),
st AS (SELECT species, max(day_count) AS mx, min(day_count) AS mn, count(*) AS k FROM ev GROUP BY species),
rng AS (SELECT species, CASE WHEN k < nu THEN greatest(mx, 0) ELSE mx END - CASE WHEN k < nu THEN least(mn, 0) ELSE mn END AS r
        FROM st, units),
rg AS (SELECT * FROM rng WHERE r > 0),
nv AS (SELECT count(*) AS nv FROM rg),
diffs AS (SELECT p.a, p.b, rg.species, abs(coalesce(ea.day_count, 0) - coalesce(eb.day_count, 0)) / rg.r AS d
          FROM pairs p CROSS JOIN rg LEFT JOIN ev ea ON ea.camera_id = p.a AND ea.species = rg.species
          LEFT JOIN ev eb ON eb.camera_id = p.b AND eb.species = rg.species)
SELECT a, b, sum(d) / (SELECT nv FROM nv) AS gower FROM diffs GROUP BY a, b""",
    {"ev": _EV_SQL, "pairs": _OBS_PAIRS_SQL}))
def gower_pairs(spark, sf):
    """Gower dissimilarity of day-event profiles for the cameras of a plot."""
    ev = A.day_events(S.observations(spark, sf))
    return SP.gower(ev.withColumn("day_count", F.col("day_count").cast("double")), _obs_cam_pairs(spark, sf),
                    "camera_id", "species", "day_count")


@register("jaccard_pairs", with_views(["observations", "cameras"], """
WITH pa AS (SELECT DISTINCT camera_id, species FROM observations),
sz AS (SELECT camera_id, count(*) AS n FROM pa GROUP BY camera_id),
it AS (SELECT p.a, p.b, count(*) AS i FROM pairs p JOIN pa x ON x.camera_id = p.a
       JOIN pa y ON y.camera_id = p.b AND y.species = x.species GROUP BY p.a, p.b)
SELECT p.a, p.b, CASE WHEN coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(it.i, 0) > 0
                      THEN 1 - coalesce(it.i, 0) * 1.0 / (coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(it.i, 0))
                      ELSE 0.0 END AS jaccard
FROM pairs p LEFT JOIN it ON it.a = p.a AND it.b = p.b LEFT JOIN sz sa ON sa.camera_id = p.a
LEFT JOIN sz sb ON sb.camera_id = p.b""", {"pairs": _OBS_PAIRS_SQL}))
def jaccard_pairs(spark, sf):
    """Jaccard dissimilarity of species presence for the cameras of a plot."""
    pa = A.presence_absence(S.observations(spark, sf))
    return SP.jaccard(pa, _obs_cam_pairs(spark, sf), "camera_id", "species")


GRID = (-90.0, -83.0, 50.0, 55.5, 0.5)
BANDWIDTH = 0.75


@register("sighting_density", with_views(["observations", "cameras"], f"""
WITH loc AS (SELECT o.species, c.lon, c.lat, count(*) AS w FROM observations o JOIN cameras c ON o.camera_id = c.camera_id
             GROUP BY o.species, c.lon, c.lat),
g AS (SELECT gx, gy, {GRID[0]} + (gx + 0.5) * {GRID[4]} AS x, {GRID[2]} + (gy + 0.5) * {GRID[4]} AS y
      FROM range(0, {int(round((GRID[1] - GRID[0]) / GRID[4]))}) a(gx), range(0, {int(round((GRID[3] - GRID[2]) / GRID[4]))}) b(gy)),
tw AS (SELECT species, sum(w) AS tw FROM loc GROUP BY species)
SELECT loc.species, g.gx, g.gy, g.x, g.y,
       sum(loc.w * exp(-(power(loc.lon - g.x, 2) + power(loc.lat - g.y, 2)) / {2 * BANDWIDTH ** 2!r}))
         * {1.0 / (2 * math.pi * BANDWIDTH ** 2)!r} / tw.tw AS density
FROM loc CROSS JOIN g JOIN tw ON loc.species = tw.species GROUP BY loc.species, g.gx, g.gy, g.x, g.y, tw.tw"""))
def sighting_density(spark, sf):
    """X7 + J16: Gaussian kernel density of sightings per species on a 0.5 degree grid."""
    o = S.observations(spark, sf).select("camera_id", "species")
    pts = o.join(S.cameras(spark, sf).select("camera_id", "lon", "lat"), "camera_id", "inner")
    x0, x1, y0, y1, step = GRID
    return SP.kernel_density(pts, x0, x1, y0, y1, step, BANDWIDTH, by=["species"])
