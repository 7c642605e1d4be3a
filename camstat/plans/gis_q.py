"""Projections, exact coverage, raster and vector files, cell covers, smooths, densities, Ward groups, pruned trees, bursts on a
stream and ingest with overwrite (S7, S8, J10, J12, A18, A20, X5-X8, X13, T1, T2)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from camstat.functions import projection as P
from camstat.operators import cellcover as CC
from camstat.operators import coverage as CV
from camstat.operators import density as D
from camstat.operators import rtree as RT
from camstat.operators import smooth as SM
from camstat.operators import spatial as SP
from camstat.operators import ward as WD
from camstat.plans import learning_q as LQ
from camstat.plans import spatial_q as SQ
from camstat.plans import windows_q as WQ
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.session import shared_path
from camstat.sources import adapters as S
from camstat.sources import raster as R
from camstat.sources import shapefile as SH
from camstat.streaming.bursts import replay_bursts
from camstat.streaming.replace import ingest_current

UTM = P.utm(16)
RADIUS_M, CELL_M = 25_000.0, 10_000.0
# fixed values: upper left corner and size of the land-cover raster in UTM zone 16
LEFT, TOP, COLUMNS, ROWS = 290_000.0, 6_150_000.0, 42, 61
EPSG = 32616


def _utm_sql() -> str:
    """Cameras with their UTM coordinates, in SQL arithmetic."""
    e, radius, alpha, _ = UTM._series()
    x = " + ".join(f"{c!r} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, c in enumerate(alpha, 1))
    y = " + ".join(f"{c!r} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, c in enumerate(alpha, 1))
    return f"""
SELECT camera_id, lon, lat, {UTM.east0!r} + {UTM.k0 * radius!r} * (eta + {x}) AS px, {UTM.north0!r} + {UTM.k0 * radius!r} * (xi + {y}) AS py FROM (
  SELECT *, atan2(t, cos(dl)) AS xi, asinh(sin(dl) / sqrt(t * t + cos(dl) * cos(dl))) AS eta FROM (
    SELECT *, radians(lon - ({UTM.lon0!r})) AS dl, sinh(atanh(sin(radians(lat))) - {e!r} * atanh({e!r} * sin(radians(lat)))) AS t FROM cameras) a) b"""


def _projected(spark, sf):
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    x, y = UTM.forward(F.col("lon"), F.col("lat"))
    return cams.withColumns({"px": x, "py": y})


@register("cameras_projected", with_views(["cameras"], """
SELECT camera_id, round(px, 4) AS px, round(py, 4) AS py, lon AS lon_back, lat AS lat_back FROM utm""", {"utm": _utm_sql()}))
def cameras_projected(spark, sf):
    """Cameras in UTM zone 16 and back again."""
    p = _projected(spark, sf)
    lon, lat = UTM.inverse(F.col("px"), F.col("py"))
    return p.select("camera_id", F.round("px", 4).alias("px"), F.round("py", 4).alias("py"), F.round(lon, 8).alias("lon_back"), F.round(lat, 8).alias("lat_back"))


_CELLS_SQL = f"""
SELECT floor(p_partkey / {COLUMNS}) % {ROWS} AS row, p_partkey % {COLUMNS} AS col, p_size % 13 AS value,
       {LEFT!r} + (p_partkey % {COLUMNS} + 0.5) * {CELL_M!r} AS cx, {TOP!r} - (floor(p_partkey / {COLUMNS}) % {ROWS} + 0.5) * {CELL_M!r} AS cy
FROM part"""


def _utm_cells(spark, sf):
    """Land-cover cells on a 10 km lattice of UTM zone 16 (places repeat where there are more parts than cells)."""
    p = S.table(spark, sf, "part")
    row, col = F.floor(F.col("p_partkey") / COLUMNS) % ROWS, F.col("p_partkey") % COLUMNS
    return p.select(row.alias("row"), col.alias("col"), (F.col("p_size") % 13).alias("value"),
                    (LEFT + (col + 0.5) * CELL_M).alias("cx"), (TOP - (row + 0.5) * CELL_M).alias("cy"))


def _disc_sql(x: str, y: str, r: float) -> str:
    """SQL twin of ``coverage.disc_below``."""
    def half(t: str) -> str:
        return f"((({t}) * sqrt(greatest(0.0, {r * r!r} - ({t}) * ({t}))) + {r * r!r} * asin(greatest(-1.0, least(1.0, ({t}) / {r!r})))) / 2 + {r * r * math.pi / 4!r})"

    x, y = f"greatest({-r!r}, least({r!r}, {x}))", f"greatest({-r!r}, least({r!r}, {y}))"
    c = f"sqrt({r * r!r} - {y} * {y})"
    at = f"greatest(-{c}, least({c}, {x}))"
    span = f"({half(at)} - {half('-' + c)})"
    return f"(CASE WHEN {y} < 0 THEN {span} + {y} * ({at} + {c}) ELSE 2 * {half(x)} - ({span} - {y} * ({at} + {c})) END)"


_COVER_SQL = f"""
SELECT px, py, value, n, greatest(0.0, {_disc_sql('dx + 5000', 'dy + 5000', RADIUS_M)} - {_disc_sql('dx - 5000', 'dy + 5000', RADIUS_M)}
  - {_disc_sql('dx + 5000', 'dy - 5000', RADIUS_M)} + {_disc_sql('dx - 5000', 'dy - 5000', RADIUS_M)}) / {CELL_M * CELL_M!r} AS f
FROM (SELECT p.px, p.py, c.value, c.n, c.cx - p.px AS dx, c.cy - p.py AS dy FROM (SELECT DISTINCT px, py FROM utm) p
      JOIN (SELECT cx, cy, value, count(*) AS n FROM rcells GROUP BY ALL) c
        ON abs(c.cx - p.px) < {RADIUS_M + CELL_M / 2!r} AND abs(c.cy - p.py) < {RADIUS_M + CELL_M / 2!r}) d"""
_COVER_VIEWS = {"utm": _utm_sql(), "rcells": _CELLS_SQL, "met": _COVER_SQL}


def _fractions(spark, sf, by=None):
    return CV.cover_fractions(_projected(spark, sf), _utm_cells(spark, sf), RADIUS_M, CELL_M, by=by)


@register("cover_fractions", with_views(["cameras"], """
SELECT u.camera_id, m.n_cells, m.fraction FROM utm u JOIN (
  SELECT px, py, sum(n) AS n_cells, sum(n * f) AS fraction FROM met WHERE f > 1e-12 GROUP BY px, py) m ON u.px = m.px AND u.py = m.py""", _COVER_VIEWS))
def cover_fractions(spark, sf):
    """Cells under each camera's 25 km buffer and the summed fractions of them that it covers, in UTM."""
    f = _fractions(spark, sf).select(F.col("px").alias("_px"), F.col("py").alias("_py"), "n_cells", "fraction")
    p = _projected(spark, sf)
    return p.join(f, (F.col("px") == F.col("_px")) & (F.col("py") == F.col("_py"))).select("camera_id", "n_cells", "fraction")


@register("cover_totals_exact", with_views(["cameras"], """
WITH tot AS (SELECT m.value, sum(m.n * m.f) AS total FROM utm u JOIN met m ON u.px = m.px AND u.py = m.py WHERE m.f > 1e-12 GROUP BY m.value),
pct AS (SELECT value, round(total / sum(total) OVER () * 100, 2) AS percentage FROM tot)
SELECT g.category_code, g.label, coalesce(p.percentage, 0.0) AS percentage
FROM legend g LEFT JOIN pct p ON g.value = p.value WHERE g.category_code <> 'ND'""", {**_COVER_VIEWS, "legend": SQ._LEGEND_SQL}))
def cover_totals_exact(spark, sf):
    """A20 + J12: land-cover percentages over all buffers, cells weighted by the fraction that each buffer covers."""
    f = _fractions(spark, sf, ["value"])
    weight = _projected(spark, sf).groupBy(F.col("px").alias("_px"), F.col("py").alias("_py")).agg(F.count("*").alias("n_cameras"))
    per = f.join(weight, (F.col("px") == F.col("_px")) & (F.col("py") == F.col("_py"))).select("value", (F.col("fraction") * F.col("n_cameras")).alias("total"))
    return SP.cover_totals(per, SQ._legend(spark))


@register("raster_cells_read", f"""
SELECT row, col, {LEFT!r} + (col + 0.5) * {CELL_M!r} AS x, {TOP!r} - (row + 0.5) * {CELL_M!r} AS y, max(value) AS value, {EPSG} AS epsg
FROM ({_CELLS_SQL}) c GROUP BY row, col""")
def raster_cells_read(spark, sf):
    """The cells written as GeoTIFF sheets and read back tile by tile."""
    folder = shared_path(spark, "raster")
    cells = _utm_cells(spark, sf).groupBy("row", "col").agg(F.max("value").alias("value"))
    R.write_sheets(cells, folder, LEFT, TOP, CELL_M, EPSG, sheet=32).collect()
    got = R.read_raster(spark, folder)
    return got.select(F.floor((TOP - F.col("y")) / CELL_M).alias("row"), F.floor((F.col("x") - LEFT) / CELL_M).alias("col"), "x", "y",
                      F.col("value").cast("long").alias("value"), "epsg")


_DIAMOND = [(0.0, 0.05), (0.05, 0.0), (0.0, -0.05), (-0.05, 0.0)]


@register("shapefile_zones_read", with_views(["cameras"], "SELECT camera_id, habitat, 0 AS ring, seq, lon + dx AS x, lat + dy AS y FROM cameras, (VALUES "
          + ", ".join(f"({k}, {x!r}, {y!r})" for k, (x, y) in enumerate(_DIAMOND)) + ") AS d(seq, dx, dy)"))
def shapefile_zones_read(spark, sf):
    """A diamond around each camera, written as one shapefile per site and read back with its attributes."""
    folder = shared_path(spark, "shapes")
    corners = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(x).alias("dx"), F.lit(y).alias("dy")) for k, (x, y) in enumerate(_DIAMOND)])
    v = S.cameras(spark, sf).withColumn("c", F.explode(corners)).select(
        "site_id", "camera_id", "habitat", F.lit(0).alias("ring"), "c.seq", (F.col("lon") + F.col("c.dx")).alias("x"), (F.col("lat") + F.col("c.dy")).alias("y"))
    SH.write_shapes(v, folder, "site_id", "camera_id", ["habitat"]).collect()
    back = SH.read_shapes(spark, folder).join(SH.read_attributes(spark, folder), ["path", "record"])
    return back.select(F.col("camera_id").cast("long").alias("camera_id"), "habitat", "ring", "seq", "x", "y")


@register("zone_of_camera_cells", with_views(["cameras"], SQ._ZONE_OF_SQL, {"verts": SQ._VERTS_SQL, "edges": SQ._EDGES_SQL}))
def zone_of_camera_cells(spark, sf):
    """Ecozone of each camera by a cover of cells: inner cells decide alone, border cells by their own edges."""
    cells = CC.cover(SQ._zone_edges(spark), most_edges=2)
    return CC.locate(S.cameras(spark, sf).select("camera_id", "lon", "lat"), cells).select("camera_id", "zone")


@register("stream_burst_expansion", with_views(["observations"], f"""
WITH f AS (SELECT obs_id, camera_id, date_time, confidence, CASE WHEN lag(date_time) OVER w IS NULL
                   OR epoch_us(date_time) - epoch_us(lag(date_time) OVER w) >= {WQ.GAP_S}000000 THEN 1 ELSE 0 END AS new
           FROM observations WHERE camera_id IS NOT NULL AND date_time IS NOT NULL WINDOW w AS (PARTITION BY camera_id ORDER BY date_time, obs_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY camera_id ORDER BY date_time, obs_id ROWS UNBOUNDED PRECEDING) AS burst FROM f)
SELECT obs_id, camera_id, confidence FROM s QUALIFY max(confidence) OVER (PARTITION BY camera_id, burst) > {WQ.BURST_THR}"""))
def stream_burst_expansion(spark, sf):
    """T2 + W7: the burst rule on a stream, restarted between three slices of a replay."""
    o = S.observations(spark, sf).select("obs_id", "camera_id", "date_time", "confidence")
    return replay_bursts(o, shared_path(spark, "stream-bursts"), ["camera_id"], "date_time", WQ.BURST_THR, gap_seconds=WQ.GAP_S).select(
        "obs_id", "camera_id", "confidence")


_AREAS = "SELECT category_id, w * h AS area FROM boxes"


@register("box_size_violins", with_views(["boxes"], """
WITH s AS (SELECT category_id, count(*) AS n, min(area) AS lo, max(area) AS hi, stddev_samp(area) AS sd,
                  (quantile_cont(area, 0.75) - quantile_cont(area, 0.25)) / 1.34 AS iqr FROM areas GROUP BY category_id),
st AS (SELECT category_id, n, lo, 0.9 * CASE WHEN sd > 0 AND iqr > 0 THEN least(sd, iqr) WHEN sd > 0 THEN sd ELSE 1.0 END * power(n, -0.2) AS bandwidth,
              (hi - lo) / 63 AS step FROM s),
p AS (SELECT a.category_id, (a.area - st.lo) / st.step AS pos, least(floor((a.area - st.lo) / st.step), 62) AS m FROM areas a JOIN st USING (category_id)),
b AS (SELECT category_id, m, sum(w) AS w FROM (SELECT category_id, m, 1 - (pos - m) AS w FROM p UNION ALL SELECT category_id, m + 1, pos - m FROM p) u GROUP BY category_id, m),
k AS (SELECT st.category_id, st.n, st.bandwidth, g.node, st.lo + g.node * st.step AS value,
             sum(b.w * exp(-power((g.node - b.m) * st.step / st.bandwidth, 2) / 2)) / (st.n * st.bandwidth * sqrt(2 * pi())) AS density
      FROM st JOIN b USING (category_id), range(64) g(node) GROUP BY st.category_id, st.n, st.bandwidth, g.node, st.lo, st.step)
SELECT *, density / max(density) OVER (PARTITION BY category_id) AS width FROM k""", {"areas": _AREAS}))
def box_size_violins(spark, sf):
    """Violin outlines of box areas per category."""
    from camstat.functions import geometry as G
    return D.violin(S.boxes(spark, sf).withColumn("area", G.box_area("w", "h")), "area", ["category_id"])


_MAP = (-90.0, -83.0, 50.0, 55.5, 15)


@register("sighting_density_month", with_views(["observations", "cameras"], f"""
WITH o AS (SELECT o.species, o.month, c.lon, c.lat FROM observations o JOIN cameras c ON o.camera_id = c.camera_id),
s AS (SELECT species, month, count(*) AS n, stddev_samp(lon) AS sx, (quantile_cont(lon, 0.75) - quantile_cont(lon, 0.25)) / 1.34 AS ix,
             stddev_samp(lat) AS sy, (quantile_cont(lat, 0.75) - quantile_cont(lat, 0.25)) / 1.34 AS iy FROM o GROUP BY species, month HAVING count(*) >= 2),
h AS (SELECT species, month, n, 1.06 * power(n, -0.2) * CASE WHEN sx > 0 AND ix > 0 THEN least(sx, ix) WHEN sx > 0 THEN sx ELSE 1.0 END AS hx,
             1.06 * power(n, -0.2) * CASE WHEN sy > 0 AND iy > 0 THEN least(sy, iy) WHEN sy > 0 THEN sy ELSE 1.0 END AS hy FROM s),
g AS (SELECT gx, gy, {_MAP[0]} + gx * {(_MAP[1] - _MAP[0]) / (_MAP[4] - 1)!r} AS x, {_MAP[2]} + gy * {(_MAP[3] - _MAP[2]) / (_MAP[4] - 1)!r} AS y FROM range({_MAP[4]}) a(gx), range({_MAP[4]}) b(gy)),
d AS (SELECT h.species, h.month, h.n, g.gx, g.gy, g.x, g.y, sum(l.w * exp(-(power((l.lon - g.x) / h.hx, 2) + power((l.lat - g.y) / h.hy, 2)) / 2)) / (h.n * 2 * pi() * h.hx * h.hy) AS density
      FROM h JOIN (SELECT species, month, lon, lat, count(*) AS w FROM o GROUP BY ALL) l ON h.species = l.species AND h.month = l.month, g
      GROUP BY h.species, h.month, h.n, g.gx, g.gy, g.x, g.y, h.hx, h.hy)
SELECT *, sum(density) OVER (PARTITION BY species, month ORDER BY round(density, 9) DESC) / sum(density) OVER (PARTITION BY species, month) AS mass FROM d"""))
def sighting_density_month(spark, sf):
    """Density map of sightings per species and month with bandwidths of its own, and the level set of every node."""
    o = S.observations(spark, sf).select("camera_id", "species", "month")
    pts = o.join(S.cameras(spark, sf).select("camera_id", "lon", "lat"), "camera_id", "inner")
    return D.density_map(pts, "lon", "lat", ["species", "month"], *_MAP)


@register("count_smooth")
def count_smooth(spark, sf):
    """s(lon, lat) of observation counts (Poisson) on the 0.1 degree grid; cameras without observations count as 0."""
    from camstat.operators.reshape import grid
    obs = S.observations(spark, sf).groupBy("camera_id").agg(F.count("*").alias("n"))
    t = S.cameras(spark, sf).select("camera_id", "lon", "lat").join(obs, "camera_id", "left").select("lon", "lat", F.coalesce("n", F.lit(0)).alias("n"))
    model = SM.fit_smooth(t, ["lon", "lat"], "n", "poisson", tensor=True, cells=8, ranges=[(-90.0, -83.0), (50.0, 55.5)])
    g = grid(spark, -90.0, -83.0, 50.0, 55.5, 0.1).select("gx", "gy", F.col("x").alias("lon"), F.col("y").alias("lat"))
    return model.predict(g, "expected").select("gx", "gy", "expected", F.lit(model.edf).alias("edf"))


@register("tp_smooth")
def tp_smooth(spark, sf):
    """Share of true positives as s(width) + s(height) (binomial), for every box size that occurs."""
    b = S.boxes(spark, sf).groupBy("w", "h", F.col("species").isNotNull().cast("double").alias("is_tp")).agg(F.count("*").alias("n"))
    model = SM.fit_smooth(b, ["w", "h"], "is_tp", "binomial", cells=6, weight="n")
    sizes = b.groupBy("w", "h").agg((F.sum(F.col("n") * F.col("is_tp")) / F.sum("n")).alias("observed"))
    return model.predict(sizes, "expected").select("w", "h", "observed", "expected")


@register("site_ward")
def site_ward(spark, sf):
    """Ward groups of the cameras' Hellinger profiles (range-scaled), two groups; cameras per group."""
    site = LQ._site_table(spark, sf)
    return WD.ward(site, "camera_id", S.OBS_SPECIES, 2).groupBy("cluster").agg(F.count("*").alias("n_sites"))


@register("site_ward_geo")
def site_ward_geo(spark, sf):
    """Spatially constrained Ward groups (four) of the plots' mean profiles: explained inertia of profiles and places for
    alpha 0 and 0.1."""
    site = LQ._site_table(spark, sf).withColumn("plot_id", F.floor(F.col("camera_id") / 4)).groupBy("plot_id").agg(
        *[F.avg(c).alias(c) for c in [*S.OBS_SPECIES, "lon", "lat"]])
    found = WD.ward_geo(site, "plot_id", S.OBS_SPECIES, "lon", "lat", [0.0, 0.1], 4)
    return spark.createDataFrame([(a, float(p or 0.0), float(g or 0.0)) for a, _, p, g in found], "alpha double, profile_share double, place_share double")


@register("tree_pruned")
def tree_pruned(spark, sf):
    """Classification tree of the status, pruned by weakest links on ten folds, with surrogates for missing features; its
    pruning table."""
    t = LQ._status_table(spark, sf).withColumn("gi_av", F.when(F.col("vec_id") % 11 != 0, F.col("gi_av")))
    tree = RT.fit_tree(t.where(F.col("status").isNotNull()), LQ.FEATURES, "status", "fold")
    return spark.createDataFrame(tree.table, "complexity double, n_splits long, rel_error double, xerror double, xstd double")


_CORRECTED = 7
# fixed value: folders that the camera folders are dealt to; one holds corrected camera folders only, or none
_INGEST_FOLDERS = 36 * _CORRECTED


@register("ingest_replaced_files", with_views(["boxes"], f"""
SELECT CASE WHEN folder % {_CORRECTED} = 0 THEN category_id + 10 ELSE category_id END AS category_id, count(*) AS n, count(DISTINCT image_id) AS n_images
FROM boxes GROUP BY 1"""))
def ingest_replaced_files(spark, sf):
    """T1 + S18: detector files ingested, some folders' files replaced by corrected ones, ingested again; each
    detection is there once, as last written.  A folder holds the files of a group of camera folders."""
    from camstat.streaming.ingest import export_documents
    base = shared_path(spark, "ingest-replace")
    boxes = S.boxes(spark, sf)

    def put(rows, mode):
        export_documents(rows, F.concat(F.lit("f"), F.pmod("folder", F.lit(_INGEST_FOLDERS))), f"{base}/in", mode)

    def ingest():
        ingest_current(spark, f"{base}/in", f"{base}/out", f"{base}/ledger", "*.txt.snappy", multi_line=False)

    put(boxes, "append")
    for _ in range(2):
        ingest()
        put(boxes.where(F.col("folder") % _CORRECTED == 0).withColumn("category_id", F.col("category_id") + 10), "overwrite")
    ingest()
    return spark.read.parquet(f"{base}/out").groupBy("category_id").agg(F.count("*").alias("n"), F.count_distinct("image_id").alias("n_images"))

