"""Spatial joins and matrices.

No geometry engine is needed: polygons are vertex tables, and every spatial
join is an *equi* join on a coarse bucket followed by an exact predicate:

* point in polygon -- edges are exploded to the latitude bands they span and
  points meet only the edges of their own band; ray-crossing parity per zone.
* within radius    -- distinct positions lie on the unit sphere in a 3-D grid; one side
  is exploded to its neighbour cells, the exact great-circle distance decides, and points
  and cells are attached to their positions (or summed per position) afterwards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from camstat.functions.geometry import EARTH_RADIUS_KM, haversine_km
from camstat.operators.joins import join_back


def polygon_edges(vertices: DataFrame, zone: str = "zone", ring: str = "ring", seq: str = "seq",
                  x: str = "x", y: str = "y") -> DataFrame:
    """Vertex rows -> edge rows (closing edge included).  Polygon tables are small
    and one ring is a bounded group."""
    w = Window.partitionBy(zone, ring).orderBy(seq)
    first = F.first(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    nx = F.lead(x).over(w)
    ny = F.lead(y).over(w)
    return vertices.select(zone, ring, F.col(x).alias("x1"), F.col(y).alias("y1"),
                           F.coalesce(nx, first["x"]).alias("x2"), F.coalesce(ny, first["y"]).alias("y2"))


def zone_of(points: DataFrame, edges: DataFrame, key: str = "camera_id", px: str = "lon",
            py: str = "lat", band: float = 0.5, zone: str = "zone") -> DataFrame:
    """Left join each point to the polygon(s) containing it (null when none).
    An edge counts when ``min(y1,y2) <= py < max(y1,y2)`` and its crossing lies
    right of the point; odd crossings per (position, zone) = inside.  Rings are
    counted together, so holes come out right; points may share a key or a position."""
    e = edges.withColumn("_b", F.explode(F.sequence(F.floor(F.least("y1", "y2") / band),
                                                    F.floor(F.greatest("y1", "y2") / band))))
    # distinct positions: points that share one are located once
    p = points.select(px, py).distinct().withColumn("_b", F.floor(F.col(py) / band))
    j = p.join(e, "_b", "inner")
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    cross = j.filter((F.col(py) >= lo) & (F.col(py) < hi) & (F.col(px) < F.col("x1") + (F.col(py) - F.col("y1")) * slope))
    inside = (cross.groupBy(px, py, zone).agg(F.count("*").alias("_n"))
              .filter(F.col("_n") % 2 == 1).select(px, py, zone))
    return join_back(points, inside, [px, py], "left")


def zones_with_points(zones: DataFrame, located: DataFrame, zone: str = "zone") -> DataFrame:
    """Zones holding at least one point."""
    return zones.join(located.filter(F.col(zone).isNotNull()).select(zone), zone, "left_semi")


def _on_sphere(lon: str, lat: str) -> dict:
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return {"_X": F.cos(la) * F.cos(lo), "_Y": F.cos(la) * F.sin(lo), "_Z": F.sin(la)}


def positions_within(a: DataFrame, b: DataFrame, r_km: float, ax: str, ay: str, bx: str, by: str) -> DataFrame:
    """Pairs of distinct positions of ``a`` and ``b`` within ``r_km`` great-circle distance:
    ``(ax, ay, bx, by, dist_km)``.  Positions lie on the unit sphere in a 3-D grid whose side
    is the chord of ``r_km`` (right at any latitude); ``a`` is exploded to its 27 neighbour
    cells, an equi join finds candidates and the exact distance decides."""
    chord = 2 * math.sin(r_km / (2 * EARTH_RADIUS_KM))
    pa = a.select(F.col(ax).alias("_ax"), F.col(ay).alias("_ay")).distinct().withColumns(_on_sphere("_ax", "_ay"))
    pb = b.select(F.col(bx).alias("_bx"), F.col(by).alias("_by")).distinct().withColumns(_on_sphere("_bx", "_by"))
    for x in "XYZ":
        pa = pa.withColumn(f"_c{x}", F.explode(_shifted(F.floor(F.col(f"_{x}") / chord))))
        pb = pb.withColumn(f"_c{x}", F.floor(F.col(f"_{x}") / chord))
    cells = ["_cX", "_cY", "_cZ"]
    j = pa.select("_ax", "_ay", *cells).join(pb.select("_bx", "_by", *cells), cells, "inner")
    return (j.select("_ax", "_ay", "_bx", "_by", haversine_km("_ax", "_ay", "_bx", "_by").alias("dist_km"))
            .filter(F.col("dist_km") <= r_km))


def within_radius(points: DataFrame, cells: DataFrame, r_km: float, pkey: str = "camera_id",
                  px: str = "lon", py: str = "lat", cx: str = "cx", cy: str = "cy") -> DataFrame:
    """Every (point, cell) pair within ``r_km`` great-circle distance, one row each."""
    near = positions_within(points, cells, r_km, px, py, cx, cy).drop("dist_km")
    rows = points.select(pkey, px, py).join(near, (F.col(px) == F.col("_ax")) & (F.col(py) == F.col("_ay")), "inner")
    return rows.join(cells, (F.col("_bx") == F.col(cx)) & (F.col("_by") == F.col(cy)), "inner").drop(
        "_ax", "_ay", "_bx", "_by", px, py)


def padded_bbox(points: DataFrame, by: list[str], pad: float, x: str = "lon", y: str = "lat") -> DataFrame:
    """bounding box of each group's points, widened by ``pad`` on every side."""
    return points.groupBy(*by).agg((F.min(x) - pad).alias("xmin"), (F.max(x) + pad).alias("xmax"),
                                   (F.min(y) - pad).alias("ymin"), (F.max(y) + pad).alias("ymax"))


def cover_near(points: DataFrame, cells: DataFrame, r_km: float, aggs: dict[str, Column], by: list[str] | None = None,
               pkey: str = "camera_id", px: str = "lon", py: str = "lat", cx: str = "cx", cy: str = "cy") -> DataFrame:
    """J12 + A20/A21 without listing (point, cell) pairs: cells are summed per position and
    ``by`` (class), near positions joined once per point position, their sums added, and the
    result attached to the points.  ``aggs`` are sums or counts over cells."""
    by = by or []
    per = cells.groupBy(F.col(cx).alias("_cx"), F.col(cy).alias("_cy"), *by).agg(*[v.alias(k) for k, v in aggs.items()])
    near = positions_within(points, cells, r_km, px, py, cx, cy)
    summed = (near.join(per, (F.col("_bx") == F.col("_cx")) & (F.col("_by") == F.col("_cy")), "inner")
              .groupBy("_ax", "_ay", *by).agg(*[F.sum(k).alias(k) for k in aggs]))
    return (points.select(pkey, px, py)
            .join(summed, (F.col(px) == F.col("_ax")) & (F.col(py) == F.col("_ay")), "inner")
            .select(pkey, *by, *aggs))


def cover_props(counts: DataFrame, legend: DataFrame, pkey: str = "camera_id", value: str = "value",
                code: str = "category_code", n: str = "n") -> DataFrame:
    """Per point, share of valued cells in each class (unweighted counts) from
    ``counts(pkey, value, n)``; classes missing from the legend are dropped *after* the
    shares, so rows may sum to less than 1."""
    v = counts.filter(F.col(value).isNotNull())
    t = v.groupBy(pkey).agg(F.sum(n).alias("_t"))
    props = join_back(v, t, [pkey], "inner").withColumn("props", F.col(n) / F.col("_t"))
    return (props.join(legend.select(value, code), value, "left")
            .filter(F.col(code).isNotNull()).select(pkey, code, "props"))


def cover_totals(totals: DataFrame, legend: DataFrame, value: str = "value", total: str = "total",
                 code: str = "category_code", exclude: tuple[str, ...] = ("ND",)) -> DataFrame:
    """Coverage-weighted totals per class over all buffers, from per-point totals
    ``(value, total)``; percent of the grand total (which includes cells without a class),
    rounded half-even to 2; every legend class listed, 0 when absent."""
    tot = totals.groupBy(value).agg(F.sum(total).alias("_total"))
    tot = tot.withColumn("percentage", F.bround(F.col("_total") / tot.agg(F.sum("_total")).scalar() * 100, 2))
    out = legend.join(tot.filter(F.col(value).isNotNull()), value, "left")
    return (out.withColumn("percentage", F.coalesce("percentage", F.lit(0.0)))
            .filter(~F.col(code).isin(*exclude))
            .select(code, "label", "percentage"))


def hellinger(long: DataFrame, unit: str, species: str, n: str, out: str = "hellinger") -> DataFrame:
    """``sqrt(n / row total)`` on the long site x species table."""
    t = long.groupBy(unit).agg(F.sum(n).alias("_t"))
    return (join_back(long, t, [unit], "inner")
            .withColumn(out, F.sqrt(F.col(n) / F.col("_t"))).drop("_t"))


def _shifted(c: Column, off=None) -> Column:
    """``[c - 1, c, c + 1]`` as a plain array (no lambda, stays in codegen)."""
    return F.array(c - 1, c, c + 1)


def pairs_within(points: DataFrame, r_km: float, key: str = "camera_id", lon: str = "lon",
                 lat: str = "lat") -> DataFrame:
    """Great-circle distance for every point pair (a < b) within ``r_km``.  Distinct
    positions are matched first; points are attached to their positions afterwards."""
    near = positions_within(points, points, r_km, lon, lat, lon, lat)
    a = points.select(F.col(key).alias("a"), F.col(lon).alias("_lon"), F.col(lat).alias("_lat"))
    b = points.select(F.col(key).alias("b"), F.col(lon).alias("_lon2"), F.col(lat).alias("_lat2"))
    j = (near.join(a, (F.col("_ax") == F.col("_lon")) & (F.col("_ay") == F.col("_lat")), "inner")
         .join(b, (F.col("_bx") == F.col("_lon2")) & (F.col("_by") == F.col("_lat2")), "inner"))
    return j.filter(F.col("a") < F.col("b")).select("a", "b", "dist_km")


def pairs_in_group(points: DataFrame, group: str, key: str = "camera_id", lon: str = "lon",
                   lat: str = "lat") -> DataFrame:
    """J15 inside a survey unit (the cameras of one plot, a handful each): every pair a < b of
    a group with its great-circle distance; rows grow with the cameras, not their square."""
    a = points.select(F.col(group).alias("_g"), F.col(key).alias("a"), F.col(lon).alias("lon_a"), F.col(lat).alias("lat_a"))
    b = points.select(F.col(group).alias("_h"), F.col(key).alias("b"), F.col(lon).alias("lon_b"), F.col(lat).alias("lat_b"))
    j = a.join(b, (F.col("_g") == F.col("_h")) & (F.col("a") < F.col("b")), "inner")
    return j.select(F.col("_g").alias(group), "a", "b", haversine_km("lon_a", "lat_a", "lon_b", "lat_b").alias("dist_km"))


def gower(long: DataFrame, pairs: DataFrame, unit: str, var: str, val: str) -> DataFrame:
    """Gower dissimilarity for the given site pairs (a, b): mean over variables
    with range > 0 of ``|va - vb| / range``; absent entries count as 0.  The
    variable ranges include the implicit zeros of sites lacking a variable."""
    units = long.select(unit).distinct()
    n_units = units.agg(F.count("*").alias("_nu"))
    stats = long.groupBy(var).agg(F.max(val).alias("_mx"), F.min(val).alias("_mn"),
                                  F.count("*").alias("_k"))
    from camstat.operators.aggregates import attach_scalar
    stats = attach_scalar(stats, n_units)
    # sites without the variable hold an implicit 0
    stats = stats.select(var,
                         F.when(F.col("_k") < F.col("_nu"), F.greatest("_mx", F.lit(0.0))).otherwise(F.col("_mx")).alias("_mx"),
                         F.when(F.col("_k") < F.col("_nu"), F.least("_mn", F.lit(0.0))).otherwise(F.col("_mn")).alias("_mn"))
    stats = stats.withColumn("_rng", F.col("_mx") - F.col("_mn")).filter(F.col("_rng") > 0)
    n_vars = stats.agg(F.count("*").alias("_nv"))
    la = long.select(F.col(unit).alias("a"), F.col(var), F.col(val).alias("va"))
    lb = long.select(F.col(unit).alias("b"), F.col(var), F.col(val).alias("vb"))
    pa = pairs.select("a", "b").join(la, "a", "inner").select("a", "b", var, "va")
    pb = pairs.select("a", "b").join(lb, "b", "inner").select("a", "b", var, "vb")
    both = pa.join(pb, ["a", "b", var], "full_outer").fillna(0.0, subset=["va", "vb"])
    s = (both.join(stats.select(var, "_rng"), var, "inner")
         .groupBy("a", "b").agg(F.sum(F.abs(F.col("va") - F.col("vb")) / F.col("_rng")).alias("_s")))
    out = attach_scalar(pairs.select("a", "b"), n_vars).join(s, ["a", "b"], "left")
    return out.select("a", "b", (F.coalesce("_s", F.lit(0.0)) / F.col("_nv")).alias("gower"))


def jaccard(pa: DataFrame, pairs: DataFrame, unit: str, species: str) -> DataFrame:
    """Jaccard dissimilarity of presence sets for the given pairs (a, b)."""
    s = pa.select(F.col(unit).alias("u"), species).distinct()
    sizes = s.groupBy("u").agg(F.count("*").alias("_n"))
    inter = (pairs.select("a", "b").join(s.withColumnRenamed("u", "a"), "a", "inner")
             .join(s.withColumnRenamed("u", "b"), ["b", species], "inner")
             .groupBy("a", "b").agg(F.count("*").alias("_i")))
    out = (pairs.select("a", "b").join(inter, ["a", "b"], "left")
           .join(sizes.withColumnRenamed("u", "a").withColumnRenamed("_n", "_na"), "a", "left")
           .join(sizes.withColumnRenamed("u", "b").withColumnRenamed("_n", "_nb"), "b", "left")
           .fillna(0, subset=["_i", "_na", "_nb"]))
    uni = F.col("_na") + F.col("_nb") - F.col("_i")
    return out.select("a", "b", F.when(uni > 0, 1 - F.col("_i") / uni).otherwise(F.lit(0.0)).alias("jaccard"))


def kernel_density(points: DataFrame, x0: float, x1: float, y0: float, y1: float, step: float,
                   bandwidth: float, x: str = "lon", y: str = "lat", by: list[str] | None = None,
                   weight: str | None = None) -> DataFrame:
    """Gaussian kernel density of sightings on a regular grid (cell centres),
    optionally per group.  The kernel is a product of an x and a y part, so the sum is taken
    in two steps: locations are expanded over the grid's columns and summed per (y, column),
    and only those sums are expanded over its rows.  Exact; no location meets every node."""
    by = by or []
    w = F.col(weight) if weight else F.lit(1.0)
    loc = points.groupBy(*by, F.col(x).alias("_px"), F.col(y).alias("_py")).agg(F.sum(w).alias("_w"))
    nx = int(round((x1 - x0) / step))
    ny = int(round((y1 - y0) / step))
    gxc = F.lit(x0) + (F.col("gx") + 0.5) * F.lit(step)
    gyc = F.lit(y0) + (F.col("gy") + 0.5) * F.lit(step)

    def part(at, centre):
        return F.exp(-F.pow(at - centre, 2) / F.lit(2 * bandwidth ** 2))

    columns = F.array(*[F.lit(i) for i in range(nx)])
    rows = F.array(*[F.lit(i) for i in range(ny)])
    per_column = (loc.withColumn("gx", F.explode(columns)).groupBy(*by, "_py", "gx")
                  .agg(F.sum(F.col("_w") * part(F.col("_px"), gxc)).alias("_s")))
    dens = (per_column.withColumn("gy", F.explode(rows)).groupBy(*by, "gx", "gy")
            .agg(F.sum(F.col("_s") * part(F.col("_py"), gyc)).alias("_s")))
    norm = F.lit(1.0 / (2 * math.pi * bandwidth ** 2))
    tot = loc.groupBy(*by).agg(F.sum("_w").alias("_tw"))
    if by:
        dens = join_back(dens, tot, by, "inner")
    else:
        from camstat.operators.aggregates import attach_scalar
        dens = attach_scalar(dens, tot)
    return dens.select(*by, "gx", "gy", gxc.alias("x"), gyc.alias("y"),
                       (F.col("_s") * norm / F.col("_tw")).alias("density"))


def grid_points(points: DataFrame, x0: float, x1: float, y0: float, y1: float, step: float,
                x: str = "lon", y: str = "lat") -> DataFrame:
    """The grid node (cell centre) that each point falls on, as ``gx, gy, x_node,
    y_node``; points off the grid get nulls.  Surfaces over all nodes sum the points
    first (``kernel_density``); points are never multiplied by the grid."""
    nx, ny = int(round((x1 - x0) / step)), int(round((y1 - y0) / step))
    gx, gy = F.floor((F.col(x) - x0) / step), F.floor((F.col(y) - y0) / step)
    on = gx.between(0, nx - 1) & gy.between(0, ny - 1)
    return points.withColumns({
        "gx": F.when(on, gx), "gy": F.when(on, gy),
        "x_node": F.when(on, F.lit(x0) + (gx + 0.5) * F.lit(step)),
        "y_node": F.when(on, F.lit(y0) + (gy + 0.5) * F.lit(step))})


def literal_polygons(spark: SparkSession, polys: dict[str, list[list[tuple[float, float]]]]) -> DataFrame:
    """Vertex table ``(zone, ring, seq, x, y)`` from literal rings."""
    rows = [(z, r, s, float(px), float(py)) for z, rings in polys.items()
            for r, ring in enumerate(rings) for s, (px, py) in enumerate(ring)]
    return spark.createDataFrame(rows, "zone string, ring int, seq int, x double, y double")
