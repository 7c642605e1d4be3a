"""Kernel densities with a bandwidth of their own per group (A18 violins, X7 maps).

Bandwidths follow the normal reference rule from the spread and the exact quartiles of each group.  Values are
shared out to the two (four) nearest nodes of a grid first (linear binning), so the kernel only meets grid nodes: work after
the first aggregate depends on the grid and the groups, not on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camstat.operators.aggregates import quantiles
from camstat.operators.joins import join_back


def _spread(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """(by, n, lo, hi, spread): the smaller of the standard deviation and the quartile range over 1.34 (the other one if that is
    0, then 1), as the normal reference rules use it."""
    rows = df.where(F.col(col).isNotNull())
    base = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"), F.stddev_samp(col).alias("_sd"))
    q = quantiles(rows, col, [0.25, 0.75], by)
    iqr = (F.col("q1") - F.col("q0")) / 1.34
    sd = F.coalesce("_sd", F.lit(0.0))
    spread = F.when((sd > 0) & (iqr > 0), F.least(sd, iqr)).when(sd > 0, sd).otherwise(F.lit(1.0))
    return join_back(base, q, by, "inner").select(*by, "n", "lo", "hi", spread.alias("spread"))


def violin(df: DataFrame, col: str, by: list[str], nodes: int = 64, cut: float = 0.0) -> DataFrame:
    """``(*by, n, bandwidth, node, value, density, width)``: the outline of a violin per group.  Gaussian kernel, bandwidth
    0.9 * spread * n^(-1/5); ``nodes`` grid points from ``cut`` bandwidths below the least value to as many above the
    largest; ``width``: density over the group's largest.  Groups of one distinct value have that value at every node;
    null is a group, null values are left out."""
    stats = _spread(df, col, by).withColumn("bandwidth", 0.9 * F.col("spread") * F.pow(F.col("n").cast("double"), -0.2))
    stats = stats.withColumns({"_from": F.col("lo") - cut * F.col("bandwidth"), "_step": (F.col("hi") - F.col("lo") + 2 * cut * F.col("bandwidth")) / (nodes - 1)})
    counted = df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    placed = join_back(counted, stats.select(*by, "_from", "_step"), by, "inner")
    at = F.when(F.col("_step") > 0, (F.col("_v") - F.col("_from")) / F.col("_step")).otherwise(0.0)
    left = F.least(F.floor(at), F.lit(nodes - 2))
    share = at - left
    placed = placed.withColumn("_s", F.explode(F.array(
        F.struct(left.alias("node"), ((1 - share) * F.col("_c")).alias("w")), F.struct((left + 1).alias("node"), (share * F.col("_c")).alias("w")))))
    binned = placed.groupBy(*by, F.col("_s.node").alias("_m")).agg(F.sum("_s.w").alias("_w")).where("_w > 0")
    spread = join_back(binned, stats.select(*by, "bandwidth", "_step"), by, "inner").withColumn(
        "node", F.explode(F.array(*[F.lit(i) for i in range(nodes)])))
    z = (F.col("node") - F.col("_m")) * F.col("_step") / F.col("bandwidth")
    dens = spread.groupBy(*by, "node").agg(F.sum(F.col("_w") * F.exp(-z * z / 2)).alias("_k"))
    out = join_back(dens, stats, by, "inner").withColumn(
        "density", F.col("_k") / (F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi)))
    top = out.groupBy(*by).agg(F.max("density").alias("_top"))
    return join_back(out, top, by, "inner").select(
        *by, "n", "bandwidth", "node", (F.col("_from") + F.col("node") * F.col("_step")).alias("value"), "density", (F.col("density") / F.col("_top")).alias("width"))


def density_map(points: DataFrame, x: str, y: str, by: list[str], x0: float, x1: float, y0: float, y1: float, nodes: int = 25,
                least: int = 2) -> DataFrame:
    """``(*by, n, gx, gy, x, y, density, mass)``: a Gaussian density map per group (species, month) on ``nodes`` x ``nodes`` grid
    points over the given extent, with a bandwidth per axis and group of 1.06 * spread * n^(-1/5).  ``mass``: share of the map's
    whole density that lies at nodes at least as dense; the nodes up to a mass of p are the level set that holds p.

    The kernel is a product, so places are summed over the grid's columns first and only those sums meet its rows.
    Groups with fewer than ``least`` points are left out; points without a place too."""
    rows = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    sx, sy = _spread(rows, x, by), _spread(rows, y, by)
    stats = join_back(sx.select(*by, "n", F.col("spread").alias("_sx")), sy.select(*by, F.col("spread").alias("_sy")), by, "inner").where(F.col("n") >= least)
    scale = F.pow(F.col("n").cast("double"), -0.2) * 1.06
    stats = stats.withColumns({"_hx": F.col("_sx") * scale, "_hy": F.col("_sy") * scale})
    places = rows.groupBy(*by, F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py")).agg(F.count("*").alias("_w"))
    places = join_back(places, stats.select(*by, "_hx"), by, "inner")
    dx, dy = (x1 - x0) / (nodes - 1), (y1 - y0) / (nodes - 1)

    def kernel(at: Column, node: Column, h: Column) -> Column:
        z = (at - node) / h
        return F.exp(-z * z / 2) / (h * math.sqrt(2 * math.pi))

    grid = F.array(*[F.lit(i) for i in range(nodes)])
    columns = places.withColumn("gx", F.explode(grid)).groupBy(*by, "_py", "gx").agg(
        F.sum(F.col("_w") * kernel(F.col("_px"), x0 + F.col("gx") * dx, F.col("_hx"))).alias("_k"))
    columns = join_back(columns, stats.select(*by, "_hy"), by, "inner")
    dens = columns.withColumn("gy", F.explode(grid)).groupBy(*by, "gx", "gy").agg(
        F.sum(F.col("_k") * kernel(F.col("_py"), y0 + F.col("gy") * dy, F.col("_hy"))).alias("_k"))
    dens = join_back(dens, stats.select(*by, "n"), by, "inner").withColumn("density", F.col("_k") / F.col("n"))
    # A group is one map: nodes^2 rows.  Equal densities (but for rounding) share their mass.
    order = Window.partitionBy(*by).orderBy(F.desc(F.round("density", 9))).rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    return dens.select(*by, "n", "gx", "gy", (x0 + F.col("gx") * dx).alias("x"), (y0 + F.col("gy") * dy).alias("y"), "density",
                       F.try_divide(F.sum("density").over(order), F.sum("density").over(whole)).alias("mass"))
