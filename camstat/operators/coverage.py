"""Exact coverage fractions of raster cells under buffers (J12, A20): the area of circle and cell in common.

Coordinates are planar (project them first).  Points and cells meet by an equi join on blocks as wide as a
buffer's reach, and the area follows from a closed form: no cell is sampled, no buffer becomes a polygon.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _half(t: Column, r: float) -> Column:
    """Area under the upper half circle from its left end to ``t`` (within -r and r)."""
    s = F.sqrt(F.greatest(F.lit(0.0), r * r - t * t))
    return (t * s + r * r * F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), t / r)))) / 2 + F.lit(r * r) * F.pi() / 4


def _clip(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, x))


def disc_below(x: Column, y: Column, r: float) -> Column:
    """Area of the part of a disc around the origin left of ``x`` and below ``y``."""
    x, y = _clip(x, F.lit(-r), F.lit(r)), _clip(y, F.lit(-r), F.lit(r))
    c = F.sqrt(r * r - y * y)  # the chord at height y runs from -c to c
    at = _clip(x, -c, c)
    span = _half(at, r) - _half(-c, r)
    # Below the centre: the segment under the chord; above it: all but the segment over the chord.
    return F.when(y < 0, span + y * (at + c)).otherwise(2 * _half(x, r) - (span - y * (at + c)))


def disc_in_box(dx0: Column, dy0: Column, dx1: Column, dy1: Column, r: float) -> Column:
    """Area that a disc of radius ``r`` shares with a box given by its corners relative to the centre."""
    area = disc_below(dx1, dy1, r) - disc_below(dx0, dy1, r) - disc_below(dx1, dy0, r) + disc_below(dx0, dy0, r)
    return F.greatest(F.lit(0.0), area)


def cover_fractions(points: DataFrame, cells: DataFrame, r: float, size: float, px: str = "px", py: str = "py",
                    cx: str = "cx", cy: str = "cy", by: list[str] | None = None) -> DataFrame:
    """``(px, py, *by, n_cells, fraction)`` per distinct position of ``points``: the covered fractions of the
    square cells (side ``size``, centres ``cx, cy``) under its circle, summed over the cells of each ``by`` value.

    Cells of one place and value are counted first, so copies of a cell cost one row.  Positions or centres with
    a null coordinate take no part; a cell that the circle only touches counts as uncovered and is left out."""
    by = by or []
    reach = r + size / 2
    # The other side may have columns of the same names.
    p = points.select(F.col(px).alias("_px"), F.col(py).alias("_py")).where("_px IS NOT NULL AND _py IS NOT NULL").distinct()
    c = cells.where(F.col(cx).isNotNull() & F.col(cy).isNotNull()).groupBy(
        F.col(cx).alias("_cx"), F.col(cy).alias("_cy"), *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)]).agg(F.count("*").alias("_n"))
    for own, a in (("_bx", "_px"), ("_by", "_py")):
        block = F.floor(F.col(a) / reach)
        p = p.withColumn(own, F.explode(F.array(block - 1, block, block + 1)))
    c = c.withColumn("_bx", F.floor(F.col("_cx") / reach)).withColumn("_by", F.floor(F.col("_cy") / reach))
    met = p.join(c, ["_bx", "_by"])
    dx, dy, half = F.col("_cx") - F.col("_px"), F.col("_cy") - F.col("_py"), size / 2
    met = met.where((F.abs(dx) < reach) & (F.abs(dy) < reach))
    met = met.withColumn("_f", disc_in_box(dx - half, dy - half, dx + half, dy + half, r) / (size * size)).where("_f > 1e-12")
    return met.groupBy("_px", "_py", *[f"_by{i}" for i in range(len(by))]).agg(
        F.sum("_n").alias("n_cells"), F.sum(F.col("_n") * F.col("_f")).alias("fraction")).select(
        F.col("_px").alias(px), F.col("_py").alias(py), *[F.col(f"_by{i}").alias(b) for i, b in enumerate(by)], "n_cells", "fraction")
