"""Point in polygon by a cover of cells.

Polygons are covered by square cells once.  A cell that no edge crosses is wholly inside or outside, so its points are decided
without looking at an edge; a border cell holds only the edges that cross it and whether its corner is inside, so a point in
it is decided by the parity of crossings on the way to the corner.  Border cells with many edges are divided again, so
a point meets a bounded number of edges however many vertices the polygon has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camstat.operators.joins import join_back
from camstat.session import written

#: Levels of division below the first; each halves the cells twice.
LEVELS, DIVIDE = 6, 4


def _crossing(edges: DataFrame, size: float) -> DataFrame:
    """Edges with every cell (``i, j``) of side ``size`` that they touch: per row of cells the columns between the places where
    the edge enters and leaves the row, one cell wider on either side where rounding could matter."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("j", F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))))
    bottom, top = F.greatest(lo, F.col("j") * size), F.least(hi, (F.col("j") + 1) * size)
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    a = F.when(slope.isNull(), F.col("x1")).otherwise(F.col("x1") + (bottom - F.col("y1")) * slope)
    b = F.when(slope.isNull(), F.col("x2")).otherwise(F.col("x1") + (top - F.col("y1")) * slope)
    left = F.greatest(F.least(a, b), F.least("x1", "x2"))
    right = F.least(F.greatest(a, b), F.greatest("x1", "x2"))
    pad = size * 1e-9
    return rows.withColumn("i", F.explode(F.sequence(F.floor((left - pad) / size), F.floor((right + pad) / size))))


def _corners(edges: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """``cells`` (zone, i, j) with ``inside``: whether their lower left corner is inside, by the crossings right of it on the grid
    line of its row.  Crossings and corners of a line are counted in one sweep from the right."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    first = F.ceil(lo / size)
    last = F.ceil(hi / size) - 1  # lines with lo <= line < hi
    lines = edges.where(first <= last).withColumn("j", F.explode(F.sequence(first, last)))
    at = F.col("x1") + (F.col("j") * size - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = lines.select("zone", "j", at.alias("x"), F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("i"))
    own = cells.select("zone", "j", (F.col("i") * size).alias("x"), F.lit(0).alias("n"), "i")
    # Right of the corner means beyond it, so a corner comes before a crossing at its own place.
    sweep = Window.partitionBy("zone", "j").orderBy(F.desc("x"), "n").rowsBetween(Window.unboundedPreceding, 0)
    both = crossings.unionByName(own).withColumn("_k", F.sum("n").over(sweep))
    return both.where("i IS NOT NULL").select("zone", "i", "j", (F.col("_k") % 2 == 1).alias("inside"))


def cover(edges: DataFrame, size: float = 0.5, most_edges: int = 64, zone: str = "zone") -> DataFrame:
    """The cell table of polygon edges (zone, x1, y1, x2, y2): ``(zone, level, i, j, edge, inside)``.

    A border cell has one row per edge that crosses it (``edge``), all with ``inside`` of its corner; an inner cell has one row without an edge.  Border cells with more than ``most_edges`` edges are divided into
    cells of a quarter of the side, down to ``LEVELS`` times; then they keep all their edges.  Edges of length 0 are left out."""
    edges = edges.select(F.col(zone).alias("zone"), *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).where("x1 <> x2 OR y1 <> y2")
    edges = written(edges, "cover-edges")
    out, parents = [], None
    for level in range(LEVELS + 1):
        side = size / DIVIDE**level
        met = _crossing(edges if level == 0 else parents.select("zone", "x1", "y1", "x2", "y2").distinct(), side)
        if level:
            # Only cells inside the divided ones.
            up = parents.select("zone", F.col("i").alias("_pi"), F.col("j").alias("_pj")).distinct()
            met = met.withColumns({"_pi": F.floor(F.col("i") / DIVIDE), "_pj": F.floor(F.col("j") / DIVIDE)}).join(up, ["zone", "_pi", "_pj"], "left_semi").drop("_pi", "_pj")
        met = written(met, "cover-border")
        border = met.groupBy("zone", "i", "j").agg(F.count("*").alias("_n"))
        if level == 0:
            # All cells of each row between the polygon's first and last border cell.
            span = border.groupBy("zone", "j").agg(F.min("i").alias("a"), F.max("i").alias("b"))
            cells = span.select("zone", "j", F.explode(F.sequence("a", "b")).alias("i"))
        else:
            n = F.array(*[F.lit(k) for k in range(DIVIDE)])
            cells = up.withColumn("_x", F.explode(n)).withColumn("_y", F.explode(n)).select(
                "zone", (F.col("_pi") * DIVIDE + F.col("_x")).alias("i"), (F.col("_pj") * DIVIDE + F.col("_y")).alias("j"))
        known = written(join_back(_corners(edges, cells, side), border, ["zone", "i", "j"], "left"), "cover-cells")
        inner = known.where("_n IS NULL AND inside")
        out.append(inner.select("zone", F.lit(level).alias("level"), "i", "j", F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>").alias("edge"), "inside"))
        limit = most_edges if level < LEVELS else 2**62
        kept = met.join(known.where(F.col("_n") <= limit).select("zone", "i", "j", "inside"), ["zone", "i", "j"])
        out.append(kept.select("zone", F.lit(level).alias("level"), "i", "j", F.struct("x1", "y1", "x2", "y2").alias("edge"), "inside"))
        if level == LEVELS:
            break
        parents = written(met.join(known.where(F.col("_n") > limit).select("zone", "i", "j"), ["zone", "i", "j"], "left_semi"), "cover-divided")
        if parents.isEmpty():
            break
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def locate(points: DataFrame, cells: DataFrame, size: float = 0.5, px: str = "lon", py: str = "lat") -> DataFrame:
    """``points`` with the ``zone`` that contains them (one row per zone, null when none).  A point meets one cell per level
    and zone; boundaries count as in ``spatial.zone_of`` (an edge counts where ``min(y1, y2) <= y < max(y1, y2)``)."""
    p = points.select(F.col(px).alias("_px"), F.col(py).alias("_py")).where("_px IS NOT NULL AND _py IS NOT NULL").distinct()
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(size / DIVIDE**k).alias("side")) for k in range(LEVELS + 1)])
    p = p.withColumn("_l", F.explode(levels)).select("_px", "_py", F.col("_l.level").alias("level"), F.col("_l.side").alias("side"),
                                                     F.floor(F.col("_px") / F.col("_l.side")).alias("i"), F.floor(F.col("_py") / F.col("_l.side")).alias("j"))
    met = p.join(cells, ["level", "i", "j"])
    cx, cy = F.col("i") * F.col("side"), F.col("j") * F.col("side")
    x1, y1, x2, y2 = (F.col(f"edge.{c}") for c in ("x1", "y1", "x2", "y2"))
    # Along the point's height to the cell's left side, then down to its corner.
    at_height = (F.least(y1, y2) <= F.col("_py")) & (F.col("_py") < F.greatest(y1, y2))
    across = x1 + (F.col("_py") - y1) * F.try_divide(x2 - x1, y2 - y1)
    level_leg = at_height & (across > cx) & (across <= F.col("_px"))
    at_side = (F.least(x1, x2) <= cx) & (cx < F.greatest(x1, x2))
    up = y1 + (cx - x1) * F.try_divide(y2 - y1, x2 - x1)
    side_leg = at_side & (up > cy) & (up <= F.col("_py"))
    crossed = F.coalesce(level_leg, F.lit(False)).cast("int") + F.coalesce(side_leg, F.lit(False)).cast("int")
    found = met.groupBy("_px", "_py", "zone", "inside").agg(F.sum(F.when(F.col("edge").isNotNull(), crossed).otherwise(0)).alias("_k"))
    found = found.where((F.col("_k") + F.col("inside").cast("int")) % 2 == 1).select(F.col("_px").alias(px), F.col("_py").alias(py), "zone")
    return join_back(points, found, [px, py], "left")
