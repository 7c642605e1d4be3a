"""Small-matrix statistics: correlation pruning and one-way ANOVA.

The heavy part (sums, co-moments) is one Spark aggregation; only the p x p
correlation matrix (p = number of columns) reaches the driver.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camstat.operators.joins import join_back


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form ``(a, b, r)``,
    computed in one aggregation pass."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, r)")


def prune_correlated(df: DataFrame, cols: list[str], cutoff: float = 0.9) -> list[str]:
    """Columns to drop so no kept pair has ``|r| > cutoff``.  Greedy: visit
    columns by decreasing mean absolute correlation; for each pair above the
    cutoff among kept columns, drop the one with the larger mean absolute
    correlation."""
    rows = correlations(df, cols).collect()  # p*(p-1)/2 rows
    r = {(x["a"], x["b"]): abs(x["r"] or 0.0) for x in rows}
    r.update({(b, a): v for (a, b), v in list(r.items())})
    mean = {c: sum(r[(c, d)] for d in cols if d != c) / max(1, len(cols) - 1) for c in cols}
    order = sorted(cols, key=lambda c: (-mean[c], cols.index(c)))
    drop: set[str] = set()
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if a in drop or b in drop:
                continue
            if r[(a, b)] > cutoff:
                drop.add(a if mean[a] > mean[b] else b)
    return [c for c in cols if c in drop]


def anova(df: DataFrame, y: str, group: str, by: list[str] | None = None) -> DataFrame:
    """One-way ANOVA of ``y`` across ``group`` (per ``by``): between / within
    sums of squares, degrees of freedom and F, from per-group n, mean and
    variance (two aggregation passes, no row-level join).  F is null where a degree of
    freedom or the variance within groups is 0."""
    by = by or []
    g = df.groupBy(*by, group).agg(F.count(y).alias("n"), F.avg(y).alias("m"), F.var_samp(y).alias("v"))
    tot = g.groupBy(*by).agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("_grand"))
    j = join_back(g, tot, by, "inner") if by else _attach(g, tot)
    s = j.groupBy(*by).agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("_grand"), 2)).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("v"), F.lit(0.0))).alias("ssw"),
        F.count("*").alias("_groups"), F.sum("n").alias("n_total"))
    return s.select(*by, "ssb", "ssw", (F.col("_groups") - 1).alias("df_between"),
                    (F.col("n_total") - F.col("_groups")).alias("df_within"),
                    F.try_divide(F.try_divide(F.col("ssb"), F.col("_groups") - 1),
                                 F.try_divide(F.col("ssw"), F.col("n_total") - F.col("_groups"))).alias("f"))


def _attach(g: DataFrame, one_row: DataFrame) -> DataFrame:
    from camstat.operators.aggregates import attach_scalar
    return attach_scalar(g, one_row)
