"""Data-quality checks (Q1-Q8).

``expect_*`` return the failing rows (or a one-row count table) as a
DataFrame; ``assert_*`` run them and raise with a sample.  Every check is a
join or aggregate; only a bounded sample ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    pass


def _raise_if_any(failing: DataFrame, name: str, sample: int = 5) -> None:
    rows = failing.limit(sample).collect()
    if rows:
        raise QualityError(f"{name}: {len(rows)}+ failing rows, e.g. {rows}")


def expect_join_conserves(left: DataFrame, joined: DataFrame, not_null: str | None = None) -> DataFrame:
    """Q1: a left join keeps the row count; optionally no null ``not_null``."""
    a = left.agg(F.count("*").alias("n_left"))
    b = joined.agg(F.count("*").alias("n_joined"),
                   F.count_if(F.col(not_null).isNull() if not_null else F.lit(False)).alias("n_null"))
    from camstat.operators.aggregates import attach_scalar
    return attach_scalar(a, b).withColumn("ok", (F.col("n_left") == F.col("n_joined")) & (F.col("n_null") == 0))


def expect_covered(points: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Q2: points not covered by any source."""
    return points.select(key).distinct().join(covered.select(key), key, "left_anti")


def expect_same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q3: keys present in only one of two matrices (order is imposed by sorting
    on the key at the output edge, so equal key sets suffice)."""
    ka = a.select(key).distinct().withColumn("_a", F.lit(True))
    kb = b.select(key).distinct().withColumn("_b", F.lit(True))
    return ka.join(kb, key, "full_outer").filter(F.col("_a").isNull() | F.col("_b").isNull())


def expect_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q4: keys occurring more than once (e.g. two deployments for one camera)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def expect_total(df: DataFrame, col: str, expected: int | None = None, parts: DataFrame | None = None,
                 part_n: str = "n") -> DataFrame:
    """Q5: distinct count equals a known constant and/or the parts sum to it."""
    t = df.agg(F.count_distinct(col).alias("total"))
    if parts is not None:
        from camstat.operators.aggregates import attach_scalar
        t = attach_scalar(t, parts.agg(F.sum(part_n).alias("parts_sum")))
    ok = F.lit(True)
    if expected is not None:
        ok = ok & (F.col("total") == expected)
    if parts is not None:
        ok = ok & (F.col("total") == F.col("parts_sum"))
    return t.withColumn("ok", ok)


def expect_no_manual_fp(anns: DataFrame, species: str = "species", manual: str = "manual") -> DataFrame:
    """Q6: manual boxes must carry a species."""
    return anns.filter(F.col(species).isNull() & F.col(manual))


def expect_two_files(files: DataFrame, project: str = "project", file_col: str = "file") -> DataFrame:
    """Q7: duplicated projects with other than exactly two export files."""
    c = files.groupBy(project).agg(F.count_distinct(file_col).alias("n_files"))
    return c.filter((F.col("n_files") > 1) & (F.col("n_files") != 2))


def expect_rows_match_folders(deployments: DataFrame, folders: DataFrame, key: str) -> DataFrame:
    """Q8: deployment rows without a folder and folders without a deployment."""
    return expect_same_keys(deployments, folders, key)


def assert_empty(failing: DataFrame, name: str) -> None:
    _raise_if_any(failing, name)


def assert_ok(one_row: DataFrame, name: str) -> None:
    _raise_if_any(one_row.filter(~F.col("ok")), name)
