"""Reshape, nesting, set operations and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.functions.ids import drop_last_token, is_manual
from camstat.operators.filters import drop_comments, resolve_species
from camstat.operators.joins import join_back

#: Rows aimed at in one nested array.
NEST_ROWS = 10_000
#: Rows of tags aimed at in a partition that makes them wide.
WIDEN_ROWS = 1_000_000
# fixed values: tag variables defined by the labelling interface, in order
TAG_VARIABLES = ["species", "other_species", "sex", "age", "behavior",
                 "unique_markings", "comment", "notes"]


def widen_tags(long: DataFrame, variables: list[str] = TAG_VARIABLES,
               variable: str = "variable", tag: str = "tag",
               drop: tuple[str, ...] = ("type",), rows: int | None = None) -> DataFrame:
    """Annotation long -> wide (one row per box).  Adds ``manual`` and
    ``image_id``; pivots the fixed variable list (static schema); keeps region
    rows only; resolves "Other" species.  Several tags of one variable (multiple choice)
    are all kept, sorted and joined by ``", "``.

    ``rows``: about how many rows ``long`` has, where that is known; they are then dealt to
    partitions of ``WIDEN_ROWS`` as they come and combined there, in memory: a box has few rows to
    combine before they move, and sorting all rows of a task for that spills."""
    df = long.drop(*[c for c in drop if c in long.columns])
    keys = [c for c in df.columns if c not in (variable, tag)]
    if rows is not None:
        df = df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // WIDEN_ROWS)), *keys)
    wide = (df.groupBy(*keys).pivot(variable, variables)
            .agg(F.collect_set(tag)))
    wide = wide.withColumns({v: F.when(F.size(v) > 0, F.array_join(F.array_sort(F.col(v)), ", ")) for v in variables})
    wide = wide.withColumns({"manual": is_manual("id"), "image_id": drop_last_token("id")})
    wide = drop_comments(wide)
    return resolve_species(wide)


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "variable",
            value: str = "value") -> DataFrame:
    """R2: wide -> long."""
    return df.unpivot(ids, values, name, value)


def nest(df: DataFrame, key: list[str], out: str = "data") -> DataFrame:
    """Rows per key as arrays of structs with a row count.  A key's rows are numbered in
    order and divided into arrays of ``NEST_ROWS``, numbered ``part``, so a key of any size
    fits, equal rows included; ``nr`` is the key's whole row count.  Null is a key.  A table
    of keys alone nests structs of the row number (``row``)."""
    from camstat.operators.windows import seq_id
    rest = [c for c in df.columns if c not in key]
    sizes = df.groupBy(*key).agg(F.count("*").alias("nr"))
    split = seq_id(df, rest or key, out="_row", by=key).withColumn("part", F.floor((F.col("_row") - 1) / NEST_ROWS).cast("int"))
    own = F.struct(*rest) if rest else F.struct(F.col("_row").alias("row"))
    arrays = split.groupBy(*key, "part").agg(F.sort_array(F.collect_list(own)).alias(out))
    return join_back(arrays, sizes, key, "inner").select(*key, "nr", "part", out)


def unnest(df: DataFrame, col: str = "data") -> DataFrame:
    """R3 inverse."""
    keep = [c for c in df.columns if c not in (col, "nr", "part")]
    return df.select(*keep, F.inline(col))


def split_write(df: DataFrame, by: list[str], path: str, fmt: str = "parquet") -> None:
    """Split a frame by value into groups = one folder per value on write."""
    df.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def rowwise_argmax(df: DataFrame, cols: list[str], out: str = "pred") -> DataFrame:
    """Name of the largest column per row; ties go to the first column."""
    best = F.greatest(*[F.struct(F.col(c).alias("v"), F.lit(-i).alias("p"), F.lit(c).alias("name"))
                        for i, c in enumerate(cols)])
    return df.withColumn(out, best["name"])


def named_list(spark: SparkSession, mapping: dict, key: str = "name", value: str = "value") -> DataFrame:
    """A named list as a two-column table."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], [key, value])


def union_fill(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns -> null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_strict(*dfs: DataFrame) -> DataFrame:
    """Union by name, same columns required."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def union_tagged(parts: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union with a source tag column."""
    return union_fill(*[d.withColumn(tag, F.lit(k)) for k, d in parts.items()])


def add_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """Append literal rows (a bounded list written in code) by name."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))


def conservation(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One-row check: union count = a + b, distinct keys, keys in both."""
    ca = a.agg(F.count("*").alias("n_a"))
    cb = b.agg(F.count("*").alias("n_b"))
    u = a.select(key).unionByName(b.select(key))
    cu = u.agg(F.count("*").alias("n_union"), F.count_distinct(key).alias("n_distinct"))
    both = a.select(key).intersect(b.select(key)).agg(F.count("*").alias("n_both"))
    from camstat.operators.aggregates import attach_scalar
    out = attach_scalar(attach_scalar(attach_scalar(ca, cb), cu), both)
    return out.withColumn("conserved", F.col("n_union") == F.col("n_a") + F.col("n_b"))


def grid(spark: SparkSession, x0: float, x1: float, y0: float, y1: float, step: float) -> DataFrame:
    """Cartesian grid of cell centres via ``sequence`` + ``explode``."""
    nx = int(round((x1 - x0) / step))
    ny = int(round((y1 - y0) / step))
    return (spark.range(1)
            .select(F.explode(F.sequence(F.lit(0), F.lit(nx - 1))).alias("gx"))
            .select("gx", F.explode(F.sequence(F.lit(0), F.lit(ny - 1))).alias("gy"))
            .select("gx", "gy",
                    (F.lit(x0) + (F.col("gx") + 0.5) * F.lit(step)).alias("x"),
                    (F.lit(y0) + (F.col("gy") + 0.5) * F.lit(step)).alias("y")))


def sort_nulls_last(df: DataFrame, cols: list[str], desc: list[bool] | None = None) -> DataFrame:
    """L1: sort, nulls last in both directions."""
    desc = desc or [False] * len(cols)
    return df.orderBy(*[F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last()
                        for c, d in zip(cols, desc)])


def label_order(df: DataFrame, label: str, by: str, out: str = "level", desc: bool = False) -> DataFrame:
    """The order of a label by another column: ``(label, by_mean, level)``, level 1 for the
    label with the smallest (largest) mean, ties by label; nulls last.  One row per label."""
    from camstat.operators.windows import seq_id
    m = df.groupBy(label).agg(F.avg(by).alias(f"{by}_mean"))
    key = F.col(f"{by}_mean").desc_nulls_last() if desc else F.col(f"{by}_mean").asc_nulls_last()
    return seq_id(m, [key, F.col(label).asc_nulls_last()], out=out)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """L3: first n rows after a total order (top-k per partition, then merge)."""
    return df.orderBy(*order).limit(n)


def drop_position(df: DataFrame, order: list[str], pos: int) -> DataFrame:
    """L4: drop the row at 1-based ``pos`` in a total order."""
    from camstat.operators.windows import seq_id
    return seq_id(df, order, out="_pos").filter(F.col("_pos") != pos).drop("_pos")


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = 42, hash_col=None) -> DataFrame:
    """Seeded, stable sample of n rows: the n smallest seeded hashes of the
    key (a bounded top-k, merged across partitions)."""
    h = hash_col if hash_col is not None else F.xxhash64(*key, F.lit(seed))
    return df.orderBy(h, *key).limit(n)
