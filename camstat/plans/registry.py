"""Named queries over the driver tables.

``register(name, sql)`` records a ``(spark, sf_dir) -> DataFrame`` plan and,
when the result is SQL-expressible, its DuckDB oracle text.  Every plan ends in
``tidy`` so the result types match the oracle's: integral -> BIGINT, floating
-> DOUBLE rounded to 6 places, timestamps -> text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def tidy(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ts_text(expr: str) -> str:
    """SQL twin of tidy() for a timestamp column."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.DateType):
        return "date"
    return "string"


def output_kinds(df: DataFrame) -> list[list[str]]:
    return [[f.name, _kind(f.dataType)] for f in df.schema.fields]


def wrap_sql(sql: str, kinds: list[list[str]] | None) -> str:
    """Give the oracle result the Spark plan's column order and types: integral
    -> BIGINT, floating -> DOUBLE rounded to 6 places."""
    if not kinds:
        return sql
    cols = []
    for name, kind in kinds:
        q = '"' + name.replace('"', '""') + '"'
        if kind == "bigint":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == "double":
            cols.append(f"round(CAST({q} AS DOUBLE), 6) AS {q}")
        elif kind == "string":
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
        else:
            cols.append(q)
    return "SELECT " + ", ".join(cols) + " FROM (\n" + sql.strip() + "\n) AS oracle_q"
