"""Classifier bookkeeping.

Per-class metrics come from the confusion table (one row per (truth, pred)
pair, a map-side combined aggregate), so the work after the first aggregate is
proportional to the number of classes squared, not to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Long confusion table ``(truth, pred, n)``."""
    return df.groupBy(truth, pred).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Share of rows whose predicted class equals the true class."""
    return df.agg(F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count("*").alias("n"))


def class_metrics(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Per class TP, FP, FN, TN, precision, recall, F1 over *all* classes seen
    as truth or prediction (undefined ratios are null; null is a class).  Every cell of
    the confusion table is counted for its true and for its predicted class in one aggregate."""
    cm = confusion(df, truth, pred)
    n, same = F.col("n"), F.col(truth).eqNullSafe(F.col(pred))
    both = cm.select(F.explode(F.array(
        F.struct(F.col(truth).alias("class"), n.alias("t"), F.lit(0).cast("long").alias("p"), F.when(same, n).otherwise(0).alias("tp")),
        F.struct(F.col(pred).alias("class"), F.lit(0).cast("long").alias("t"), n.alias("p"), F.lit(0).cast("long").alias("tp")))).alias("c")).select("c.*")
    m = both.groupBy("class").agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum("tp").alias("tp"))
    from camstat.operators.aggregates import attach_scalar
    m = attach_scalar(m, df.agg(F.count("*").alias("_N")))
    fp = F.col("n_pred") - F.col("tp")
    fn = F.col("n_true") - F.col("tp")
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred"))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true"))
    m = m.select("class", "tp", fp.alias("fp"), fn.alias("fn"),
                 (F.col("_N") - F.col("n_pred") - F.col("n_true") + F.col("tp")).alias("tn"),
                 prec.alias("precision"), rec.alias("recall"))
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return m.withColumn("f1", f1)


def portable_hash(key: Column, seed: int) -> Column:
    """A seeded 32-bit multiplicative hash of an integer key; plain arithmetic, so
    any SQL engine reproduces it."""
    return F.pmod(key.cast("bigint") * F.lit(2654435761) + F.lit(seed), F.lit(4294967296))


def split_stratified(df: DataFrame, cls: str, key: str, frac: float = 0.25, seed: int = 42,
                     out: str = "split", hash_col: Column | None = None) -> DataFrame:
    """Per class, the ``round(frac * n)`` rows with the smallest seeded hash go
    to ``eval``, the rest to ``train``.  Null is a class.  Stable across runs.  The within-class
    rank comes from the range-partitioned sequence operator, so a class holding
    most rows is still ranked by many tasks."""
    from camstat.operators.joins import join_back
    from camstat.operators.windows import seq_id
    h = hash_col if hash_col is not None else (
        portable_hash(F.col(key), seed) if dict(df.dtypes)[key] in ("int", "bigint", "smallint")
        else F.xxhash64(F.col(key), F.lit(seed)))
    n = df.groupBy(cls).agg(F.count("*").alias("_n"))
    r = join_back(seq_id(df.withColumn("_h", h), ["_h", key], out="_rank", by=[cls]), n, [cls], "inner")
    return (r.withColumn(out, F.when(F.col("_rank") <= F.round(F.col("_n") * frac), F.lit("eval"))
                         .otherwise(F.lit("train"))).drop("_rank", "_n", "_h"))


def folds(df: DataFrame, key: str, k: int = 10, seed: int = 42, out: str = "fold",
          hash_col: Column | None = None) -> DataFrame:
    """K cross-validation folds from a seeded hash of the key."""
    h = hash_col if hash_col is not None else F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))
