"""Joins (J1-J9, J13, J17-J19).

Dimension sides (cameras, zones, legends, name tables) are small but their size
is data-driven, so we do not hint ``broadcast`` on them: AQE converts a join to a
broadcast hash join at runtime when the measured side is under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise keeps a shuffle join
(with skew-split enabled).  Only literal tables built in code are hinted.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_back(df: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a table with one row per key back to rows on ``keys``, null keys included
    (``<=>``); each key column appears once, from ``df``."""
    if not keys:
        raise ValueError("keys are needed; attach one-row tables with attach_scalar")
    right = per_key.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(right, cond, how).drop(*[f"__{k}" for k in keys])


def join_exif(anns: DataFrame, exif: DataFrame, keys=("source_file", "image_id")) -> DataFrame:
    """Left join on two keys.  Exact duplicate EXIF rows are dropped first
    (deterministic); keys that still repeat with different values would fan
    out, which the row-conservation check (Q1, ``expect_join_conserves``)
    reports instead of silently picking one.  Null keys match null keys."""
    return join_back(anns, exif.distinct(), list(keys))


def join_dim(df: DataFrame, dim: DataFrame, key: str | list[str], how: str = "left") -> DataFrame:
    """Left join to a dimension on shared key name(s)."""
    return df.join(dim, key, how)


def join_on(df: DataFrame, dim: DataFrame, left: str, right: str, how: str = "left",
            null_safe: bool = False) -> DataFrame:
    """Join with differently named keys (null-safe when R semantics need NA = NA)."""
    cond = df[left].eqNullSafe(dim[right]) if null_safe else df[left] == dim[right]
    return df.join(dim, cond, how).drop(dim[right])


def compare_detections(raw: DataFrame, filtered: DataFrame, keys: list[str],
                       how: str = "left") -> DataFrame:
    """Natural join of raw and filtered detections on shared keys; filtered
    columns that clash with raw ones get a ``_filtered`` suffix."""
    r, f = raw.alias("r"), filtered.alias("f")
    cond = None
    for k in keys:
        c = F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}"))
        cond = c if cond is None else cond & c
    other = [c for c in filtered.columns if c not in keys]
    out = r.join(f, cond, how)
    sel = [F.coalesce(F.col(f"r.{k}"), F.col(f"f.{k}")).alias(k) for k in keys]
    sel += [F.col(f"r.{c}").alias(c) for c in raw.columns if c not in keys]
    sel += [F.col(f"f.{c}").alias(c if c not in raw.columns else f"{c}_filtered") for c in other]
    return out.select(*sel)


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """``%in%``."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """``!%in%``."""
    return df.join(keys, on, "left_anti")


def pred_vs_real(pred: DataFrame, real: DataFrame, cls: str = "class") -> DataFrame:
    """Per-class predicted and true counts, inner-joined on class (null is a class)."""
    p = pred.groupBy(cls).agg(F.count("*").alias("n_pred"))
    r = real.groupBy(cls).agg(F.count("*").alias("n_true"))
    return join_back(p, r, [cls], "inner")


def overlay_annotations(base: DataFrame, upd: DataFrame, key: str = "image",
                        payload: str = "annotations") -> DataFrame:
    """The update replaces base annotations by key; keys present only in the
    update are added only when they carry annotations.  ``payload`` is an array or a
    count; ``from_update`` tells which side a row's payload came from.  Null is a key."""
    b = base.withColumn("_in_base", F.lit(True)).alias("b")
    u = upd.withColumn("_in_update", F.lit(True)).alias("u")
    j = b.join(u, F.col(f"b.{key}").eqNullSafe(F.col(f"u.{key}")), "full_outer")
    in_base = F.coalesce("_in_base", F.lit(False))
    has_upd = F.coalesce("_in_update", F.lit(False))
    has = F.col(f"u.{payload}")
    if isinstance(upd.schema[payload].dataType, T.ArrayType):
        has = F.size(has)
    u_nonempty = F.coalesce(has, F.lit(-1)) > 0
    keep = in_base | (has_upd & u_nonempty)
    return (j.filter(keep)
            .select(F.coalesce(F.col(f"b.{key}"), F.col(f"u.{key}")).alias(key),
                    F.when(has_upd, F.col(f"u.{payload}")).otherwise(F.col(f"b.{payload}")).alias(payload),
                    has_upd.alias("from_update")))


def first_non_null(a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Per key, take ``a``'s values unless all of ``cols`` are null there,
    then ``b``'s.  Null is a key."""
    aa, bb = a.alias("a"), b.alias("b")
    a_null = None
    for c in cols:
        t = F.col(f"a.{c}").isNull()
        a_null = t if a_null is None else a_null & t
    j = aa.join(bb, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full_outer")
    return j.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key),
                    *[F.when(a_null, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in cols])


def bind_by_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Column-bind two frames on an explicit row key.  Rows found on one side only
    stay, with nulls for the other side's columns.  Null is a key."""
    right = b.withColumnRenamed(key, "__key")
    j = a.join(right, F.col(key).eqNullSafe(F.col("__key")), "full_outer")
    return j.withColumn(key, F.coalesce(key, "__key")).drop("__key")


def in_deployment(obs: DataFrame, dep: DataFrame, key: str = "camera_id", ts: str = "date_time",
                  start: str = "date_deployed", end: str = "date_retrieved") -> DataFrame:
    """Flag each observation inside its camera's deployed-retrieved span
    (open-ended when not retrieved).  Calendar days are compared, so the whole retrieval
    day counts.  Equi join on the camera, then a range test; one deployment per camera
    (Q4) keeps this a plain left join."""
    d = dep.select(key, start, end)
    j = obs.join(d, key, "left")
    t = F.to_date(ts)
    inside = (t >= F.col(start)) & (F.col(end).isNull() | (t <= F.col(end)))
    return j.withColumn("in_deployment", F.coalesce(inside, F.lit(False)))


def compare_platforms(a: DataFrame, b: DataFrame, keys: list[str], species: str = "species",
                      image: str = "image_id") -> DataFrame:
    """Per-key number of images with each species in two tagging systems, full outer
    joined.  An image counts once per species, however many boxes it has."""
    fields = [*keys, species]
    ca = a.select(*fields, image).distinct().groupBy(*fields).agg(F.count("*").alias("n_a"))
    cb = b.select(*fields, image).distinct().groupBy(*fields).agg(F.count("*").alias("n_b"))
    right = cb.withColumnsRenamed({c: f"__{c}" for c in fields})
    cond = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in fields])
    j = ca.join(right, cond, "full_outer").select(
        *[F.coalesce(c, f"__{c}").alias(c) for c in fields], "n_a", "n_b")
    return j.fillna(0, subset=["n_a", "n_b"]).withColumn("diff", F.col("n_a") - F.col("n_b"))
