"""Vector columns as bytes: what the two embedding operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def usable(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, str]:
    """(id, dim, vec) and the numpy type of ``vec``: vectors as little-endian floats (of four bytes
    where the column has those, else eight), without those that are null, empty, zero or
    hold null or non-finite components, and without null ids.  Of rows that repeat an id, one counts
    (the smallest bytes).  Vectors of another length than the most frequent (ties: the shorter) are
    left out."""
    kind = "<f4" if df.schema[vector].dataType.simpleString() == "array<float>" else "<f8"
    size = int(kind[-1])

    @pandas_udf("binary")
    def packed(vectors):
        def one(v):
            if v is None:
                return None
            x = np.asarray(v, dtype=object if any(c is None for c in v) else np.float64)
            if x.dtype == object or not len(x) or not np.isfinite(x).all():
                return None
            norm = np.sqrt((x * x).sum())
            return x.astype(kind).tobytes() if np.isfinite(norm) and norm > 0 else None

        return vectors.map(one)

    rows = (
        df.select(F.col(key).cast("long").alias("id"), packed(F.col(vector).cast("array<double>")).alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull())
        .groupBy("id").agg(F.min("vec").alias("vec")))
    rows = rows.select("id", (F.octet_length("vec") / size).cast("int").alias("dim"), "vec")
    return rows, kind


def one_length(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """(rows of the most frequent length, that length, their number); length 1 if there are none."""
    top = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim, n = (top[0]["dim"], top[0]["count"]) if top else (1, 0)
    return rows.where(F.col("dim") == dim), dim, n


def matrix(vecs, dim: int, kind: str) -> np.ndarray:
    """Rows of bytes as one matrix of doubles."""
    vecs = list(vecs)
    return np.frombuffer(b"".join(vecs), kind).reshape(len(vecs), dim).astype(np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row i of ``a`` and row i of ``b``: the same two vectors give the same bits
    wherever they stand, and either way round."""
    return np.clip((a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1)), -1.0, 1.0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def sample_vectors(rows: DataFrame, size: int) -> tuple[list[int], list[bytes]]:
    """At most ``size`` rows with the smallest hashes of their ids: a bounded, repeatable sample."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(size).select("id", "vec").collect()
    return [r["id"] for r in got], [bytes(r["vec"]) for r in got]


