"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every table hashes a unit vector by ``depth`` Gaussian projections, cut into cells of width
``WIDTH`` at a random offset: h_j = floor((a_j . x + b_j) / WIDTH).  A query visits not only its own
bucket but perturbed ones in order of estimated success: for a neighbour at cosine c, projection j
is normal around c * (a_j . q) with variance 1 - c^2, which gives the probability of each cell, and
a bucket's is the product.  A query visits the most likely buckets until they hold the neighbour
with probability ``SUCCESS``; there is no fixed number of probes.  The candidates of all tables are
merged and reranked by exact cosine.

The reference cosine c is fitted on a bounded sample (``SAMPLE`` vectors): the cosine that nine of
ten sample queries reach with their k-th neighbour in the sample.  Neighbours in the whole table are
nearer, so the estimate errs towards more probes.  All rows are indexed.

Buckets meet queries block by block.  A bucket with more than ``BLOCK`` rows is divided by a hash
of the id, its queries likewise, and each pair of blocks meets in a group of its own; a group
returns only the best k of every query, so no task holds a bucket whole and no pairs are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camstat.llm.common import written
from camstat.llm.vectors import cosines, matrix, one_length, sample_vectors, unit, usable

TABLES, WIDTH = 2, 1.5
#: Probability, by one table's estimate, that the visited buckets hold a neighbour.
SUCCESS = 0.92
#: Vectors aimed at in one bucket, and most rows or queries in one block.
BUCKET, BLOCK = 2048, 4096
SAMPLE, SAMPLE_QUERIES = 4096, 256


def _cell_range(c: float) -> np.ndarray:
    """Cells that projections of unit vectors reach, beyond any practical doubt."""
    top = math.ceil(6.0 / WIDTH) + 1
    return np.arange(-top, top + 1)


def projections(dim: int, depth: int, table: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, table, dim, depth])
    return rng.standard_normal((dim, depth)), rng.uniform(0, WIDTH, depth)


def bucket_of(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cells (rows, depth) of unit vectors."""
    cells = _cell_range(0)
    return np.clip(np.floor((x @ a + b) / WIDTH), cells[0], cells[-1]).astype(np.int64)


def bucket_code(cells: np.ndarray) -> np.ndarray:
    """One long for a row of cells."""
    width = len(_cell_range(0))
    code = np.zeros(len(cells), np.int64)
    for j in range(cells.shape[1]):
        code = code * width + (cells[:, j] + width // 2)
    return code


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(x / math.sqrt(2)))


def probes(q: np.ndarray, a: np.ndarray, b: np.ndarray, c: float, success: float) -> Iterator[np.ndarray]:
    """For each unit query, the cells of the buckets to visit, most likely first.

    Buckets are built projection by projection; after each, the least likely partial buckets whose
    mass sums to at most an equal part of the allowed miss are dropped."""
    cells = _cell_range(c)
    spread = math.sqrt(max(1 - c * c, 1e-12))
    depth = a.shape[1]
    miss = (1 - success) / depth
    edges = np.append(cells, cells[-1] + 1) * WIDTH
    centre = c * (q @ a) + b
    cdf = _normal_cdf((edges[None, None, :] - centre[:, :, None]) / spread)
    cdf[:, :, 0], cdf[:, :, -1] = 0.0, 1.0
    mass = np.diff(cdf, axis=2)
    for row in mass:
        p, at = np.ones(1), np.zeros((1, 0), np.int64)
        for j in range(depth):
            p = (p[:, None] * row[j][None, :]).ravel()
            at = np.hstack([np.repeat(at, len(cells), axis=0), np.tile(cells, len(at))[:, None]])
            order = np.argsort(-p, kind="stable")
            p, at = p[order], at[order]
            keep = np.searchsorted(-np.cumsum(p[::-1])[::-1], -miss * p.sum(), side="right")
            p, at = p[:max(keep, 1)], at[:max(keep, 1)]
        yield at


def _fit(rows: DataFrame, dim: int, kind: str, n: int, k: int) -> tuple[float, int]:
    """(reference cosine, number of projections)."""
    _, vecs = sample_vectors(rows, SAMPLE)
    c = 0.5
    if len(vecs) > k + 1:
        x = unit(matrix(vecs, dim, kind))
        s = x[:SAMPLE_QUERIES] @ x.T
        s[np.arange(len(s)), np.arange(len(s))] = -2
        kth = -np.sort(-s, axis=1)[:, k - 1]
        c = float(np.clip(np.quantile(kth, 0.1), 0.05, 0.98))
    # A projection spreads unit vectors over about 2.5 cells of this width.
    depth = max(1, min(12, round(math.log(max(n / BUCKET, 1.0)) / math.log(2.5))))
    return c, depth


def nearest(df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", seed: int = 11,
            tables: int = TABLES, success: float = SUCCESS) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every query, nearest first, ties to the
    smaller id; fewer if there are fewer other rows.  ``is_query``: condition on column ``id``.

    Left out, as queries and as candidates: null ids, vectors that are null, empty, zero, of an odd
    length or hold null or non-finite components.  Rows that repeat an id count once.  A query for
    which the visited buckets hold fewer than k others is searched against all rows, in blocks."""
    packed, kind = usable(df, key, vector)
    rows, dim, n = one_length(written(packed, "vectors"))
    rows = rows.select("id", "vec")
    c, depth = _fit(rows, dim, kind, n, k)
    params = [projections(dim, depth, t, seed) for t in range(tables)]
    place = "t int, bucket long, id long, vec binary"

    def index(batches):
        import pandas as pd

        for batch in batches:
            x = unit(matrix(batch["vec"], dim, kind)) if len(batch) else np.empty((0, dim))
            for t, (a, b) in enumerate(params):
                yield pd.DataFrame({"t": t, "bucket": bucket_code(bucket_of(x, a, b)), "id": batch["id"], "vec": batch["vec"]})

    def visit(batches):
        import pandas as pd

        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i:i + 256]
                x = unit(matrix(part["vec"], dim, kind))
                for t, (a, b) in enumerate(params):
                    found = [bucket_code(cells) for cells in probes(x, a, b, c, success)]
                    sizes = [len(f) for f in found]
                    yield pd.DataFrame({
                        "t": t, "bucket": np.concatenate(found), "id": np.repeat(part["id"].to_numpy(), sizes),
                        "vec": np.repeat(part["vec"].to_numpy(object), sizes)})

    data = rows.mapInPandas(index, place)
    queries = rows.where(is_query)
    asked = queries.mapInPandas(visit, place)
    # Only buckets that hold rows matter; big ones, and big sets of queries, are divided.
    held = data.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("dparts"))
    wanted = asked.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qparts"))
    parts = written(held.join(wanted, ["t", "bucket"]), "bucket-parts")

    def dealt(side: DataFrame, own: str, other: str, salt: int) -> DataFrame:
        own_part = F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(own)).cast("int")
        both = side.join(parts, ["t", "bucket"])
        return both.withColumn(f"{own[0]}part", own_part).withColumn(
            f"{other[0]}part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("t", "bucket", "dpart", "qpart", "id", "vec")

    found = "query_id long, id long, score double"

    def meet(left, right):
        return _best(left, right, dim, kind, k)

    groups = ["t", "bucket", "dpart", "qpart"]
    near = (
        dealt(data, "dparts", "qparts", 1).groupBy(*groups)
        .cogroup(dealt(asked, "qparts", "dparts", 2).groupBy(*groups)).applyInPandas(meet, found))
    near = written(near.distinct(), "near")
    # Queries that met fewer than k others: exact, against all rows in blocks.
    short = queries.join(near.groupBy("query_id").agg(F.count("*").alias("met")), F.col("id") == F.col("query_id"), "left").where(
        F.coalesce("met", F.lit(0)) < F.lit(min(k, max(n - 1, 0)))).select("id", "vec")
    short = written(short, "short-queries")
    n_short = short.count()
    if n_short:
        dblocks, qblocks = -(-n // BLOCK), -(-n_short // BLOCK)
        spread = rows.withColumn("dpart", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(dblocks)).cast("int")).withColumn(
            "qpart", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
        ask = short.withColumn("qpart", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(qblocks)).cast("int")).withColumn(
            "dpart", F.explode(F.sequence(F.lit(0), F.lit(dblocks - 1))))
        exact = spread.groupBy("dpart", "qpart").cogroup(ask.groupBy("dpart", "qpart")).applyInPandas(meet, found)
        near = near.unionByName(exact).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _best(rows, asked, dim: int, kind: str, k: int):
    """The best k of one block of rows for each query of one block, by exact cosine, ties to the
    smaller id.  Near ties of the matrix product are all recomputed before the cut."""
    import pandas as pd

    if not len(rows) or not len(asked):
        return pd.DataFrame({"query_id": np.empty(0, np.int64), "id": np.empty(0, np.int64), "score": np.empty(0)})
    x, q = matrix(rows["vec"], dim, kind), matrix(asked["vec"], dim, kind)
    ids, own = rows["id"].to_numpy(np.int64), asked["id"].to_numpy(np.int64)
    ux = unit(x)
    out_q, out_i, out_s = [], [], []
    for i in range(0, len(q), 256):
        some = slice(i, i + 256)
        s = unit(q[some]) @ ux.T
        s[own[some][:, None] == ids[None, :]] = -np.inf
        kth = np.partition(s, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(s), -2.0)
        a, b = np.nonzero((s >= np.maximum(kth, -2.0)[:, None] - 1e-9))
        score = np.concatenate([cosines(q[some][a[j:j + 65536]], x[b[j:j + 65536]]) for j in range(0, len(a), 65536)]) if len(a) else np.empty(0)
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        nth = np.arange(len(a)) - np.searchsorted(a, a)
        keep = nth < k
        out_q.append(own[some][a[keep]])
        out_i.append(ids[b[keep]])
        out_s.append(score[keep])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "id": np.concatenate(out_i), "score": np.concatenate(out_s)})
