"""Ward's minimum-variance linkage in rounds of reciprocal nearest neighbours.

A cluster is its size and mean (its moments), so the dissimilarity of two clusters, the growth of the within-group
inertia when they merge, needs no distance matrix: n_a n_b / (n_a + n_b) * |mean_a - mean_b|^2.  In each round every
cluster finds its nearest one, block of clusters by block of clusters, and all pairs that are nearest to each other merge
at once.  Ward's criterion is reducible (a merge never brings two others nearer), so this gives the same
tree as merging one pair at a time.  Equal rows are one cluster from the start.

Squared Euclidean distances are what Ward's criterion is defined on: profiles are scaled by range as in
Gower's coefficient, and the spatially constrained form adds coordinates on the unit sphere, each block of columns
divided by its largest pairwise distance and weighted by alpha.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camstat.operators.components import components
from camstat.session import drop_path, written, written_at

#: Clusters in a block; two blocks meet in a task.
BLOCK = 2048


def _nearest(clusters: DataFrame) -> DataFrame:
    """(id, nn, cost): each cluster's nearest one; ties go to the pair with the smaller ids, which makes the order of
    pairs total, so the cheapest pair of all is always mutual.  Blocks meet in pairs, and only each row's best leaves a pair."""
    blocks = max(1, -(-clusters.count() // BLOCK))
    own = clusters.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    met = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "id", "n", "x", "_b", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"))

    def best(key, rows):
        import pandas as pd

        rows = rows.sort_values("id", ignore_index=True)
        i, j = int(key[0]), int(key[1])
        a, b = rows[rows["_b"] == i], rows[rows["_b"] == j]
        xa, xb = (np.array(r["x"].tolist(), float).reshape(len(r), -1) for r in (a, b))
        na, nb = a["n"].to_numpy(float), b["n"].to_numpy(float)
        ia, ib = a["id"].to_numpy(np.int64), b["id"].to_numpy(np.int64)
        out = []
        if len(a) and len(b):
            cost = np.zeros((len(a), len(b)))
            for k in range(xa.shape[1]):
                cost += (xa[:, k, None] - xb[None, :, k]) ** 2
            cost *= na[:, None] * nb[None] / (na[:, None] + nb[None])
            if i == j:
                np.fill_diagonal(cost, np.inf)
            # Of equal costs the pair with the smaller ids: columns ascend by id, so the first is right unless the row's id lies between.
            for c, mine, others in ((cost, ia, ib), (cost.T, ib, ia)) if i != j else ((cost, ia, ib),):
                least = c.min(axis=1)
                for r in np.flatnonzero(np.isfinite(least)):
                    tied = others[c[r] == least[r]]
                    out.append((int(mine[r]), int(min(tied, key=lambda o: (min(mine[r], o), max(mine[r], o)))), float(least[r])))
        return pd.DataFrame(out, columns=["id", "nn", "cost"])

    found = met.groupBy("i", "j").applyInPandas(best, "id long, nn long, cost double")
    pick = F.struct("cost", F.least("id", "nn").alias("a"), F.greatest("id", "nn").alias("b"), "nn")
    return found.groupBy("id").agg(F.min(pick).alias("m")).select("id", F.col("m.nn").alias("nn"), F.col("m.cost").alias("cost"))


def ward_tree(rows: DataFrame, key: str, cols: list[str], weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members: key, id; merges: a, b, height, n, round).  Rows of one profile share the ``id`` of a leaf; a merge joins the
    clusters named by their smallest leaves ``a < b`` at ``height``, the square root of twice the inertia it adds.
    Rows with a null in a column take no part; heights tell in which order the merges come."""
    own = rows.where(~F.greatest(*[F.col(c).isNull() | F.isnan(F.col(c)) for c in [*cols, cols[0]]]))
    x = F.array(*[F.col(c).cast("double") for c in cols])
    own = own.select(F.col(key).alias("key"), x.alias("x"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    leaves = written(_numbered(own), "ward-leaves")
    members = own.select("key", "x").join(leaves.select("id", F.col("x").alias("_x")), F.col("x") == F.col("_x")).select("key", "id")
    clusters, path, merges, k = leaves, None, None, 0
    left = leaves.count()
    while left > 1:
        near, near_path = written_at(_nearest(clusters), "ward-near")
        back = near.select(F.col("id").alias("_id"), F.col("nn").alias("_nn"))
        mutual = near.join(back, (F.col("nn") == F.col("_id")) & (F.col("id") == F.col("_nn"))).where("id < nn")
        done = written(mutual.select(F.col("id").alias("a"), F.col("nn").alias("b"), F.sqrt(2 * F.col("cost")).alias("height")), "ward-merges")
        to = done.select(F.col("b").alias("_of"), F.col("a").alias("_to"))
        size = len(cols)
        moved = clusters.join(to, F.col("id") == F.col("_of"), "left").withColumn("id", F.coalesce("_to", "id"))
        total = F.sum("n")
        merged = moved.groupBy("id").agg(total.alias("n"), F.array(*[F.sum(F.col("n") * F.col("x")[d]) / total for d in range(size)]).alias("x"))
        clusters, new = written_at(merged, "ward-clusters")
        own_merges = done.join(clusters.select("id", "n"), F.col("a") == F.col("id")).select("a", "b", "height", "n", F.lit(k).alias("round"))
        merges = own_merges if merges is None else merges.unionByName(own_merges)
        merges = written(merges, "ward-tree")
        drop_path(rows.sparkSession, near_path)
        if path:
            drop_path(rows.sparkSession, path)
        path, k, before, left = new, k + 1, left, clusters.count()
        if left >= before:
            raise RuntimeError("no pair of clusters is mutual: the profiles hold values that do not compare")
    if merges is None:
        merges = rows.sparkSession.createDataFrame([], "a long, b long, height double, n double, round int")
    return members, merges


def _numbered(own: DataFrame) -> DataFrame:
    from camstat.operators.windows import seq_id

    distinct = own.groupBy("x").agg(F.sum("w").alias("n"), F.min("key").alias("_first"))
    return seq_id(distinct, ["_first", "x"], out="id").select("id", "n", "x")


def cut_tree(members: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """(key, cluster): the tree cut into ``k`` groups (fewer, if there are fewer profiles), numbered from 1 by their smallest
    leaf.  Of merges at one height those of later rounds are undone first."""
    n = merges.count() + 1
    keep = merges.orderBy("height", "round", "a").limit(max(0, n - k)).select("a", "b")
    linked = components(keep).select(F.col("node").alias("_id"), F.col("component").alias("_root"))
    named = members.join(linked, F.col("id") == F.col("_id"), "left")
    named = written(named.select("key", F.coalesce("_root", "id").alias("_root")), "ward-cut")
    # At most k roots: a table of fixed size.
    order = named.select("_root").distinct().withColumn("cluster", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_root")))
    return named.join(F.broadcast(order), "_root").select("key", "cluster")


def range_scaled(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns divided by their range and the root of their number (as in Gower's mean over variables); constant ones become 0."""
    got = df.agg(*[f(c).cast("double") for c in cols for f in (F.min, F.max)]).first()
    out = {}
    for k, c in enumerate(cols):
        span = (got[2 * k + 1] or 0.0) - (got[2 * k] or 0.0)
        out[c] = F.when(F.col(c).isNotNull(), F.col(c) / float(span * np.sqrt(len(cols))) if span else F.lit(0.0))
    return df.withColumns(out)


def widest(df: DataFrame, cols: list[str]) -> float:
    """The largest pairwise distance of the rows.  The rows farthest along a fan of directions bound it from below; a row that
    lies nearer to the centre than that bound less the farthest row's distance belongs to no wider pair, so only the outer
    rows meet, block by block."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(x.alias("x")).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v))).distinct()
    rows = written(rows, "ward-extent")
    dim = len(cols)
    fan = np.random.default_rng(0).normal(size=(32, dim))
    fan = np.vstack([np.eye(dim), fan / np.linalg.norm(fan, axis=1)[:, None]])
    along = [sum((F.col("x")[d] * float(v[d]) for d in range(1, dim)), F.col("x")[0] * float(v[0])) for v in fan]
    ends = rows.agg(*[f("x", a) for a in along for f in (F.min_by, F.max_by)], *[F.avg(F.col("x")[d]) for d in range(dim)]).first()
    if ends[0] is None:
        return 0.0
    extreme = np.array([ends[i] for i in range(2 * len(fan))])
    centre = np.array([ends[2 * len(fan) + d] for d in range(dim)])
    bound = max(np.sqrt(((extreme[:, None] - extreme[None]) ** 2).sum(axis=2)).max(), 0.0)
    far = F.sqrt(sum(((F.col("x")[d] - float(centre[d])) ** 2 for d in range(1, dim)), (F.col("x")[0] - float(centre[0])) ** 2))
    reach = rows.agg(F.max(far)).first()[0]
    outer = rows.where(far >= bound - reach - 1e-12)
    blocks = max(1, -(-outer.count() // BLOCK))
    met = outer.withColumn("_b", F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def most(rows_):
        import pandas as pd

        v = np.array(rows_["x"].tolist(), float).reshape(len(rows_), -1)
        b = (rows_["_b"] == rows_["i"]).to_numpy()
        c = (rows_["_b"] == rows_["j"]).to_numpy()
        best = 0.0
        for p in v[b]:
            if c.any():
                best = max(best, float(((v[c] - p) ** 2).sum(axis=1).max()))
        return pd.DataFrame({"d": [best]})

    met = met.select("x", "_b", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"))
    return float(np.sqrt(met.groupBy("i", "j").applyInPandas(most, "d double").agg(F.max("d")).first()[0] or 0.0))


def inertia(df: DataFrame, key: str, cols: list[str], groups: DataFrame) -> DataFrame:
    """(explained: share of the total inertia of ``cols`` that lies between the groups), one row."""
    own = df.select(F.col(key).alias("key"), *cols).dropna()
    joined = own.join(groups, "key")
    per = joined.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
                                        *[F.sum(F.col(c) * F.col(c)).alias(f"q{i}") for i, c in enumerate(cols)])
    k = range(len(cols))
    total = sum((F.sum(f"q{i}") - F.pow(F.sum(f"s{i}"), 2) / F.sum("n") for i in k), F.lit(0.0))
    within = sum((F.sum(F.col(f"q{i}") - F.col(f"s{i}") * F.col(f"s{i}") / F.col("n")) for i in k), F.lit(0.0))
    return per.agg((1 - F.try_divide(within, total)).alias("explained"))


def ward(df: DataFrame, key: str, cols: list[str], k: int = 2) -> DataFrame:
    """``(key, cluster)`` by Ward's linkage on the range-scaled columns."""
    members, merges = ward_tree(range_scaled(df.fillna(0.0, subset=cols), cols), key, cols)
    return cut_tree(members, merges, k).withColumnRenamed("key", key)


def _constrained(df: DataFrame, cols: list[str], lon: str, lat: str) -> tuple[DataFrame, list[str], list[str]]:
    """Both blocks of columns, each divided by its largest pairwise distance."""
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    geo = {"_g0": F.cos(la) * F.cos(lo), "_g1": F.cos(la) * F.sin(lo), "_g2": F.sin(la)}
    out = range_scaled(df.fillna(0.0, subset=cols), cols).withColumns(geo)
    for block in (cols, list(geo)):
        span = widest(out, block) or 1.0
        out = out.withColumns({c: F.col(c) / span for c in block})
    return out, cols, list(geo)


def ward_geo(df: DataFrame, key: str, cols: list[str], lon: str, lat: str, alphas: list[float], k: int = 4) -> list[tuple[float, DataFrame, float, float]]:
    """For each alpha (alpha, groups, explained share of the profiles' inertia, of the places' inertia): Ward's linkage on
    (1 - alpha) * profile distance^2 + alpha * place distance^2, both scaled to a largest distance of 1.  Rows without
    coordinates take no part."""
    both, a, g = _constrained(df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()), cols, lon, lat)
    both = written(both.select(key, *a, *g), "ward-geo")
    out = []
    for alpha in alphas:
        mixed = both.select(key, *[(F.col(c) * float(np.sqrt(1 - alpha))).alias(c) for c in a], *[(F.col(c) * float(np.sqrt(alpha))).alias(c) for c in g])
        members, merges = ward_tree(mixed, key, a + g)
        groups = written(cut_tree(members, merges, k), "ward-groups")
        out.append((alpha, groups.withColumnRenamed("key", key), inertia(both, key, a, groups).first()[0], inertia(both, key, g, groups).first()[0]))
    return out
