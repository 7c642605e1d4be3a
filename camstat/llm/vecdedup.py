"""Embedding near-duplicates by NN-descent.

A neighbour graph over the distinct vectors starts from the leaves of a few random-hyperplane
partitions and is refined by neighbours-of-neighbours joins: every vector x meets the vectors that x
lists and those that list x, all pairs among them that involve a new entry are compared, and pairs
that beat a list's worst entry enter that list.  A list holds the ``K`` nearest; where all of them
pass the threshold (the list is saturated) it is enlarged and takes every entry above the
threshold, up to ``K_MAX``.

The number of partitions grows with the table, so that a pair at the threshold without common
neighbours shares a leaf at a chance of ``RECALL``.  Rounds go on until a round finds no new link and
an audit (vectors with links, and random ones until enough links are seen, against all vectors, in
blocks) confirms the recall; a failed audit adds another random partition.  A search that is not
confirmed raises.

Lists that are still saturated at ``K_MAX`` mark dense components; their links are counted exactly.
Members whose angle to the component's pivot is at most half the threshold angle are all linked to
each other (triangle inequality), so a large group of near copies needs no pairs; only the other
members are compared with all, block by block, and blocks return counts.  Full lists may also hide the
links between two dense components: these are compared by pivots and radii, then block by block.

Equal vectors are collapsed first and counted by weight.  A vector that is listed by very many
others is met in parts.  Graph tables of past rounds are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camstat.llm.common import drop, written, written_at
from camstat.operators.components import components
from camstat.llm.vectors import cosines, matrix, one_length, sample_vectors, unit, usable

K, K_MAX = 8, 32
#: Vectors aimed at in a leaf, most in one part of a leaf or of a neighbourhood, and in one block.
LEAF, PART, BLOCK = 64, 256, 2048
#: Fewest partitions that the graph starts from, and partitions made at once; vectors in the first
#: audit, the recall it asks for, and the links it has to see (or so many sqrt(n) vectors).
PARTITIONS, AUDIT, RECALL = 4, 1024, 0.99
MIN_LINKS, AUDIT_ROOT = 200, 64
#: Matrix products may differ from the exact cosine by less than this.
EPS = 1e-9
#: Sums of angles may be off by less than this.
SLACK = 1e-6

EDGE = "u long, v long, sim double"


def _groups(batches: Iterator, keys: list[str]) -> Iterator:
    """Consecutive rows of equal keys, also across batches (input sorted by the keys)."""
    import pandas as pd

    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        k = batch[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
        for a, b in zip(starts[:-1], starts[1:]):
            yield batch.iloc[a:b]
        rest = batch.iloc[starts[-1]:]
    if rest is not None and len(rest):
        yield rest


def _tops(ids: np.ndarray, x: np.ndarray, k: int):
    """For each row its k nearest others and all within EPS of those, as (u, v, cosine) arrays."""
    s = unit(x) @ unit(x).T
    np.fill_diagonal(s, -2)
    kth = np.partition(s, -k, axis=1)[:, -k] if len(s) > k else np.full(len(s), -1.5)
    a, b = np.nonzero(s >= kth[:, None] - EPS)
    return ids[a], ids[b], cosines(x[a], x[b])


def _merged(entries: DataFrame, threshold: float) -> DataFrame:
    """Lists (u, v, sim, new, place): the K nearest, and up to K_MAX that pass the threshold."""
    once = entries.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return once.withColumn("place", place).where(
        (F.col("place") <= K) | ((F.col("place") <= K_MAX) & (F.col("sim") >= threshold)))


def _bits(n: int) -> int:
    return max(0, round(math.log2(max(n / LEAF, 1))))


def _partition(vecs: DataFrame, dim: int, kind: str, n: int, numbers: list[int], seed: int) -> DataFrame:
    """Entries from the leaves of random-hyperplane partitions."""
    bits = _bits(n)
    planes = {t: np.random.default_rng([seed, t, dim]).standard_normal((dim, bits)) for t in numbers}

    def code(batches):
        import pandas as pd

        for batch in batches:
            x = matrix(batch["vec"], dim, kind)
            for t, a in planes.items():
                leaf = ((x @ a > 0).astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=1).astype(np.int64)
                yield pd.DataFrame({"t": t, "leaf": leaf, "id": batch["id"], "vec": batch["vec"]})

    coded = vecs.select("id", "vec").mapInPandas(code, "t int, leaf long, id long, vec binary")
    sizes = coded.groupBy("t", "leaf").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    dealt = coded.join(sizes, ["t", "leaf"]).withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "t", "id"), F.col("parts")).cast("int"))

    def compare(batches):
        import pandas as pd

        for g in _groups(batches, ["t", "leaf", "part"]):
            if len(g) > 1:
                u, v, sim = _tops(g["id"].to_numpy(np.int64), matrix(g["vec"], dim, kind), K)
                yield pd.DataFrame({"u": u, "v": v, "sim": sim})

    keys = ["t", "leaf", "part"]
    return (
        dealt.select(*keys, "id", "vec").repartition(*keys).sortWithinPartitions(*keys, "id")
        .mapInPandas(compare, EDGE).withColumn("new", F.lit(True)))


def _round(graph: DataFrame, vecs: DataFrame, dim: int, kind: str, threshold: float) -> DataFrame:
    """Entries found by joining neighbours of neighbours."""
    # The similarity that a new entry of a list has to beat.
    enough = F.count("*") >= K
    worst = (
        F.when(~enough, F.lit(-2.0)).when(F.count("*") >= K_MAX, F.min("sim"))
        .otherwise(F.least(F.min("sim"), F.lit(threshold))))
    bars = graph.groupBy("u").agg(worst.alias("bar"), F.max(F.struct("sim", "v"))["sim"].alias("best"))
    point = vecs.select("id", "vec").join(bars.withColumnRenamed("u", "b"), F.col("id") == F.col("b"), "left").select(
        "id", "vec", F.coalesce("bar", F.lit(-2.0)).alias("bar"))
    ahead = graph.select(F.col("u").alias("x"), F.col("v").alias("m"), "new")
    back = graph.select(F.col("v").alias("x"), F.col("u").alias("m"), "new")
    # Neighbourhoods without a new entry have nothing left to compare.
    met = back.groupBy("x").agg(F.ceil(F.count("*") / (PART // 4)).cast("int").alias("parts"))
    live = ahead.unionByName(back).where("new").select(F.col("x").alias("lx")).distinct()
    sized = live.join(met, F.col("lx") == F.col("x"), "left").select("lx", F.coalesce("parts", F.lit(1)).alias("parts"))
    ahead = ahead.join(sized, F.col("x") == F.col("lx")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    back = back.join(sized, F.col("x") == F.col("lx")).withColumn("part", F.pmod(F.xxhash64("m"), F.col("parts")).cast("int"))
    members = ahead.select("x", "part", "m", "new").unionByName(back.select("x", "part", "m", "new")).groupBy(
        "x", "part", "m").agg(F.max("new").alias("new"))
    seated = members.join(point, F.col("m") == F.col("id")).select("x", "part", "m", "new", "bar", "vec")

    def compare(batches):
        import pandas as pd

        u, v, sim, held = [], [], [], 0
        for g in _groups(batches, ["x", "part"]):
            if len(g) < 2:
                continue
            x = matrix(g["vec"], dim, kind)
            ids, new, bar = g["m"].to_numpy(np.int64), g["new"].to_numpy(bool), g["bar"].to_numpy(float)
            ux = unit(x)
            s = ux @ ux.T
            s[~(new[:, None] | new[None, :])] = -np.inf
            np.fill_diagonal(s, -np.inf)
            a, b = np.nonzero(s > bar[:, None] - EPS)
            u.append(ids[a])
            v.append(ids[b])
            sim.append(cosines(x[a], x[b]))
            held += len(a)
            if held > 50_000:
                yield pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v), "sim": np.concatenate(sim)})
                u, v, sim, held = [], [], [], 0
        if u:
            yield pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v), "sim": np.concatenate(sim)})

    return (
        seated.repartition("x", "part").sortWithinPartitions("x", "part", "m")
        .mapInPandas(compare, EDGE).withColumn("new", F.lit(True)))


def _partitions(n: int, threshold: float) -> int:
    """Partitions after which two vectors at the threshold have shared a leaf at a chance of RECALL."""
    share = max(1e-12, 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** _bits(n)
    return PARTITIONS if share >= 1 else max(PARTITIONS, math.ceil(math.log(1 - RECALL) / math.log1p(-share)))


def _seen(graph: DataFrame, vecs: DataFrame, sample: tuple[list[int], list[bytes]], dim: int, kind: str, threshold: float) -> tuple[int, int]:
    """(links of the sample in its lists, all its links); lists full at K_MAX are left to the exact count."""
    ids, raw = sample
    if not ids:
        return 0, 0
    own, at = unit(matrix(raw, dim, kind)), np.array(ids, np.int64)

    def count(batches):
        import pandas as pd

        total = np.zeros(len(at), np.int64)
        for batch in batches:
            x, other = matrix(batch["vec"], dim, kind), batch["id"].to_numpy(np.int64)
            for i in range(0, len(x), BLOCK):
                u = unit(x[i:i + BLOCK]).T
                for j in range(0, len(at), BLOCK):
                    linked = (own[j:j + BLOCK] @ u >= threshold) & (at[j:j + BLOCK, None] != other[None, i:i + BLOCK])
                    total[j:j + BLOCK] += linked.sum(axis=1)
        yield pd.DataFrame({"id": at, "links": total})[total > 0]

    true = vecs.select("id", "vec").mapInPandas(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    known = graph.where(F.col("sim") >= threshold).groupBy("u").agg(F.count("*").alias("found"))
    both = true.join(known, F.col("id") == F.col("u"), "left").select("links", F.coalesce("found", F.lit(0)).alias("found"))
    found, links = both.where(F.col("found") < K_MAX).agg(F.sum(F.least("found", "links")), F.sum("links")).first()
    return found or 0, links or 0


def _confirmed(graph: DataFrame, vecs: DataFrame, n: int, dim: int, kind: str, threshold: float) -> bool:
    """Whether the recall holds among vectors with known links and among random ones.  The random
    sample grows until it has seen MIN_LINKS links, up to the whole table or AUDIT_ROOT * sqrt(n)."""
    linked = graph.where(F.col("sim") >= threshold).groupBy(F.col("u").alias("lu")).agg(F.count("*").alias("held")).where(F.col("held") < K_MAX)
    found, links = _seen(graph, vecs, sample_vectors(vecs.join(linked, F.col("id") == F.col("lu")), AUDIT), dim, kind, threshold)
    if found < RECALL * links:
        return False
    size, most = AUDIT, min(n, max(AUDIT, int(AUDIT_ROOT * math.sqrt(n))))
    while True:
        size = min(size, most)
        found, links = _seen(graph, vecs, sample_vectors(vecs, size), dim, kind, threshold)
        if found < RECALL * links:
            return False
        if links >= MIN_LINKS or size >= most:
            return True
        size *= 8


def _dense_counts(members: DataFrame, dim: int, kind: str, threshold: float) -> DataFrame:
    """(id, linked): weight of the others linked to each member of members(comp, id, vec, w), exact."""
    half = math.sqrt((1 + threshold) / 2) + EPS  # cosine of half the threshold angle
    pivot = members.groupBy(F.col("comp").alias("pc")).agg(F.min(F.struct("id", "vec"))["vec"].alias("pivot"))

    def angle(batches):
        import pandas as pd

        for b in batches:
            if len(b):
                c = cosines(matrix(b["vec"], dim, kind), matrix(b["pivot"], dim, kind))
                yield pd.DataFrame({"comp": b["comp"], "id": b["id"], "vec": b["vec"], "w": b["w"], "core": c >= half})

    placed = written(
        members.join(pivot, F.col("comp") == F.col("pc")).select("comp", "id", "vec", "w", "pivot")
        .mapInPandas(angle, "comp long, id long, vec binary, w long, core boolean"), "dense")
    core = placed.where("core").groupBy(F.col("comp").alias("cc")).agg(F.sum("w").alias("all"))
    among = placed.where("core").join(core, F.col("comp") == F.col("cc")).select("id", (F.col("all") - F.col("w")).alias("linked"))
    sizes = placed.groupBy(F.col("comp").alias("sc")).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("dparts"),
        F.ceil(F.sum((~F.col("core")).cast("int")) / BLOCK).cast("int").alias("qparts")).where("qparts > 0")
    sized = placed.join(sizes, F.col("comp") == F.col("sc"))
    fields = ["comp", "dpart", "qpart", "id", "vec", "w", "core"]
    spread = sized.withColumn("dpart", F.pmod(F.xxhash64("id"), F.col("dparts")).cast("int")).withColumn(
        "qpart", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1))).select(*fields)
    asked = sized.where(~F.col("core")).withColumn("qpart", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("qparts")).cast("int")).withColumn(
        "dpart", F.explode(F.sequence(F.lit(0), F.col("dparts") - 1))).select(*fields).toDF(*fields)

    def meet(rows, outer):
        import pandas as pd

        if not len(rows) or not len(outer):
            return pd.DataFrame({"id": np.empty(0, np.int64), "linked": np.empty(0, np.int64)})
        x, q = matrix(rows["vec"], dim, kind), matrix(outer["vec"], dim, kind)
        ids, own = rows["id"].to_numpy(np.int64), outer["id"].to_numpy(np.int64)
        s = unit(q) @ unit(x).T
        linked = s >= threshold
        a, b = np.nonzero(np.abs(s - threshold) < EPS)
        linked[a, b] = cosines(q[a], x[b]) >= threshold
        linked &= own[:, None] != ids[None, :]
        mine = linked @ rows["w"].to_numpy(np.int64)
        core = rows["core"].to_numpy(bool)
        theirs = outer["w"].to_numpy(np.int64) @ linked[:, core]  # the others are asked on their own
        return pd.DataFrame({"id": np.concatenate([own, ids[core]]), "linked": np.concatenate([mine, theirs])})

    keys = ["comp", "dpart", "qpart"]
    rest = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, "id long, linked long")
    return among.unionByName(rest).groupBy("id").agg(F.sum("linked").cast("long").alias("linked"))


def _dense_across(members: DataFrame, dim: int, kind: str, threshold: float) -> DataFrame:
    """(id, linked, comp, other): weight of the vectors of component ``other`` linked to a member of
    another component ``comp`` of members(comp, id, vec, w), exact.

    Each component is its pivot with the radius of the core around it (half the threshold angle at
    most), and its other members one by one.  Components meet only where two of these come close
    enough for a link, and then block by block."""
    half, reach = math.sqrt((1 + threshold) / 2), math.acos(max(-1.0, min(1.0, threshold))) + SLACK
    pivot = members.groupBy(F.col("comp").alias("pc")).agg(F.min(F.struct("id", "vec")).alias("pivot"))

    def angle(batches):
        import pandas as pd

        for b in batches:
            if len(b):
                c = cosines(matrix(b["vec"], dim, kind), matrix(b["pivot"], dim, kind))
                yield pd.DataFrame({"comp": b["comp"], "id": b["id"], "vec": b["vec"], "pivot": b["pivot"],
                                    "core": c >= half, "angle": np.arccos(c)})

    placed = written(
        members.join(pivot, F.col("comp") == F.col("pc")).select("comp", "id", "vec", F.col("pivot.vec").alias("pivot"))
        .mapInPandas(angle, "comp long, id long, vec binary, pivot binary, core boolean, angle double"), "dense-balls")
    balls = written(
        placed.where("core").groupBy("comp").agg(F.min("id").alias("id"), F.first("pivot").alias("vec"), F.max("angle").alias("radius"))
        .unionByName(placed.where(~F.col("core")).select("comp", "id", "vec", F.lit(0.0).alias("radius"))), "balls")
    parts = max(1, -(-balls.count() // BLOCK))
    dealt = balls.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(parts)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    left = dealt.withColumnRenamed("part", "p").withColumn("q", F.explode(every))
    right = dealt.withColumnRenamed("part", "q").withColumn("p", F.explode(every))
    right = right.toDF(*right.columns)  # fresh column ids for the second side

    def near(a, b):
        import pandas as pd

        pairs = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        if len(a) and len(b):
            angles = np.arccos(np.clip(unit(matrix(a["vec"], dim, kind)) @ unit(matrix(b["vec"], dim, kind)).T, -1, 1))
            ca, cb = a["comp"].to_numpy(np.int64), b["comp"].to_numpy(np.int64)
            close = angles <= reach + a["radius"].to_numpy(float)[:, None] + b["radius"].to_numpy(float)[None, :]
            i, j = np.nonzero(close & (ca[:, None] < cb[None, :]))
            if len(i):
                found = np.unique(np.stack([ca[i], cb[j]], 1), axis=0)
                pairs = pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})
        return pairs

    pairs = written(left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(near, "a long, b long").distinct(), "dense-pairs")
    sizes = members.groupBy(F.col("comp").alias("sc")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    sized = (
        pairs.join(sizes.toDF("sa", "aparts"), F.col("a") == F.col("sa")).join(sizes.toDF("sb", "bparts"), F.col("b") == F.col("sb"))
        .select("a", "b", "aparts", "bparts"))

    def side(own: str, other: str) -> DataFrame:
        return (
            members.join(sized, F.col("comp") == F.col(own))
            .withColumn(f"{own}p", F.pmod(F.xxhash64(F.lit(9), "id"), F.col(f"{own}parts")).cast("int"))
            .withColumn(f"{other}p", F.explode(F.sequence(F.lit(0), F.col(f"{other}parts") - 1)))
            .select("a", "b", "ap", "bp", "id", "vec", "w"))

    def meet(rows, others):
        import pandas as pd

        out = {"id": np.empty(0, np.int64), "linked": np.empty(0, np.int64), "comp": np.empty(0, np.int64), "other": np.empty(0, np.int64)}
        if len(rows) and len(others):
            x, y = matrix(rows["vec"], dim, kind), matrix(others["vec"], dim, kind)
            s = unit(x) @ unit(y).T
            linked = s >= threshold
            i, j = np.nonzero(np.abs(s - threshold) < EPS)
            linked[i, j] = cosines(x[i], y[j]) >= threshold
            a, b = int(rows["a"].iat[0]), int(rows["b"].iat[0])
            mine, theirs = linked @ others["w"].to_numpy(np.int64), rows["w"].to_numpy(np.int64) @ linked
            ia, ib = np.flatnonzero(mine), np.flatnonzero(theirs)
            out = {"id": np.concatenate([rows["id"].to_numpy(np.int64)[ia], others["id"].to_numpy(np.int64)[ib]]),
                   "linked": np.concatenate([mine[ia], theirs[ib]]),
                   "comp": np.repeat([a, b], [len(ia), len(ib)]), "other": np.repeat([b, a], [len(ia), len(ib)])}
        return pd.DataFrame(out)

    keys = ["a", "b", "ap", "bp"]
    fields = [*keys, "id", "vec", "w"]  # fresh column ids for the second side
    return side("a", "b").groupBy(*keys).cogroup(side("b", "a").toDF(*fields).groupBy(*keys)).applyInPandas(
        meet, "id long, linked long, comp long, other long")


def near_duplicates(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                    seed: int = 5, max_rounds: int = 30) -> DataFrame:
    """(key, n_links, component_id, kept) for every id: links to other vectors at a cosine of
    ``threshold`` or more, the smallest id reachable by links, and whether it is the id itself.

    Vectors that are null, empty, zero, of an odd length or hold null or non-finite components link
    with nothing.  Rows that repeat an id count once; rows without an id are left out.  Other columns
    are ignored; an empty table gives no rows.  A search that no audit has confirmed after
    ``max_rounds`` rounds raises RuntimeError."""
    packed, kind = usable(df, key, vector)
    rows, dim, _ = one_length(written(packed, "vectors"))
    rows = rows.select("id", "vec")
    vecs = written(rows.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("w")), "distinct-vectors")
    n = vecs.count()
    graph, path = written_at(_merged(_partition(vecs, dim, kind, n, list(range(PARTITIONS)), seed), threshold), "graph")
    wanted = _partitions(n, threshold)
    for first in range(PARTITIONS, wanted, PARTITIONS):
        more = _partition(vecs, dim, kind, n, list(range(first, min(first + PARTITIONS, wanted))), seed)
        after, new_path = written_at(_merged(more.unionByName(graph.drop("place")), threshold), "graph")
        drop(after.sparkSession, path)
        graph, path = after, new_path
    links = graph.where(F.col("sim") >= threshold).count()
    confirmed = n <= 1
    for number in range(0 if confirmed else max_rounds):
        entries = graph.withColumn("new", F.lit(False)).drop("place").unionByName(_round(graph, vecs, dim, kind, threshold))
        after, new_path = written_at(_merged(entries, threshold), "graph")
        drop(after.sparkSession, path)
        graph, path, before = after, new_path, links
        links = graph.where(F.col("sim") >= threshold).count()
        if links > before:
            continue
        confirmed = _confirmed(graph, vecs, n, dim, kind, threshold)
        if confirmed:
            break
        fresh = _partition(vecs, dim, kind, n, [wanted + number], seed).unionByName(graph.drop("place"))
        after, new_path = written_at(_merged(fresh, threshold), "graph")
        drop(after.sparkSession, path)
        graph, path = after, new_path
        links = graph.where(F.col("sim") >= threshold).count()
    if not confirmed:
        raise RuntimeError(f"no audit has confirmed a recall of {RECALL} after {max_rounds} rounds")
    passed = graph.where(F.col("sim") >= threshold)
    edges = written(
        passed.select("u", "v").unionByName(passed.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    comps = written(components(edges.where("u < v"), "u", "v"), "vector-components")
    full = passed.groupBy("u").agg(F.count("*").alias("held")).where(F.col("held") >= K_MAX)
    dense = comps.join(full, F.col("node") == F.col("u")).select(F.col("component").alias("dc")).distinct()
    members = (
        comps.join(dense, F.col("component") == F.col("dc")).join(vecs, F.col("node") == F.col("id"))
        .select(F.col("component").alias("comp"), "id", "vec", "w"))
    members = written(members, "dense-members")
    across = written(_dense_across(members, dim, kind, threshold), "dense-links")
    # Members of a component are connected, so one link joins two of them.
    joined = written(components(across.where("comp < other").select("comp", "other").distinct(), "comp", "other"), "joined")
    comps = comps.join(joined.toDF("was", "now"), F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("now", "component").alias("component"))
    counted = _dense_counts(members, dim, kind, threshold).unionByName(across.select("id", "linked")).groupBy("id").agg(
        F.sum("linked").alias("linked"))
    weighed = (
        edges.join(vecs.select(F.col("id").alias("other"), F.col("w").alias("ow")), F.col("v") == F.col("other"))
        .groupBy(F.col("u").alias("e")).agg(F.sum("ow").alias("listed")))
    of_vector = (
        vecs.join(comps, F.col("id") == F.col("node"), "left")
        .join(weighed, F.col("id") == F.col("e"), "left")
        .join(counted.withColumnRenamed("id", "cid"), F.col("id") == F.col("cid"), "left")
        .select(F.col("vec").alias("v"), F.coalesce("component", "id").alias("component_id"),
                (F.col("w") - 1 + F.coalesce("linked", "listed", F.lit(0))).cast("long").alias("n_links")))
    of_row = rows.join(of_vector, F.col("vec") == F.col("v")).select(F.col("id").alias("rid"), "n_links", "component_id")
    everyone = df.select(F.col(key).cast("long").alias("key")).where(F.col("key").isNotNull()).distinct()
    return (
        everyone.join(of_row, F.col("key") == F.col("rid"), "left")
        .select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                F.coalesce("component_id", "key").alias("component_id"))
        .withColumn("kept", F.col(key) == F.col("component_id")))
