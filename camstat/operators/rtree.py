"""Classification trees with cost-complexity pruning and surrogate splits.

The tree of all rows and the trees of all cross-validation folds grow together, level by level.  A level takes two
aggregates over the binned rows: class counts per (tree, node, feature, bin), from which the splits follow, and side
counts per bin of the other features, from which the surrogates for missing values follow.  Both combine before the
shuffle, and their sizes are bounded by trees x nodes x features x bins, which the driver takes.  Rows of a fold walk down the
tree grown without them, so the errors of every pruned tree come from one last count of (tree, leaf, class).
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camstat.session import drop_path, written_at

#: Most cut points per feature, and most surrogates that a split keeps.
BINS, SURROGATES = 64, 5


@dataclass
class Split:
    """Rows with ``feature <= cut`` (``>`` if reversed) go left; surrogates decide where the feature is missing, then the larger side."""

    feature: int
    cut: int
    reversed: bool = False
    surrogates: list[Split] = field(default_factory=list)
    larger: int = 0
    agreement: float = 0.0


@dataclass
class Node:
    counts: np.ndarray
    split: Split | None = None


def _edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Cut points per feature: halfway between its values, or quantiles where it has more than ``bins`` of them."""
    at = [k / bins for k in range(1, bins)]
    got = df.agg(*[F.approx_count_distinct(f, 0.01).alias(f"d{i}") for i, f in enumerate(features)],
                 *[F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    out = []
    for i, f in enumerate(features):
        if got[f"d{i}"] and got[f"d{i}"] <= 2 * bins:
            values = sorted(r[0] for r in df.where(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))).select(F.col(f).cast("double")).distinct().limit(2 * bins + 1).collect())
            if len(values) <= bins:
                out.append([(a + b) / 2 for a, b in zip(values, values[1:])])
                continue
        out.append(sorted(set(got[f"q{i}"] or [])))
    return out


def _gini(counts: np.ndarray) -> np.ndarray:
    n = counts.sum(axis=-1)
    return n - (counts**2).sum(axis=-1) / np.maximum(n, 1e-300)


def best_split(hist: np.ndarray, total: np.ndarray, min_bucket: float) -> Split | None:
    """The split with the largest fall of impurity (``hist``: feature, bin, class), ties to the first feature and cut; the fall
    counts rows with a value only, so features with missing values are held back by themselves."""
    best, found = 1e-9 * max(total.sum(), 1.0), None
    for f in range(hist.shape[0]):
        left = hist[f].cumsum(axis=0)[:-1]
        own = hist[f].sum(axis=0)
        right = own - left
        fall = _gini(own) - _gini(left) - _gini(right)
        fall[(left.sum(axis=1) < min_bucket) | (right.sum(axis=1) < min_bucket)] = -1
        if len(fall) and fall.max() > best * (1 + 1e-12):
            best, found = float(fall.max()), Split(f, int(fall.argmax()))
    return found


def surrogates(sides: np.ndarray, feature: int, most: int = SURROGATES) -> tuple[list[Split], int]:
    """(surrogate splits, larger side) from side counts (feature, bin, side): cuts of other features that send more rows the same
    way than always choosing the larger side does, best first."""
    whole = sides[feature].sum(axis=0)
    out = []
    for f in range(sides.shape[0]):
        if f == feature or not sides[f].sum():
            continue
        left = sides[f].cumsum(axis=0)[:-1]
        own = sides[f].sum(axis=0)
        same = left[:, 0] + (own - left)[:, 1]
        n = own.sum()
        for agree, rev in ((same, False), (n - same, True)):
            if len(agree) and agree.max() > own.max():
                out.append(Split(f, int(agree.argmax()), rev, agreement=float(agree.max() / n)))
    ranked = {}
    for s in sorted(out, key=lambda s: (-s.agreement, s.feature, s.reversed)):
        ranked.setdefault(s.feature, s)
    return list(ranked.values())[:most], int(whole[1] > whole[0])


def weakest_links(tree: dict[int, Node], total: float) -> list[tuple[float, frozenset[int]]]:
    """The pruning sequence: (complexity from which a tree is the best, nodes that have become leaves)."""
    def risk(n: int) -> float:
        return (tree[n].counts.sum() - tree[n].counts.max()) / total

    def walk(n: int, cut: set) -> tuple[float, int]:
        """(risk, leaves) of the branch below a node."""
        if n in cut or tree[n].split is None:
            return risk(n), 1
        (ra, la), (rb, lb) = walk(2 * n, cut), walk(2 * n + 1, cut)
        return ra + rb, la + lb

    def inner(n: int, cut: set) -> list[int]:
        if n in cut or tree[n].split is None:
            return []
        return [n, *inner(2 * n, cut), *inner(2 * n + 1, cut)]

    cut: set[int] = set()
    out: list[tuple[float, frozenset[int]]] = []
    floor = 0.0
    while True:
        nodes = inner(1, cut)
        link = {n: (risk(n) - walk(n, cut)[0]) / (walk(n, cut)[1] - 1) for n in nodes}
        weak = [n for n, g in link.items() if g <= floor + 1e-12]
        if weak:  # branches that are worth nothing at this complexity
            cut.update(weak)
            continue
        out.append((floor, frozenset(cut)))
        if not nodes:
            return out
        floor = min(link.values())


@dataclass
class Tree:
    """A pruned tree: nodes (children of n are 2n and 2n + 1), cut points, classes, and the table of the pruning sequence."""

    nodes: dict[int, Node]
    cut: frozenset[int]
    features: list[str]
    edges: list[list[float]]
    classes: list
    table: list[tuple[float, int, float, float, float]]

    def leaf(self, n: int) -> bool:
        return n in self.cut or self.nodes[n].split is None

    def splits(self, n: int = 1) -> int:
        return 0 if self.leaf(n) else 1 + self.splits(2 * n) + self.splits(2 * n + 1)

    def _right(self, s: Split) -> Column:
        """Whether a row goes right; null where no split of the list has its value."""
        def one(t: Split) -> Column:
            x = F.col(self.features[t.feature]).cast("double")
            value = (x <= self.edges[t.feature][t.cut]) if t.reversed else (x > self.edges[t.feature][t.cut])
            return F.when(x.isNotNull() & ~F.isnan(x), value)

        return F.coalesce(one(s), *[one(t) for t in s.surrogates], F.lit(bool(s.larger)))

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the class of the leaf that each row reaches, as one expression."""
        def value(n: int) -> Column:
            node = self.nodes[n]
            if self.leaf(n):
                return F.lit(self.classes[int(node.counts.argmax())])
            return F.when(self._right(node.split), value(2 * n + 1)).otherwise(value(2 * n))

        return df.withColumn(out, value(1))


def _binned(df: DataFrame, features: list[str], edges: list[list[float]], label: str, fold: str, folds: int) -> DataFrame:
    """Binned rows per tree (0: all rows; t: the rows outside fold t - 1, with those inside along for the ride), equal rows counted."""
    def bin_of(f: str, cuts: list[float]) -> Column:
        x = F.col(f).cast("double")
        if not cuts:
            return F.when(x.isNotNull() & ~F.isnan(x), F.lit(0))
        return F.when(x.isNotNull() & ~F.isnan(x), F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: x > c)))

    rows = df.select(*[bin_of(f, e).cast("int").alias(f"b{i}") for i, (f, e) in enumerate(zip(features, edges))],
                     F.col(label).alias("y"), F.col(fold).cast("int").alias("f")).groupBy(*[f"b{i}" for i in range(len(features))], "y", "f").agg(F.count("*").alias("n"))
    tree = F.explode(F.sequence(F.lit(0), F.lit(folds)))
    return rows.withColumn("tree", tree).withColumn("train", (F.col("tree") == 0) | (F.col("tree") != F.coalesce(F.col("f"), F.lit(-1)) + 1)).where(
        F.col("train") | (F.col("tree") > 0)).withColumn("node", F.lit(1).cast("long")).drop("f")


def fit_tree(df: DataFrame, features: list[str], label: str, fold: str, folds: int = 10, max_depth: int = 6, min_split: int = 20,
             min_bucket: int = 7, bins: int = BINS, one_se: bool = False) -> Tree:
    """Grow, prune by weakest links, and choose the complexity with the least cross-validated error on the folds of column
    ``fold`` (0 to ``folds`` - 1; with ``one_se`` the smallest tree within one standard error of it).

    Rows with a null label take no part; missing and NaN features follow the surrogates.  Ties between classes go to the first.
    ``table``: complexity, splits, relative error, cross-validated relative error and its standard error per pruned tree."""
    spark = df.sparkSession
    df = df.where(F.col(label).isNotNull())
    edges = _edges(df, features, bins)
    width = max([len(e) for e in edges] + [0]) + 1
    rows, path = written_at(_binned(df, features, edges, label, fold, folds), "tree-rows")
    classes = [r["y"] for r in rows.select("y").distinct().orderBy("y").collect()]
    if not classes:
        raise ValueError("no rows with a label")
    place = {c: i for i, c in enumerate(classes)}
    trees: list[dict[int, Node]] = [{} for _ in range(folds + 1)]
    k = len(features)
    stacked = F.explode(F.array(F.struct(F.lit(-1).alias("feature"), F.lit(0).alias("bin")),
                                *[F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in range(k)]))
    paths, alive = [path], [(t, 1) for t in range(folds + 1)]
    for depth in range(max_depth + 1):
        own = rows.where("train").withColumn("s", stacked).where("s.bin IS NOT NULL")
        got = own.groupBy("tree", "node", F.col("s.feature").alias("feature"), F.col("s.bin").alias("bin"), "y").agg(F.sum("n").alias("n")).collect()
        hist: dict = defaultdict(lambda: np.zeros((k, width, len(classes))))
        whole: dict = defaultdict(lambda: np.zeros(len(classes)))
        for r in got:
            at = (r["tree"], r["node"])
            if r["feature"] < 0:
                whole[at][place[r["y"]]] += r["n"]
            else:
                hist[at][r["feature"], r["bin"], place[r["y"]]] += r["n"]
        split: dict[tuple[int, int], Split] = {}
        for t, n in alive:
            trees[t][n] = Node(whole[t, n])
            if depth < max_depth and whole[t, n].sum() >= min_split and (whole[t, n] > 0).sum() > 1:
                s = best_split(hist[t, n], whole[t, n], min_bucket)
                if s:
                    trees[t][n].split = split[t, n] = s
        if not split:
            break

        def known(which, split=split):
            return spark.createDataFrame([(t, n, *which(s)) for (t, n), s in sorted(split.items())],
                                         "_t int, _n long, _f int, _c int, _other array<struct<f:int,c:int,r:boolean>>, _larger int")

        bin_at = F.array(*[F.col(f"b{i}") for i in range(k)])
        # The split table has one row per live node: bounded by trees x nodes.
        here = (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n"))
        first = rows.where("train").join(F.broadcast(known(lambda s: (s.feature, s.cut, [], 0))), here).withColumn("_b", F.get(bin_at, F.col("_f"))).where("_b IS NOT NULL")
        counted = first.withColumn("side", (F.col("_b") > F.col("_c")).cast("int")).withColumn("s", stacked).where("s.bin IS NOT NULL AND s.feature >= 0")
        sides: dict = defaultdict(lambda: np.zeros((k, width, 2)))
        for r in counted.groupBy("tree", "node", F.col("s.feature").alias("feature"), F.col("s.bin").alias("bin"), "side").agg(F.sum("n").alias("n")).collect():
            sides[r["tree"], r["node"]][r["feature"], r["bin"], r["side"]] += r["n"]
        for at, s in split.items():
            s.surrogates, s.larger = surrogates(sides[at], s.feature)
        table = known(lambda s: (s.feature, s.cut, [(x.feature, x.cut, x.reversed) for x in s.surrogates], s.larger))
        down = rows.join(F.broadcast(table), here, "left")
        main = F.when(F.get(bin_at, F.col("_f")).isNotNull(), (F.get(bin_at, F.col("_f")) > F.col("_c")).cast("int"))
        usable = F.filter(F.col("_other"), lambda o: F.get(bin_at, o["f"]).isNotNull())
        other = F.get(F.transform(usable, lambda o: ((F.get(bin_at, o["f"]) > o["c"]) != o["r"]).cast("int")), F.lit(0))
        right = F.coalesce(main, other, F.col("_larger"))
        moved = down.withColumn("node", F.when(F.col("_f").isNotNull(), 2 * F.col("node") + right).otherwise(F.col("node"))).select(*rows.columns)
        rows, path = written_at(moved, "tree-rows")
        paths.append(path)
        if len(paths) > 1:
            drop_path(spark, paths.pop(0))
        alive = [(t, child) for t, n in split for child in (2 * n, 2 * n + 1)]
    ends = rows.where("NOT train").groupBy("tree", "node", "y").agg(F.sum("n").alias("n")).collect()
    return _pruned(trees, [(r["tree"], r["node"], place[r["y"]], r["n"]) for r in ends], features, edges, classes, one_se)


def _pruned(trees: list[dict[int, Node]], ends: list[tuple], features, edges, classes, one_se: bool) -> Tree:
    """Choose from the pruning sequence of the first tree by the errors that the other trees make on their held-out rows."""
    full, total = trees[0], trees[0][1].counts.sum()
    sequence = weakest_links(full, total)
    root = max((total - full[1].counts.max()) / total, 1e-300)
    own = [weakest_links(t, max(t[1].counts.sum(), 1)) if t and 1 in t else [] for t in trees[1:]]
    table, held = [], sum(e[3] for e in ends)
    for i, (alpha, cut) in enumerate(sequence):
        tree = Tree(full, cut, features, edges, classes, [])
        error = sum(n.counts.sum() - n.counts.max() for k, n in full.items() if tree.leaf(k) and not _below(k, tree)) / total
        middle = np.sqrt(alpha * sequence[i + 1][0]) if i + 1 < len(sequence) else np.inf
        wrong = 0
        for t, node, y, n in ends:
            if not own[t - 1]:
                continue
            fold_cut = [c for a, c in own[t - 1] if a <= middle + 1e-15][-1]
            while node > 1 and any(node >> j in fold_cut for j in range(1, node.bit_length())):
                node >>= 1
            wrong += n * int(trees[t][node].counts.argmax() != y)
        x = wrong / held if held else error
        se = np.sqrt(x * (1 - x) / held) if held else 0.0
        table.append((float(alpha / root), tree.splits(), float(error / root), float(x / root), float(se / root)))
    least = min(range(len(table)), key=lambda i: (table[i][3], table[i][1]))
    if one_se:
        least = max(i for i in range(len(table)) if table[i][3] <= table[least][3] + table[least][4])
    return Tree(full, sequence[least][1], features, edges, classes, table)


def _below(n: int, tree: Tree) -> bool:
    """Whether an ancestor of a node is a leaf."""
    n >>= 1
    while n:
        if tree.leaf(n):
            return True
        n >>= 1
    return False
