import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.operators import rtree as RT
from camstat.operators import ward as WD


def brute_ward(x, k, weight=None):
    """Merge the cheapest pair, one at a time."""
    groups = [[i] for i in range(len(x))]
    heights = []
    while len(groups) > 1:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                a, b = x[groups[i]], x[groups[j]]
                cost = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, i, j)
        heights.append(np.sqrt(2 * best[0]))
        if len(groups) == k:
            cut = [list(g) for g in groups]
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in (cut if k > 1 else groups)}, heights


def fast_ward(x, k):
    """The same by Lance-Williams on a matrix (200 sites are too many for the loops above)."""
    n = len(x)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    size, alive, groups, heights = np.ones(n), list(range(n)), {i: [i] for i in range(n)}, []
    while len(alive) > 1:
        if len(alive) == k:
            cut = {frozenset(groups[i]) for i in alive}
        sub = d[np.ix_(alive, alive)]
        i, j = divmod(int(sub.argmin()), len(alive))
        i, j = sorted((alive[i], alive[j]))
        heights.append(np.sqrt(d[i, j]))
        for m in alive:
            if m not in (i, j):
                d[i, m] = d[m, i] = ((size[i] + size[m]) * d[i, m] + (size[j] + size[m]) * d[j, m] - size[m] * d[i, j]) / (size[i] + size[j] + size[m])
        size[i] += size[j]
        groups[i] += groups.pop(j)
        alive.remove(j)
    return cut, heights


def sites(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "site long, " + ", ".join(f"c{k} double" for k in range(x.shape[1])))


def partition(groups):
    out = {}
    for r in groups.collect():
        out.setdefault(r["cluster"], set()).add(r[0])
    return {frozenset(g) for g in out.values()}


def test_same_partition_as_matrix_ward(spark, monkeypatch):
    """200 sites, in blocks smaller than the table."""
    monkeypatch.setattr(WD, "BLOCK", 64)
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.6, (50, 3)) for c in ((0, 0, 0), (2, 0, 1), (0, 3, 0), (2, 2, 2))])
    members, merges = WD.ward_tree(sites(spark, x), "site", ["c0", "c1", "c2"])
    for k in (2, 4, 7):
        want, heights = fast_ward(x, k)
        assert partition(WD.cut_tree(members, merges, k)) == want
    assert np.allclose(sorted(r["height"] for r in merges.collect()), sorted(heights))
    assert merges.agg(F.max("round")).first()[0] < 40


def test_small_tables_against_pairwise_merging(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(14, 2))
    members, merges = WD.ward_tree(sites(spark, x), "site", ["c0", "c1"])
    want, heights = brute_ward(x, 3)
    assert partition(WD.cut_tree(members, merges, 3)) == want
    assert np.allclose(sorted(r["height"] for r in merges.collect()), sorted(heights))


def test_equal_profiles_ties_and_odd_rows(spark):
    x = np.array([[0, 0], [0, 0], [0, 0], [1, 0], [0, 1], [1, 1], [9, 9], [9, 9]], float)
    df = sites(spark, x).union(spark.createDataFrame([(50, None, 1.0), (51, float("nan"), 1.0)], "site long, c0 double, c1 double"))
    members, merges = WD.ward_tree(df, "site", ["c0", "c1"])
    assert members.count() == 8 and merges.count() == 4
    assert partition(WD.cut_tree(members, merges, 2)) == {frozenset(range(6)), frozenset({6, 7})}
    assert len(partition(WD.cut_tree(members, merges, 99))) == 5
    assert len(partition(WD.cut_tree(members, merges, 1))) == 1
    one = sites(spark, x[:1])
    assert partition(WD.ward(one, "site", ["c0", "c1"], 2)) == {frozenset({0})}
    assert WD.ward(one.limit(0), "site", ["c0", "c1"], 2).count() == 0


def test_widest_pair(spark):
    x = np.random.default_rng(3).normal(size=(400, 3))
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2).max())
    assert WD.widest(sites(spark, x), ["c0", "c1", "c2"]) == pytest.approx(want)


def test_constrained_groups_and_inertia(spark):
    rng = np.random.default_rng(4)
    place = np.vstack([rng.normal((-88, 51), 0.2, (20, 2)), rng.normal((-84, 54), 0.2, (20, 2))])
    profile = rng.random((40, 2))
    df = spark.createDataFrame([(i, *map(float, p), *map(float, g)) for i, (p, g) in enumerate(zip(profile, place))], "site long, a double, b double, lon double, lat double")
    found = WD.ward_geo(df, "site", ["a", "b"], "lon", "lat", [0.0, 1.0], 2)
    (_, g0, p0, s0), (_, g1, p1, s1) = found
    assert partition(g1) == {frozenset(range(20)), frozenset(range(20, 40))} and s1 > 0.95 > s0
    scaled = (profile - 0) / (profile.max(0) - profile.min(0)) / np.sqrt(2)
    assert partition(g0) == fast_ward(scaled, 2)[0]
    within = sum(((scaled[list(g)] - scaled[list(g)].mean(0)) ** 2).sum() for g in partition(g0))
    assert p0 == pytest.approx(1 - within / ((scaled - scaled.mean(0)) ** 2).sum()) and p0 > p1


# ---------------------------------------------------------------- trees

def brute_tree(x, y, depth, min_split, min_bucket, classes):
    """A plain recursive tree on all cuts between values: (counts, feature, cut, left, right)."""
    counts = np.array([(y == c).sum() for c in classes], float)

    def gini(v):
        return len(v) - sum((v == c).sum() ** 2 for c in classes) / max(len(v), 1e-300)

    best = None
    if depth and len(y) >= min_split and (counts > 0).sum() > 1:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                if min(left.sum(), (~left).sum()) < min_bucket:
                    continue
                fall = gini(y) - gini(y[left]) - gini(y[~left])
                if fall > 1e-9 and (best is None or fall > best[0] * (1 + 1e-12)):
                    best = (fall, f, cut, left)
    if best is None:
        return (counts, None, None, None, None)
    _, f, cut, left = best
    return (counts, f, cut, *[brute_tree(x[m], y[m], depth - 1, min_split, min_bucket, classes) for m in (left, ~left)])


def subtrees(t):
    """(errors, leaves) of all prunings."""
    out = {(t[0].sum() - t[0].max(), 1)}
    if t[1] is not None:
        out |= {(a[0] + b[0], a[1] + b[1]) for a in subtrees(t[3]) for b in subtrees(t[4])}
    return out


def table(spark, x, y, folds=5):
    return spark.createDataFrame([(*[None if v != v else float(v) for v in r], str(c), i % folds) for i, (r, c) in enumerate(zip(x, y))],
                                 ", ".join(f"c{k} double" for k in range(x.shape[1])) + ", y string, fold int")


def test_same_tree_and_pruning_sequence_as_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (240, 3)).astype(float)
    y = np.where(x[:, 0] + rng.normal(0, 1.5, 240) > 6, "b", np.where(x[:, 1] > 8, "c", "a"))
    tree = RT.fit_tree(table(spark, x, y), ["c0", "c1", "c2"], "y", "fold", 5, max_depth=4, min_split=20, min_bucket=7)
    classes = sorted(set(y))
    want = brute_tree(x, y, 4, 20, 7, classes)

    def compare(n, t):
        node = tree.nodes[n]
        assert (node.counts == t[0]).all()
        assert (node.split is None) == (t[1] is None)
        if t[1] is not None:
            assert node.split.feature == t[1] and tree.edges[t[1]][node.split.cut] == t[2]
            compare(2 * n, t[3])
            compare(2 * n + 1, t[4])

    compare(1, want)
    # The sequence holds exactly the prunings that are best for some complexity.
    every = subtrees(want)
    best = set()
    for alpha in np.linspace(0, 1, 4001) ** 2 * 240:
        score = {(e + alpha * n, n): (e, n) for e, n in every}
        best.add(score[min(score, key=lambda k: (round(k[0], 9), k[1]))])
    got = {(round(rel * (240 - want[0].max()), 6), splits + 1) for _, splits, rel, _, _ in tree.table}
    assert got == {(round(e, 6), n) for e, n in best}
    assert [t[0] for t in tree.table] == sorted(t[0] for t in tree.table)


def test_cross_validation_prunes_noise(spark):
    rng = np.random.default_rng(6)
    x = rng.random((600, 4))
    y = np.where((x[:, 0] > 0.5) ^ (rng.random(600) < 0.1), "b", "a")
    df = table(spark, x, y, 10)
    tree = RT.fit_tree(df, [f"c{k}" for k in range(4)], "y", "fold", one_se=True)
    assert tree.splits() == 1 and len(tree.table) >= 2
    fresh = rng.random((400, 4))
    got = tree.predict(table(spark, fresh, np.where(fresh[:, 0] > 0.5, "b", "a"))).where("prediction = y").count()
    assert got > 0.95 * 400


def test_surrogates_stand_in_for_missing_values(spark):
    rng = np.random.default_rng(7)
    a = rng.random(500)
    x = np.stack([a, 1 - a + rng.normal(0, 0.02, 500), rng.random(500)], 1)
    y = np.where(a > 0.4, "b", "a")
    x[rng.random(500) < 0.3, 0] = np.nan
    tree = RT.fit_tree(table(spark, x, y, 10), ["c0", "c1", "c2"], "y", "fold")
    first = tree.nodes[1].split
    lost = x.copy()
    lost[:, first.feature] = np.nan
    assert first.surrogates and first.surrogates[0].feature in (0, 1)
    other = first.surrogates[0].feature
    left = tree.predict(table(spark, lost, y)).where(f"c{other} IS NOT NULL")
    assert left.where("prediction = y").count() > 0.9 * left.count()
    gone = np.full((4, 3), np.nan)
    assert tree.predict(table(spark, gone, ["a"] * 4)).select("prediction").distinct().count() == 1


def test_rows_without_label_and_one_class(spark):
    df = spark.createDataFrame([(1.0, None, 0), (2.0, "a", 0), (3.0, "a", 1)], "c0 double, y string, fold int")
    tree = RT.fit_tree(df, ["c0"], "y", "fold", 2)
    assert tree.splits() == 0 and tree.predict(df).first()["prediction"] == "a"
    with pytest.raises(ValueError):
        RT.fit_tree(df.where("y = 'z'"), ["c0"], "y", "fold", 2)
