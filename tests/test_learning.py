"""Learning operators against numpy references and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat import plans
from camstat.operators import learning as L
from camstat.operators import stats as ST


def test_rda_matches_numpy(spark):
    rng = np.random.default_rng(0)
    n = 60
    X = rng.normal(size=(n, 2))
    Y = X @ np.array([[1.0, 0.5, 0.0], [0.0, 1.0, 2.0]]) + rng.normal(scale=0.3, size=(n, 3))
    rows = [(i, *map(float, X[i]), *map(float, Y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, x1 double, x2 double, y1 double, y2 double, y3 double")
    axes, sp, sites, predictors = L.rda(df, "k", ["y1", "y2", "y3"], ["x1", "x2"])
    Xc, Yc = X - X.mean(0), Y - Y.mean(0)
    B = np.linalg.lstsq(Xc, Yc, rcond=None)[0]
    F_ = Xc @ B
    r2 = (F_ ** 2).sum() / (Yc ** 2).sum()
    ev = np.sort(np.linalg.eigvalsh(F_.T @ F_ / (n - 1)))[::-1][:2]
    a = axes.orderBy("axis").collect()
    assert abs(a[0].r2 - r2) < 1e-9
    assert abs(a[0].adj_r2 - (1 - (1 - r2) * (n - 1) / (n - 2 - 1))) < 1e-9
    assert np.allclose([x.eigenvalue for x in a], ev)
    s = np.array([[r.rda1, r.rda2] for r in sites.orderBy("k").collect()])
    lam, vec = np.linalg.eigh(F_.T @ F_ / (n - 1))
    lam, vec = lam[::-1][:2], vec[:, ::-1][:, :2]
    vec = vec * np.sign(vec[np.abs(vec).argmax(axis=0), [0, 1]])  # largest loading positive
    total = Yc.var(axis=0, ddof=1).sum()
    const = ((n - 1) * total) ** 0.25
    z = F_ @ vec
    assert np.allclose(s, z / np.linalg.norm(z, axis=0) * const)
    assert np.allclose([[r.rda1, r.rda2] for r in sp.collect()], vec * np.sqrt(lam / total) * const)
    assert np.allclose([[r.rda1, r.rda2] for r in predictors.collect()],
                       [[np.corrcoef(X[:, i], z[:, k])[0, 1] for k in range(2)] for i in range(2)])


def test_held_out_models(spark):
    """Forest, tree, importance and head on a separable table, scored on held-out rows."""
    from camstat.operators import metrics as M
    rng = np.random.default_rng(3)
    rows = [(i, float(y), float(y + 0.3 * rng.normal()), float(rng.normal()), [float(y + 0.2 * rng.normal()), float(rng.normal())])
            for i, y in enumerate(rng.integers(0, 2, 240))]
    df = M.folds(spark.createDataFrame(rows, "k int, y double, a double, b double, v array<double>"), "k", 3)
    t = M.split_stratified(df, "y", "k", 0.25)
    train, test = t.filter("split = 'train'").cache(), t.filter("split = 'eval'").cache()
    cv = L.tune_forest(train, ["a", "b"], "y", trees=(10,), min_nodes=(1,), mtry=("sqrt",), folds=3)
    _, m = L.last_fit(cv.bestModel, test, "y")
    assert m["auc"] > 0.95
    imp = {r["feature"]: r["importance"] for r in L.perm_importance(cv.bestModel, df, ["a", "b"], "y", "k").collect()}
    assert imp["a"] > 0.2 > abs(imp["b"])
    tree = L.tree_fit(train, ["a", "b"], "y").transform(test)
    assert tree.filter("prediction = y").count() / test.count() > 0.9
    head = L.score(L.train_head(train, "v", "y", 2), test, "v", "k").join(test, "k")
    assert head.filter("prediction = y").count() / test.count() > 0.9
    train.unpersist()
    test.unpersist()


def test_binomial_surface(spark):
    rows = [(float(x), float(y), float(x > y), 5.0) for x in range(-4, 5) for y in range(-4, 5)]
    t = spark.createDataFrame(rows, "x double, y double, hit double, n double")
    p = {(r.x, r.y): r.prediction for r in L.smooth_fit(t, t.select("x", "y"), "x", "y", "hit", "binomial", 1, weight="n").collect()}
    assert p[(4.0, -4.0)] > 0.9 and p[(-4.0, 4.0)] < 0.1


def test_anova_matches_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(rng.normal(loc=g))) for g in range(3) for _ in range(20)]
    df = spark.createDataFrame(rows, "g int, y double")
    r = ST.anova(df, "y", "g").first()
    ys = [np.array([y for gg, y in rows if gg == g]) for g in range(3)]
    grand = np.concatenate(ys).mean()
    ssb = sum(len(v) * (v.mean() - grand) ** 2 for v in ys)
    ssw = sum(((v - v.mean()) ** 2).sum() for v in ys)
    assert abs(r.ssb - ssb) < 1e-9 and abs(r.ssw - ssw) < 1e-9
    assert abs(r.f - (ssb / 2) / (ssw / 57)) < 1e-9


def test_prune_correlated(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=100)
    rows = [(float(x), float(x * 2 + 0.01 * rng.normal()), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    drop = ST.prune_correlated(df, ["a", "b", "c"], 0.9)
    assert len(drop) == 1 and drop[0] in ("a", "b")


def test_clusters_separate_groups(spark):
    rows = [(i, 0.0 + 0.01 * i, 1.0) for i in range(10)] + [(100 + i, 5.0 + 0.01 * i, 0.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, f1 double, f2 double")
    c = {r.k: r.cluster for r in L.cluster_sites(df, "k", ["f1", "f2"], k=2).collect()}
    assert len({c[i] for i in range(10)}) == 1 and c[0] != c[100]
    g = L.cluster_geo(df.withColumn("x", F.col("f1")).withColumn("y", F.lit(0.0)), "k", ["f1", "f2"], ["x", "y"], 0.1, 2)
    assert g.select("cluster").distinct().count() == 2


@pytest.mark.parametrize("name", ["forest_status", "permutation_importance"])
def test_registered_forests_are_tuned(spark, sf, monkeypatch, name):
    """Features per split x minimum node size, at least 50 trees, ten folds."""
    seen = []

    def fit(cv, train):
        seen.append((cv, train.select("fold").distinct().count()))
        raise InterruptedError

    monkeypatch.setattr(L.CrossValidator, "fit", fit)
    plans.load_all()
    with pytest.raises(InterruptedError):
        plans.QUERIES[name](spark, sf)
    (cv, folds), = seen
    grid = [{p.name: v for p, v in point.items()} for point in cv.getEstimatorParamMaps()]
    assert {(g["minInstancesPerNode"], g["featureSubsetStrategy"]) for g in grid} == {(m, f) for m in (1, 5) for f in ("sqrt", "onethird")}
    assert min(g["numTrees"] for g in grid) >= 50 and cv.getNumFolds() == folds == 10
