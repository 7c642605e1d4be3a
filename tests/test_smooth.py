import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.operators import learning as L
from camstat.operators import smooth as SM


def basis(x, low, high, cells):
    """Cubic B-splines by the recursion over knots."""
    h = (high - low) / cells
    knots = low + h * np.arange(-3, cells + 4)
    x = np.minimum(np.asarray(x, float), np.nextafter(high, low))
    b = [((x >= knots[i]) & (x < knots[i + 1])).astype(float) for i in range(len(knots) - 1)]
    for k in range(1, 4):
        b = [(x - knots[i]) / (k * h) * b[i] + (knots[i + k + 1] - x) / (k * h) * b[i + 1] for i in range(len(knots) - 1 - k)]
    return np.stack(b, 1)


def second(size):
    d = np.diff(np.eye(size), 2, axis=0)
    return d.T @ d


def plain_fit(x, s, y, w, family, rounds):
    """Penalised least squares, iterated, with the full design matrix."""
    eta = {"gaussian": y, "poisson": np.log(y + 0.1), "binomial": np.log((y + 0.5) / 2 / (1 - (y + 0.5) / 2))}[family]
    for _ in range(rounds):
        if family == "gaussian":
            ww, z = w, y
        elif family == "poisson":
            mu = np.exp(eta)
            ww, z = w * mu, eta + (y - mu) / mu
        else:
            mu = 1 / (1 + np.exp(-eta))
            ww, z = w * mu * (1 - mu), eta + (y - mu) / (mu * (1 - mu))
        beta = np.linalg.lstsq(x.T @ (ww[:, None] * x) + s, x.T @ (ww * z), rcond=None)[0]
        eta = x @ beta
    return beta


def table(spark, columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*[[float(v) for v in columns[n]] for n in names])), ", ".join(f"{n} double" for n in names))


def predicted(model, spark, **columns):
    return np.array([r["prediction"] for r in model.predict(table(spark, {"id": range(len(next(iter(columns.values())))), **columns})).orderBy("id").collect()])


@pytest.mark.parametrize("family", ["gaussian", "poisson", "binomial"])
def test_one_smooth_equals_the_full_design(spark, family):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 3, 300)
    level = np.sin(2 * x)
    y = {"gaussian": level + rng.normal(0, 0.3, 300), "poisson": rng.poisson(np.exp(level + 1)), "binomial": (rng.random(300) < 1 / (1 + np.exp(-2 * level)))}[family].astype(float)
    model = SM.fit_smooth(table(spark, {"x": x, "y": y}), ["x"], "y", family, cells=8, ranges=[(-2, 3)], smoothing=[0.7])
    b = basis(x, -2, 3, 8)
    want = basis(np.linspace(-2, 3, 41), -2, 3, 8) @ plain_fit(b, 0.7 * second(11), y, np.ones(300), family, 60)
    want = {"gaussian": want, "poisson": np.exp(want), "binomial": 1 / (1 + np.exp(-want))}[family]
    assert np.abs(predicted(model, spark, x=np.linspace(-2, 3, 41)) - want).max() < 1e-6


def test_surface_on_a_grid_equals_the_full_design(spark):
    """s(x, y) under the parameter of generalised cross-validation, on a 0.1 degree grid."""
    rng = np.random.default_rng(2)
    x, y = rng.uniform(-89, -84, 400), rng.uniform(50, 55, 400)
    z = np.sin(1.5 * x) * np.cos(y) + rng.normal(0, 0.2, 400)
    model = SM.fit_smooth(table(spark, {"x": x, "y": y, "z": z}), ["x", "y"], "z", tensor=True, cells=6, ranges=[(-89, -84), (50, 55)])

    def design(a, b):
        ba, bb = basis(a, -89, -84, 6), basis(b, 50, 55, 6)
        return (ba[:, :, None] * bb[:, None, :]).reshape(len(a), -1)

    s = np.kron(second(9), np.eye(9)) + np.kron(np.eye(9), second(9))
    gx, gy = [g.reshape(-1) for g in np.meshgrid(np.arange(-89, -83.99, 0.1).clip(-89, -84), np.arange(50, 55.01, 0.1).clip(50, 55))]
    own = design(x, y)
    want = design(gx, gy) @ plain_fit(own, model.smoothing[0] * s, z, np.ones(400), "gaussian", 1)
    assert np.abs(predicted(model, spark, x=gx, y=gy) - want).max() < 1e-6

    def gcv(lam):
        a = own.T @ own
        f = np.linalg.solve(a + lam * s, np.column_stack([own.T @ z, a]))
        return 400 * ((z - own @ f[:, 0]) ** 2).sum() / (400 - np.trace(f[:, 1:])) ** 2

    assert model.gcv == pytest.approx(gcv(model.smoothing[0]), rel=1e-6)
    assert model.gcv <= min(gcv(model.smoothing[0] * k) for k in (0.3, 0.8, 1.25, 3)) * (1 + 1e-6)


def test_additive_binomial_equals_the_full_design(spark):
    rng = np.random.default_rng(3)
    a, b = rng.uniform(0, 1, 600), rng.uniform(10, 20, 600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(3 * np.sin(5 * a) + 0.4 * (b - 15))))).astype(float)
    w = rng.integers(1, 4, 600).astype(float)
    model = SM.fit_smooth(table(spark, {"a": a, "b": b, "y": y, "n": w}), ["a", "b"], "y", "binomial", cells=6, weight="n", ranges=[(0, 1), (10, 20)], smoothing=[0.3, 2.0])
    x = np.hstack([np.ones((600, 1)), basis(a, 0, 1, 6), basis(b, 10, 20, 6)])
    s = np.zeros((19, 19))
    s[1:10, 1:10], s[10:, 10:] = 0.3 * second(9), 2.0 * second(9)
    beta = plain_fit(x, s, y, w, "binomial", 60)
    ga, gb = [g.reshape(-1) for g in np.meshgrid(np.linspace(0, 1, 11), np.linspace(10, 20, 11))]
    want = 1 / (1 + np.exp(-(np.hstack([np.ones((121, 1)), basis(ga, 0, 1, 6), basis(gb, 10, 20, 6)]) @ beta)))
    assert np.abs(predicted(model, spark, a=ga, b=gb) - want).max() < 1e-6
    free = SM.fit_smooth(table(spark, {"a": a, "b": b, "y": y, "n": w}), ["a", "b"], "y", "binomial", cells=6, weight="n")
    assert len(free.smoothing) == 2 and 3 < free.edf < 15 and free.iterations < 30


def test_beats_the_quadratic_surface(spark):
    """A planted curved surface: the smooth follows it, the degree-2 model cannot."""
    rng = np.random.default_rng(4)
    x, y = rng.uniform(-3, 3, 1500), rng.uniform(-3, 3, 1500)
    mean = np.exp(1 + np.sin(2 * x) * np.cos(2 * y))
    train = table(spark, {"x": x, "y": y, "n": rng.poisson(mean)})
    gx, gy = rng.uniform(-2.8, 2.8, 300), rng.uniform(-2.8, 2.8, 300)
    truth = np.exp(1 + np.sin(2 * gx) * np.cos(2 * gy))
    model = SM.fit_smooth(train, ["x", "y"], "n", "poisson", tensor=True, cells=8)
    glm = L.smooth_fit(train, table(spark, {"id": range(300), "x": gx, "y": gy}), "x", "y", "n", "poisson", 2).orderBy("id").collect()
    error = np.sqrt(((predicted(model, spark, x=gx, y=gy) - truth) ** 2).mean())
    assert error < 0.35 * np.sqrt(((np.array([r["prediction"] for r in glm]) - truth) ** 2).mean())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (2.0, None), (float("nan"), 1.0), (3.0, 2.0), (2.0, 2.0), (2.0, 2.0)], "x double, y double")
    model = SM.fit_smooth(df, ["x"], "y", cells=4)
    got = {r["x"]: r["prediction"] for r in model.predict(df.select("x").distinct()).collect() if r["x"] is not None and r["x"] == r["x"]}
    assert all(v == pytest.approx(2.0, abs=1e-6) for v in got.values())
    assert model.predict(df.where("x IS NULL")).first()["prediction"] is None
    assert model.predict(df.limit(1).select(F.lit(9.0).alias("x"))).first()["prediction"] is None  # outside the knots
    empty = SM.fit_smooth(df.limit(0), ["x"], "y")
    assert not empty.beta.any()
    with pytest.raises(ValueError):
        SM.fit_smooth(df, ["x"], "y", family="gamma")
