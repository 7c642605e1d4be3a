"""Penalised smooths (X8): s(x), s(a) + s(b) and s(x, y) for Gaussian, Poisson and binomial responses.

A smooth is a cubic B-spline on equal knots with a penalty on second differences of its coefficients;
s(x, y) is the tensor product of two.  Between knots every such model is one polynomial of degree 3 in each
local coordinate, so a pass over the rows needs no design matrix: rows are grouped by knot cell and only
sums of powers of the local coordinates are taken (they combine before the shuffle, and there is one row per
cell).  The driver assembles the normal equations from these sums, chooses the smoothing parameters by
generalised cross-validation and solves.  Poisson and binomial fits repeat that pass with the weights of
the current fit (penalised iteratively reweighted least squares).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camstat.session import written

#: The four cubic B-splines on a knot interval as polynomials of the place in it (rows: splines).
_CUBIC = np.array([[1, -3, 3, -1], [4, 0, -6, 3], [1, 3, 3, -3], [0, 0, 0, 1]]) / 6.0
#: Links by family.
FAMILIES = {"gaussian": "identity", "poisson": "log", "binomial": "logit"}


@dataclass
class Axis:
    """A covariate with its range and number of knot intervals."""

    column: str
    low: float
    high: float
    cells: int

    @property
    def step(self) -> float:
        return (self.high - self.low) / self.cells or 1.0

    @property
    def size(self) -> int:
        return self.cells + 3

    def cell(self) -> Column:
        return F.least(F.floor((F.col(self.column) - self.low) / self.step), F.lit(self.cells - 1)).cast("int")

    def inside(self) -> Column:
        return F.col(self.column).between(self.low, self.high)

    def local(self, cell: Column) -> Column:
        return (F.col(self.column) - self.low) / self.step - cell


def _differences(size: int) -> np.ndarray:
    d = np.diff(np.eye(size), 2, axis=0)
    return d.T @ d


@dataclass
class Model:
    """What is fitted: axes, the kind of model, coefficients of the splines and what is known of the fit."""

    axes: list[Axis]
    tensor: bool
    family: str
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    smoothing: tuple[float, ...] = ()
    edf: float = 0.0
    gcv: float = 0.0
    deviance: float = 0.0
    iterations: int = 0

    def __post_init__(self):
        a, b = self.axes[0], self.axes[1] if len(self.axes) > 1 else None
        self.two = b.cells if b else 1
        if self.tensor:
            self.size = a.size * b.size
            self.free = np.eye(self.size)
            pa, pb = np.kron(_differences(a.size), np.eye(b.size)), np.kron(np.eye(a.size), _differences(b.size))
            self.penalties = [pa + pb]
            self.local = np.kron(_CUBIC, _CUBIC)
        else:
            # A level and smooths whose coefficients sum to zero.
            self.size = 1 + sum(x.size for x in self.axes)
            blocks, at = [(0, np.eye(1))], 1
            self.penalties = []
            for x in self.axes:
                q, _ = np.linalg.qr(np.hstack([np.ones((x.size, 1)), np.eye(x.size)[:, :-1]]))
                blocks.append((at, q[:, 1:]))
                own = np.zeros((self.size, self.size))
                own[at:at + x.size, at:at + x.size] = _differences(x.size)
                self.penalties.append(own)
                at += x.size
            self.free = np.zeros((self.size, sum(z.shape[1] for _, z in blocks)))
            column = 0
            for at, z in blocks:
                self.free[at:at + z.shape[0], column:column + z.shape[1]] = z
                column += z.shape[1]
            one = np.zeros((1, 4))
            one[0, 0] = 1
            parts = [np.kron(one, one), np.kron(_CUBIC, one)]
            if b:
                parts.append(np.kron(one, _CUBIC))
            self.local = np.vstack(parts)

    def active(self, cell: int) -> np.ndarray:
        """Coefficients that matter in a knot cell, in the order of the rows of ``local``."""
        i, j = divmod(cell, self.two)
        if self.tensor:
            return ((i + np.arange(4))[:, None] * self.axes[1].size + j + np.arange(4)).reshape(-1)
        out = [np.zeros(1, int), 1 + i + np.arange(4)]
        if len(self.axes) > 1:
            out.append(1 + self.axes[0].size + j + np.arange(4))
        return np.concatenate(out)

    def polynomial(self, cell: int) -> np.ndarray:
        """The fitted predictor in a knot cell: coefficient of u^a v^b at 4 a + b."""
        return self.local.T @ self.beta[self.active(cell)]

    def _placed(self, df: DataFrame) -> DataFrame:
        """``_cell`` and the local coordinates; null outside the range of the knots."""
        inside = self.axes[0].inside()
        for x in self.axes[1:]:
            inside = inside & x.inside()
        df = df.withColumn("_i", self.axes[0].cell())
        df = df.withColumn("_j", self.axes[1].cell() if len(self.axes) > 1 else F.lit(0))
        return df.withColumns({
            "_cell": F.when(inside, F.col("_i") * self.two + F.col("_j")), "_u": self.axes[0].local(F.col("_i")),
            "_v": self.axes[1].local(F.col("_j")) if len(self.axes) > 1 else F.lit(0.0)}).drop("_i", "_j")

    def _predictor(self, placed: DataFrame) -> DataFrame:
        """``_eta`` by a join with the polynomials: one row per knot cell, a table of fixed size."""
        cells = self.axes[0].cells * self.two
        table = placed.sparkSession.createDataFrame(
            [(c, [float(p) for p in self.polynomial(c)]) for c in range(cells)], "_of int, _p array<double>")
        eta = F.lit(0.0)
        for a in range(3, -1, -1):
            row = F.lit(0.0)
            for b in range(3, -1, -1):
                row = row * F.col("_v") + F.col("_p")[4 * a + b]
            eta = eta * F.col("_u") + row
        joined = placed.join(F.broadcast(table), F.col("_cell") == F.col("_of"), "left")
        return joined.withColumn("_eta", eta).drop("_of", "_p")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the expected response; null where a covariate is null or outside the knots."""
        eta = F.col("_eta")
        mean = {"identity": eta, "log": F.exp(eta), "logit": 1 / (1 + F.exp(-eta))}[FAMILIES[self.family]]
        return self._predictor(self._placed(df)).withColumn(out, mean).drop("_cell", "_u", "_v", "_eta")


def _working(family: str, first: bool) -> tuple[Column, Column, Column]:
    """(weight, working response, deviance) of a row; in the first pass from the response itself."""
    y, w = F.col("_y"), F.col("_w")
    if family == "gaussian":
        return w, y, w * 0.0
    if family == "poisson":
        eta = F.log(y + 0.1) if first else F.col("_eta")
        mu = F.exp(eta)
        dev = 2 * w * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - (y - mu))
        return w * mu, eta + (y - mu) / mu, dev
    start = (y + 0.5) / 2
    eta = F.log(start / (1 - start)) if first else F.col("_eta")
    mu = F.greatest(F.least(1 / (1 + F.exp(-eta)), F.lit(1 - 1e-12)), F.lit(1e-12))
    dev = -2 * w * (y * F.log(mu) + (1 - y) * F.log(1 - mu))
    return w * mu * (1 - mu), eta + (y - mu) / (mu * (1 - mu)), dev


def _equations(rows: DataFrame, model: Model, first: bool) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(A, b, sum of w z^2, deviance) of the weighted normal equations, from one aggregate per knot cell."""
    w, z, dev = _working(model.family, first)
    rows = rows.select("_cell", "_u", "_v", w.alias("w"), z.alias("z"), dev.alias("d"))
    top = 7 if len(model.axes) > 1 else 1
    powers = [(a, b) for a in range(7) for b in range(top) if model.tensor or a == 0 or b == 0 or (a < 4 and b < 4)]
    low = [(a, b) for a in range(4) for b in range(min(4, top)) if model.tensor or a == 0 or b == 0]

    def term(a: int, b: int) -> Column:
        out = F.col("w")
        for name, k in (("_u", a), ("_v", b)):
            for _ in range(k):
                out = out * F.col(name)
        return out

    sums = [F.sum(term(a, b)).alias(f"m{a}_{b}") for a, b in powers] + [F.sum(term(a, b) * F.col("z")).alias(f"z{a}_{b}") for a, b in low]
    got = rows.groupBy("_cell").agg(*sums, F.sum(F.col("w") * F.col("z") * F.col("z")).alias("zz"), F.sum("d").alias("dev")).collect()
    a_mat, b_vec, zz, deviance = np.zeros((model.size, model.size)), np.zeros(model.size), 0.0, 0.0
    for r in sorted(got, key=lambda r: r["_cell"]):
        moment, response = np.zeros((7, 7)), np.zeros(16)
        for a, b in powers:
            moment[a, b] = r[f"m{a}_{b}"]
        for a, b in low:
            response[4 * a + b] = r[f"z{a}_{b}"]
        k = np.arange(16)
        gram = moment[(k // 4)[:, None] + k // 4, (k % 4)[:, None] + k % 4]
        own = model.active(r["_cell"])
        a_mat[np.ix_(own, own)] += model.local @ gram @ model.local.T
        b_vec[own] += model.local @ response
        zz += r["zz"]
        deviance += r["dev"]
    return a_mat, b_vec, zz, deviance


def _solve(a: np.ndarray, b: np.ndarray, zz: float, n: float, penalties: list[np.ndarray], smoothing) -> tuple[np.ndarray, float, float]:
    """(coefficients, effective degrees of freedom, GCV score) for given smoothing parameters."""
    whole = a + sum(s * p for s, p in zip(smoothing, penalties))
    whole = whole + np.eye(len(a)) * (1e-12 * np.trace(a) / len(a) + 1e-300)
    both = np.linalg.solve(whole, np.column_stack([b, a]))
    gamma, edf = both[:, 0], float(np.trace(both[:, 1:]))
    rss = max(zz - 2 * gamma @ b + gamma @ a @ gamma, 0.0)
    return gamma, edf, n * rss / max(n - edf, 1e-9) ** 2


def choose_smoothing(a, b, zz, n, penalties, start=None, span=(-6.0, 8.0)) -> list[float]:
    """Smoothing parameters that minimise the GCV score: one parameter at a time over powers of ten relative to
    the sizes of the matrices, then by golden sections."""
    unit = [np.trace(a) / max(np.trace(p), 1e-300) for p in penalties]
    power = [0.0] * len(penalties) if start is None else [float(np.log10(s / u)) for s, u in zip(start, unit)]

    if len(penalties) == 1:
        # One parameter: both matrices are made diagonal together, after which a score costs no solve.
        root = np.linalg.cholesky(a + np.eye(len(a)) * (1e-10 * np.trace(a) / len(a) + 1e-300))
        half = np.linalg.solve(root, np.column_stack([penalties[0], b]))
        values, turned = np.linalg.eigh(np.linalg.solve(root, half[:, :-1].T))
        along, values = turned.T @ half[:, -1], np.maximum(values, 0.0)

        def score(k, value):
            kept = 1 / (1 + unit[0] * 10**value * values)
            rss = max(zz - (along * along * kept * (2 - kept)).sum(), 1e-12 * zz)  # below that it is rounding
            return n * rss / max(n - kept.sum(), 1e-9) ** 2
    else:
        def score(k, value):
            own = [u * 10 ** (value if j == k else power[j]) for j, u in enumerate(unit)]
            return _solve(a, b, zz, n, penalties, own)[2]

    for _ in range(1 if len(penalties) == 1 else 4):
        for k in range(len(penalties)):
            at = min(np.arange(span[0], span[1] + 0.5), key=lambda v: (score(k, v), v))
            low, high = max(span[0], at - 1), min(span[1], at + 1)
            ratio = (np.sqrt(5) - 1) / 2
            for _ in range(20):
                c, d = high - ratio * (high - low), low + ratio * (high - low)
                low, high = (low, d) if score(k, c) <= score(k, d) else (c, high)
            power[k] = (low + high) / 2
    return [u * 10**p for u, p in zip(unit, power)]


def fit_smooth(train: DataFrame, covariates: list[str], label: str, family: str = "gaussian", tensor: bool = False,
               cells: int = 10, weight: str | None = None, ranges: list[tuple[float, float]] | None = None,
               smoothing: list[float] | None = None, most: int = 30) -> Model:
    """Fit s(x) (one covariate), s(a) + s(b) (two) or s(x, y) (two, ``tensor``).

    ``cells``: knot intervals per covariate.  ``weight``: rows that a row stands for.  ``ranges``: extent of the knots,
    by default that of the rows; rows outside it, or with a null or non-finite value, are left out.  ``smoothing``: given
    parameters instead of those of generalised cross-validation.  Without rows every coefficient is zero."""
    if family not in FAMILIES or not 1 <= len(covariates) <= 2 or (tensor and len(covariates) != 2):
        raise ValueError("one or two covariates and a family of " + ", ".join(FAMILIES))
    finite = F.lit(True)
    for c in [*covariates, label]:
        finite = finite & F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf"))
    rows = train.where(finite)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    if ranges is None:
        got = rows.agg(*[f(c).cast("double") for c in covariates for f in (F.min, F.max)]).first()
        ranges = [(got[2 * k] or 0.0, got[2 * k + 1] or 0.0) for k in range(len(covariates))]
    model = Model([Axis(c, float(lo), float(hi), cells) for c, (lo, hi) in zip(covariates, ranges)], tensor, family)
    model.beta = np.zeros(model.size)
    # Equal rows are one row with their number as its weight; every pass reads this table.
    placed = model._placed(rows).where(F.col("_cell").isNotNull()).groupBy(
        "_cell", "_u", "_v", F.col(label).cast("double").alias("_y")).agg(F.sum(w).alias("_w")).where("_w > 0")
    placed = written(placed, "smooth-rows")
    n = placed.agg(F.sum("_w")).first()[0]
    if not n:
        return model
    z = model.free
    penalties = [z.T @ p @ z for p in model.penalties]
    chosen, before = smoothing, None
    for t in range(1 if family == "gaussian" else most):
        first = t == 0
        a, b, zz, dev = _equations(placed if first else model._predictor(placed), model, first)
        a, b = z.T @ a @ z, z.T @ b
        if smoothing is None and t < 15:  # later passes keep the parameters, so that the iteration settles
            chosen = choose_smoothing(a, b, zz, n, penalties, chosen)
        gamma, model.edf, model.gcv = _solve(a, b, zz, n, penalties, chosen)
        moved = np.abs(z @ gamma - model.beta).max()
        model.beta, model.deviance, model.iterations = z @ gamma, dev, t + 1
        if not first and (moved < 1e-9 * max(1.0, np.abs(model.beta).max()) or (t > 15 and before is not None and abs(dev - before) <= 1e-12 * abs(dev))):
            break
        before = dev
    model.smoothing = tuple(chosen)
    return model
