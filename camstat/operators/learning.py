"""Ordination, clustering and models.

Heavy passes are Spark aggregations or MLlib estimators; only small matrices
(p x p Gram matrices, q x q covariances, model coefficients) reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _moments(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """n, column sums and the cross-product matrix of ``cols`` in one aggregation."""
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    r = df.agg(*aggs).first()
    s = np.array([r[f"s{i}"] or 0.0 for i in range(k)], dtype=float)
    P = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            P[i, j] = P[j, i] = r[f"p{i}_{j}"] or 0.0
    return int(r["n"]), s, P


def rda(wide: DataFrame, key: str, y_cols: list[str], x_cols: list[str], n_axes: int = 2
        ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Redundancy analysis of responses ``y_cols`` on predictors ``x_cols``
    (one row per site).  Returns ``(axes, species_scores, site_scores, predictor_scores)``:
    eigenvalues with R^2 / adjusted R^2; species scores and linear-combination site scores in
    scaling 2 (species scaled by the axis' share of the inertia); predictor (biplot) scores,
    the correlation of a predictor with the site scores.  An axis points to the side of
    its largest absolute species loading (ties: the first species).  Moments come from one
    Spark pass; the least-squares fit and eigen-decomposition run on the small matrices."""
    cols = x_cols + y_cols
    n, s, P = _moments(wide, cols)
    mean = s / n
    C = (P - n * np.outer(mean, mean)) / (n - 1)
    p = len(x_cols)
    Sxx, Sxy, Syy = C[:p, :p], C[:p, p:], C[p:, p:]
    Sxx_inv = np.linalg.pinv(Sxx)
    B = Sxx_inv @ Sxy                       # regression coefficients (p x q)
    fitted_cov = Sxy.T @ B                  # q x q covariance of fitted values
    evals, evecs = np.linalg.eigh(fitted_cov)
    order = np.argsort(evals)[::-1]
    evals, evecs = np.clip(evals[order], 0, None), evecs[:, order]
    total = float(np.trace(Syy))
    r2 = float(np.trace(fitted_cov) / total) if total > 0 else 0.0
    rank = int(np.linalg.matrix_rank(Sxx))
    adj = 1 - (1 - r2) * (n - 1) / (n - rank - 1) if n - rank - 1 > 0 else float("nan")
    spark = wide.sparkSession
    m = min(n_axes, len(y_cols))
    evecs = evecs[:, :m]
    top = np.abs(evecs).round(9).argmax(axis=0)
    evecs = evecs * np.where(evecs[top, np.arange(m)] < 0, -1.0, 1.0)
    share = np.sqrt(evals[:m] / total) if total > 0 else np.zeros(m)
    const = ((n - 1) * total) ** 0.25
    axes = spark.createDataFrame(
        [(i + 1, float(evals[i]), float(evals[i] / total) if total > 0 else 0.0, r2, adj) for i in range(m)],
        "axis int, eigenvalue double, prop_explained double, r2 double, adj_r2 double")
    fields = ", ".join(f"rda{i + 1} double" for i in range(m))
    sp = spark.createDataFrame([(y, *[float(evecs[j, i] * share[i] * const) for i in range(m)]) for j, y in enumerate(y_cols)],
                               "species string, " + fields)
    # site scores: centred X times B times the axis vectors, each axis to unit sum of squares
    W = B @ evecs                           # p x m
    norm = np.sqrt((n - 1) * evals[:m])
    scale = np.divide(const, norm, out=np.zeros(m), where=norm > 0)
    site_cols = []
    for a in range(m):
        e = F.lit(0.0)
        for i, x in enumerate(x_cols):
            e = e + (F.col(x) - F.lit(float(mean[i]))) * F.lit(float(W[i, a] * scale[a]))
        site_cols.append(e.alias(f"rda{a + 1}"))
    sites = wide.select(key, *site_cols)
    spread = np.sqrt(np.outer(np.diag(Sxx), evals[:m]))
    biplot = np.divide(Sxx @ W, spread, out=np.zeros((p, m)), where=spread > 0)
    predictors = spark.createDataFrame([(x, *[float(v) for v in biplot[i]]) for i, x in enumerate(x_cols)], "predictor string, " + fields)
    return axes, sp, sites, predictors


def label_scores(scores: DataFrame, cols: list[str], threshold: float, name: str = "species", scale: float = 1.0) -> DataFrame:
    """Keep labels for rows whose score times ``scale`` (the plotted score) exceeds
    ``threshold`` on any axis."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.abs(F.col(c) * scale) > threshold)
    return scores.withColumn("label", F.when(cond, F.col(name)))


def _assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def cluster_sites(wide: DataFrame, key: str, cols: list[str], k: int = 2, seed: int = 42) -> DataFrame:
    """Site groups by bisecting k-means on the (Hellinger) feature columns --
    a distributed stand-in for Ward's minimum-variance linkage."""
    f = _assemble(wide.fillna(0.0, subset=cols), cols)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(f)
    return model.transform(f).select(key, "cluster")


def cluster_geo(wide: DataFrame, key: str, cols: list[str], xy: list[str], alpha: float = 0.1,
                k: int = 4, seed: int = 42) -> DataFrame:
    """Spatially constrained clustering.  Feature and coordinate blocks are
    each scaled by their largest absolute value and weighted ``sqrt(1-alpha)`` /
    ``sqrt(alpha)``, so squared distance = (1-alpha) d_feat^2 + alpha d_geo^2."""
    w = wide.fillna(0.0, subset=cols + xy)
    mx = w.agg(F.greatest(*[F.max(F.abs(c)) for c in cols]).alias("f"),
               F.greatest(*[F.max(F.abs(c)) for c in xy]).alias("g")).first()
    fs = float(mx["f"] or 1.0) or 1.0
    gs = float(mx["g"] or 1.0) or 1.0
    a, b = float(np.sqrt(1 - alpha)) / fs, float(np.sqrt(alpha)) / gs
    scaled = w.select(key, *[(F.col(c) * a).alias(f"_f_{c}") for c in cols],
                      *[(F.col(c) * b).alias(f"_g_{c}") for c in xy])
    feats = [f"_f_{c}" for c in cols] + [f"_g_{c}" for c in xy]
    f = _assemble(scaled, feats)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(f)
    return model.transform(f).select(key, "cluster")


def poly_features(df: DataFrame, x: str, y: str, degree: int = 3) -> tuple[DataFrame, list[str]]:
    """Polynomial surface terms x^i y^j (1 <= i + j <= degree) of centred inputs."""
    names = []
    out = df
    for i in range(degree + 1):
        for j in range(degree + 1 - i):
            if i + j == 0:
                continue
            n = f"_x{i}y{j}"
            out = out.withColumn(n, F.pow(F.col(x), i) * F.pow(F.col(y), j))
            names.append(n)
    return out, names


def smooth_fit(train: DataFrame, grid: DataFrame, x: str, y: str, label: str, family: str = "poisson",
               degree: int = 3, weight: str | None = None) -> DataFrame:
    """Smooth surface of counts (or a binary outcome) over (x, y) by a GLM on
    polynomial terms; predictions on ``grid``.  ``weight``: rows a training row stands for."""
    t, names = poly_features(train, x, y, degree)
    g, _ = poly_features(grid, x, y, degree)
    link = "log" if family == "poisson" else "logit"
    glm = GeneralizedLinearRegression(family=family, link=link, labelCol=label, featuresCol="features",
                                      maxIter=50, regParam=1e-6)
    if weight:
        glm = glm.setWeightCol(weight)
    model = glm.fit(_assemble(t, names))
    return model.transform(_assemble(g, names)).drop("features", *names)


#: Rows in a partition of a table that trees are grown on.
TREE_ROWS = 50_000


def tune_forest(train: DataFrame, features: list[str], label: str, trees=(50,), min_nodes=(1, 5),
                mtry=("sqrt", "onethird"), fold: str = "fold", folds: int = 10, seed: int = 42):
    """Random forest tuned over features-per-split x minimum node size by
    cross-validation on the folds of column ``fold`` (X9), best by area under the ROC curve."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.minInstancesPerNode, list(min_nodes))
            .addGrid(rf.featureSubsetStrategy, list(mtry)).build())
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), rf])
    # Every level of every tree is a job over all partitions: their number follows the rows, not the files.
    sized = train.coalesce(max(1, -(-train.count() // TREE_ROWS)))
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=8, foldCol=fold)
    return cv.fit(sized)


def last_fit(model, test: DataFrame, label: str) -> tuple[DataFrame, dict]:
    """Score the held-out split; AUC, accuracy and a per-row correctness flag."""
    pred = model.transform(test)
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(pred)
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(pred)
    out = pred.withColumn("correct", F.col("prediction") == F.col(label).cast("double"))
    return out, {"auc": auc, "accuracy": acc}


def perm_importance(model, df: DataFrame, features: list[str], label: str, key: str, seed: int = 7
                    ) -> DataFrame:
    """X11: drop in AUC when one feature is shuffled.  Every row is paired once with another
    row by two seeded orderings (range-partitioned sequence numbers, no single-task sort);
    each feature in turn then takes the other row's value."""
    from camstat.operators.windows import seq_id
    from camstat.session import written
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    a = seq_id(df.withColumn("_h1", F.xxhash64(F.col(key), F.lit(seed))), ["_h1", key], out="_r")
    b = seq_id(df.select(key, *features).withColumn("_h2", F.xxhash64(F.col(key), F.lit(seed + 1))), ["_h2", key], out="_r2")
    paired = written(a.join(b.select("_r2", *[F.col(f).alias(f"_perm_{f}") for f in features]), F.col("_r") == F.col("_r2"))
                     .drop("_h1", "_r", "_r2"), "permuted")
    base = ev.evaluate(model.transform(paired))
    rows = [(f, base, base - ev.evaluate(model.transform(paired.withColumn(f, F.col(f"_perm_{f}"))))) for f in features]
    return df.sparkSession.createDataFrame(rows, "feature string, auc double, importance double")


def tree_fit(train: DataFrame, features: list[str], label: str, max_depth: int = 5, seed: int = 42):
    """Decision tree classifier."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"),
                            DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth,
                                                   seed=seed)])
    return pipe.fit(train)


def train_head(train: DataFrame, vec: str, label: str, n_classes: int, hidden: int | None = None,
               max_iter: int = 100, seed: int = 42):
    """Classifier head on fixed feature vectors (array column): multinomial
    logistic regression, or a one-hidden-layer perceptron when ``hidden`` is set."""
    t = train.withColumn("features", array_to_vector(F.col(vec)))
    if hidden:
        dim = len(t.select(vec).first()[0])
        est = MultilayerPerceptronClassifier(layers=[dim, hidden, n_classes], labelCol=label, maxIter=max_iter,
                                             seed=seed)
    else:
        est = LogisticRegression(labelCol=label, maxIter=max_iter, family="multinomial")
    return est.fit(t)


def score(model, df: DataFrame, vec: str, key: str) -> DataFrame:
    """Batch scoring to ``(key, prediction, class scores array)``."""
    out = model.transform(df.withColumn("features", array_to_vector(F.col(vec))))
    return out.select(key, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("scores"))
