"""Classifier scoring, metrics, splits, pixel indices and statistics
(R6, F24, F27, A8, A25-A32, J8, W1, X9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.functions.stats import argmax, softmax
from camstat.operators import aggregates as A
from camstat.operators import images as IM
from camstat.operators import joins as J
from camstat.operators import metrics as M
from camstat.operators import stats as ST
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

N_CLASSES, DIM = 10, 64
# class scores of a vector: inner product with the mean vector of each class
_MEANS_SQL = """
SELECT list(m ORDER BY label) AS means FROM (
  SELECT label, list(v ORDER BY i) AS m FROM (
    SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, range(1, 65) AS t(i) WHERE label IS NOT NULL
    GROUP BY label, i) x GROUP BY label) y"""
_SCORES_SQL = """
SELECT vec_id, label AS truth, list_position(s, list_max(s)) - 1 AS pred,
       1 / list_sum(list_transform(s, lambda x: exp(x - list_max(s)))) AS p_max
FROM (SELECT vec_id, label, list_transform(means, lambda m: list_inner_product(CAST(embedding AS DOUBLE[]), m)) AS s
      FROM embeddings, means) e"""


def class_scores(e, vector: str = "embedding", label: str = "label"):
    """Score array of every vector: inner products with the class means over the whole
    vector.  The means are a small table (classes x dimensions) found in one aggregation."""
    m = (e.filter(F.col(label).isNotNull()).select(label, F.posexplode(vector).alias("i", "v"))
         .groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
         .groupBy(label).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("m"))
         .select(label, F.transform("m", lambda x: x["m"]).alias("m")))
    means = [r["m"] for r in m.orderBy(label).collect()]  # classes x dimensions numbers

    def product(row):
        return F.aggregate(F.zip_with(vector, F.array(*[F.lit(x) for x in row]), lambda a, b: a * b),
                           F.lit(0.0), lambda acc, x: acc + x)

    return e.withColumn("s", F.array(*[product(row) for row in means]))


def _scores(spark, sf):
    e = class_scores(S.table(spark, sf, "embeddings").select("vec_id", "label", "embedding"))
    return e.select("vec_id", F.col("label").alias("truth"), argmax("s").alias("pred"), F.array_max(softmax("s")).alias("p_max"))


@register("vector_predictions", with_views([], "SELECT * FROM scores", {"means": _MEANS_SQL, "scores": _SCORES_SQL}))
def vector_predictions(spark, sf):
    """R6 + F24 + X15: class = arg-max of the class scores over the whole vector (ties ->
    first), softmax probability of the winner."""
    return _scores(spark, sf)


@register("confusion_matrix", with_views([], "SELECT truth, pred, count(*) AS n FROM scores GROUP BY truth, pred",
                                         {"means": _MEANS_SQL, "scores": _SCORES_SQL}))
def confusion_matrix(spark, sf):
    """A26."""
    return M.confusion(_scores(spark, sf))


@register("overall_accuracy", with_views([], """
SELECT avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM scores""",
    {"means": _MEANS_SQL, "scores": _SCORES_SQL}))
def overall_accuracy(spark, sf):
    """A27."""
    return M.accuracy(_scores(spark, sf))


@register("class_metrics", with_views([], """
WITH cm AS (SELECT truth, pred, count(*) AS n FROM scores GROUP BY truth, pred),
t AS (SELECT truth AS class, sum(n) AS n_true FROM cm GROUP BY truth),
p AS (SELECT pred AS class, sum(n) AS n_pred FROM cm GROUP BY pred),
tp AS (SELECT truth AS class, n AS tp FROM cm WHERE truth = pred),
m AS (SELECT coalesce(t.class, p.class) AS class, coalesce(t.n_true, 0) AS n_true, coalesce(p.n_pred, 0) AS n_pred,
             coalesce(tp.tp, 0) AS tp, (SELECT sum(n) FROM cm) AS nn
      FROM t FULL OUTER JOIN p ON t.class = p.class LEFT JOIN tp ON tp.class = coalesce(t.class, p.class)),
r AS (SELECT class, tp, n_pred - tp AS fp, n_true - tp AS fn, nn - n_pred - n_true + tp AS tn,
             CASE WHEN n_pred > 0 THEN tp * 1.0 / n_pred END AS precision,
             CASE WHEN n_true > 0 THEN tp * 1.0 / n_true END AS recall FROM m)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END AS f1 FROM r""",
    {"means": _MEANS_SQL, "scores": _SCORES_SQL}))
def class_metrics(spark, sf):
    """Per-class TP/FP/FN/TN, precision, recall, F1 over all classes."""
    return M.class_metrics(_scores(spark, sf))


@register("pred_vs_real", with_views([], """
SELECT p.class, p.n_pred, r.n_true FROM (SELECT pred AS class, count(*) AS n_pred FROM scores GROUP BY pred) p
JOIN (SELECT truth AS class, count(*) AS n_true FROM scores GROUP BY truth) r ON p.class = r.class""",
    {"means": _MEANS_SQL, "scores": _SCORES_SQL}))
def pred_vs_real(spark, sf):
    """Predicted vs true counts per class (inner join)."""
    s = _scores(spark, sf)
    return J.pred_vs_real(s.select(F.col("pred").alias("class")), s.select(F.col("truth").alias("class")))


@register("one_hot_labels", with_views([], "SELECT vec_id, " + ", ".join(
    f'CAST(label = {i} AS INTEGER) AS "{i}"' for i in range(N_CLASSES)) + " FROM embeddings"))
def one_hot_labels(spark, sf):
    """One-hot label columns over the fixed class list."""
    e = S.table(spark, sf, "embeddings").select("vec_id", "label")
    return A.one_hot(e, ["vec_id"], "label", list(range(N_CLASSES)))


_SPLIT_SQL = """
SELECT vec_id, label, CASE WHEN rn <= round(n * 0.25) THEN 'eval' ELSE 'train' END AS split FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY (vec_id * 2654435761 + 42) % 4294967296, vec_id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings) x"""


@register("stratified_split", with_views([], _SPLIT_SQL))
def stratified_split(spark, sf):
    """Seeded stratified 25 % hold-out per class."""
    e = S.table(spark, sf, "embeddings").select("vec_id", "label")
    return M.split_stratified(e, "label", "vec_id", 0.25, 42)


@register("split_balance", with_views([], """
WITH c AS (SELECT label, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'eval') AS eval
           FROM sp GROUP BY label)
SELECT label, train, eval, train * 1.0 / sum(train) OVER () AS train_share, eval * 1.0 / sum(eval) OVER () AS eval_share FROM c""",
    {"sp": _SPLIT_SQL}))
def split_balance(spark, sf):
    """Class counts and shares in train vs eval."""
    e = S.table(spark, sf, "embeddings").select("vec_id", "label")
    return A.split_balance(M.split_stratified(e, "label", "vec_id"), "label", "split")


N_PIXELS = 22  # of three values; the last one wraps around, so all 64 values are used
_PIX_SQL = f"""
SELECT vec_id, label, i AS pixel,
       least(255, greatest(0, floor((CAST(embedding[(3 * i + 0) % 64 + 1] AS DOUBLE) + 0.5) * 255))) AS r,
       least(255, greatest(0, floor((CAST(embedding[(3 * i + 1) % 64 + 1] AS DOUBLE) + 0.5) * 255))) AS g,
       least(255, greatest(0, floor((CAST(embedding[(3 * i + 2) % 64 + 1] AS DOUBLE) + 0.5) * 255))) AS b
FROM embeddings, range(0, {N_PIXELS}) AS t(i)"""


def _pixels(spark, sf):
    """Pixel rows derived from the embedding vectors: 22 RGB pixels of 3 values
    each (the last wraps around), mapped from [-0.5, 0.5] to 0..255."""
    e = S.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    p = e.select("vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0), F.lit(N_PIXELS - 1))).alias("pixel"))

    def ch(k):
        v = F.element_at("embedding", (F.col("pixel") * 3 + k - 1) % DIM + 1).cast("double")
        return F.least(F.lit(255), F.greatest(F.lit(0), F.floor((v + 0.5) * 255)))
    return p.select("vec_id", "label", "pixel", ch(1).alias("r"), ch(2).alias("g"), ch(3).alias("b"))


def _ci_sql():
    feats = {"r": "r", "g": "g", "b": "b", "bri": "(r + g + b)",
             "gi": "CASE WHEN r + g + b <> 0 THEN g * 1.0 / (r + g + b) END", "gei": "(2 * g - (r + b))",
             "ri": "CASE WHEN r + g + b <> 0 THEN r * 1.0 / (r + g + b) END",
             "bi": "CASE WHEN r + g + b <> 0 THEN b * 1.0 / (r + g + b) END"}
    cols = ", ".join(f"avg({e}) AS {k}_av, stddev_samp({e}) AS {k}_sd" for k, e in feats.items())
    return f"SELECT vec_id, {cols} FROM px GROUP BY vec_id"


@register("colour_indices", with_views([], _ci_sql(), {"px": _PIX_SQL}))
def colour_indices(spark, sf):
    """16 colour statistics per image (mean / sd of channels, brightness,
    chromatic shares, green excess)."""
    return IM.colour_indices(_pixels(spark, sf), ["vec_id"])


_HUE_SQL = """CASE WHEN greatest(r, g, b) - least(r, g, b) = 0 THEN 0.0
  WHEN greatest(r, g, b) = r THEN ((((g - b) / (greatest(r, g, b) - least(r, g, b))) % 6.0) + 6.0) % 6.0
  WHEN greatest(r, g, b) = g THEN (b - r) / (greatest(r, g, b) - least(r, g, b)) + 2
  ELSE (r - g) / (greatest(r, g, b) - least(r, g, b)) + 4 END * 60.0"""


GREENNESS_SQL = with_views([], f"""
SELECT vec_id, avg(h) AS hue_mean, avg(CASE WHEN h >= 125 AND h <= 175 THEN 1.0 ELSE 0.0 END) AS hue_green_share,
       sum(r) / (sum(g) + sum(b)) AS green_ratio_as_source, sum(g) / (sum(r) + sum(b)) AS green_ratio
FROM (SELECT vec_id, r, g, b, {_HUE_SQL} AS h
      FROM (SELECT vec_id, CAST(r AS DOUBLE) AS r, CAST(g AS DOUBLE) AS g, CAST(b AS DOUBLE) AS b FROM px) q) x
GROUP BY vec_id""", {"px": _PIX_SQL})


@register("greenness", GREENNESS_SQL)
def greenness(spark, sf):
    """A30 + F27: mean hue, share of green hues, green ratio (as written and corrected)."""
    return IM.greenness(_pixels(spark, sf), ["vec_id"])


@register("index_correlations", with_views([], """
SELECT a, b, r FROM (
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM ci"
    for i, a in enumerate(IM.INDEX_COLUMNS) for b in IM.INDEX_COLUMNS[i + 1:]) + ") x",
    {"px": _PIX_SQL, "ci": _ci_sql()}))
def index_correlations(spark, sf):
    """Correlation matrix of the colour indices (long form)."""
    ci = IM.colour_indices(_pixels(spark, sf), ["vec_id"])
    return ST.correlations(ci, IM.INDEX_COLUMNS)


@register("value_anova", with_views([], """
WITH g AS (SELECT event_type, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY event_type),
gm AS (SELECT sum(n * m) / sum(n) AS grand FROM g)
SELECT sum(n * power(m - grand, 2)) AS ssb, sum((n - 1) * coalesce(v, 0.0)) AS ssw, count(*) - 1 AS df_between,
       sum(n) - count(*) AS df_within,
       (sum(n * power(m - grand, 2)) / (count(*) - 1)) / (sum((n - 1) * coalesce(v, 0.0)) / (sum(n) - count(*))) AS f
FROM g, gm"""))
def value_anova(spark, sf):
    """One-way ANOVA of event value across event types."""
    return ST.anova(S.table(spark, sf, "events"), "value", "event_type")


@register("index_anova", with_views([], """
WITH long AS (SELECT c.vec_id, e.label % 2 AS status, u.name, u.value
              FROM ci c JOIN embeddings e ON c.vec_id = e.vec_id,
              LATERAL (VALUES ('r_av', c.r_av), ('g_av', c.g_av), ('b_av', c.b_av), ('gi_av', c.gi_av)) AS u(name, value)),
g AS (SELECT name, status, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM long GROUP BY name, status),
gm AS (SELECT name, sum(n * m) / sum(n) AS grand FROM g GROUP BY name)
SELECT g.name, sum(n * power(m - grand, 2)) AS ssb, sum((n - 1) * coalesce(v, 0.0)) AS ssw, count(*) - 1 AS df_between,
       sum(n) - count(*) AS df_within,
       (sum(n * power(m - grand, 2)) / (count(*) - 1)) / (sum((n - 1) * coalesce(v, 0.0)) / (sum(n) - count(*))) AS f
FROM g JOIN gm ON g.name = gm.name GROUP BY g.name""", {"px": _PIX_SQL, "ci": _ci_sql()}))
def index_anova(spark, sf):
    """A32 + R2 + R5: ANOVA of four colour indices across an image status, one
    test per index (long form split by index)."""
    from camstat.operators.reshape import unpivot
    ci = IM.colour_indices(_pixels(spark, sf), ["vec_id"])
    st = S.table(spark, sf, "embeddings").select("vec_id", (F.col("label") % 2).alias("status"))
    long = unpivot(ci.join(st, "vec_id", "inner"), ["vec_id", "status"], ["r_av", "g_av", "b_av", "gi_av"], "name", "value")
    return ST.anova(long, "value", "status", by=["name"])
