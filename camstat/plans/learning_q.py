"""Model-based queries (rows-only checks): ordination, clustering, surfaces,
forests, trees, permutation importance, classifier head (X1, X2, X5, X6, X8,
X10-X15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import learning as L
from camstat.operators import metrics as M
from camstat.operators import spatial as SP
from camstat.plans import classify_q as C
from camstat.plans import spatial_q as SQ
from camstat.plans.registry import register
from camstat.session import written
from camstat.sources import adapters as S

COVER_CLASSES = ["WAT", "MixTRE", "ConTRE", "Dist", "SWA", "Anth"]


def _site_table(spark, sf):
    """One row per camera: Hellinger species profile + merged land-cover shares."""
    ev = SP.hellinger(A.day_events(S.observations(spark, sf)), "camera_id", "species", "day_count")
    y = A.pivot_wide(ev, "camera_id", "species", "hellinger", S.OBS_SPECIES)
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    cover = SP.cover_props(SQ._cam_cells(spark, sf, {"n": F.count("*")}, ["value"]), SQ._legend(spark))
    from camstat.operators.filters import merge_classes
    cover = merge_classes(cover, SQ.MERGES, ["camera_id"], "category_code", "props")
    x = A.pivot_wide(cover, "camera_id", "category_code", "props", COVER_CLASSES)
    # models pass over the sites many times: the joins above are done once
    return written(y.join(x, "camera_id", "inner").join(cams, "camera_id", "inner"), "sites")


@register("rda_axes")
def rda_axes(spark, sf):
    """RDA of Hellinger day-events on land cover: eigenvalues, R^2, adjusted R^2."""
    return L.rda(_site_table(spark, sf), "camera_id", S.OBS_SPECIES, COVER_CLASSES)[0]


@register("rda_species_labels")
def rda_species_labels(spark, sf):
    """X1 + X2: species scores (scaling 2), labelled where the plotted score passes 0.4."""
    sp = L.rda(_site_table(spark, sf), "camera_id", S.OBS_SPECIES, COVER_CLASSES)[1]
    return L.label_scores(sp, ["rda1", "rda2"], 0.4, scale=2.3)


@register("rda_predictor_scores")
def rda_predictor_scores(spark, sf):
    """Biplot scores of the land-cover classes."""
    return L.rda(_site_table(spark, sf), "camera_id", S.OBS_SPECIES, COVER_CLASSES)[3]


@register("rda_site_clusters")
def rda_site_clusters(spark, sf):
    """X1 + X2 + X5: site scores joined to their Ward-style cluster."""
    site = _site_table(spark, sf)
    sites = L.rda(site, "camera_id", S.OBS_SPECIES, COVER_CLASSES)[2]
    cl = L.cluster_sites(site, "camera_id", S.OBS_SPECIES, k=2)
    return sites.join(cl, "camera_id", "left")


@register("geo_clusters")
def geo_clusters(spark, sf):
    """Spatially constrained clusters (alpha 0.1, k 4); sites per cluster."""
    site = _site_table(spark, sf)
    cl = L.cluster_geo(site, "camera_id", S.OBS_SPECIES, ["lon", "lat"], alpha=0.1, k=4)
    return cl.groupBy("cluster").agg(F.count("*").alias("n_sites"))


@register("count_surface")
def count_surface(spark, sf):
    """X8 + U7: Poisson GLM surface of observation counts on a 0.5 degree grid; cameras without
    observations count as 0."""
    obs = S.observations(spark, sf).groupBy("camera_id").agg(F.count("*").alias("n"))
    cams = S.cameras(spark, sf).select("camera_id", "lon", "lat")
    t = cams.join(obs, "camera_id", "left").select(
        (F.col("lon") + 86.5).alias("cx"), (F.col("lat") - 52.75).alias("cy"), F.coalesce("n", F.lit(0)).cast("double").alias("n"))
    from camstat.operators.reshape import grid
    g = grid(spark, -90.0, -83.0, 50.0, 55.5, 0.5).select("gx", "gy", (F.col("x") + 86.5).alias("cx"),
                                                           (F.col("y") - 52.75).alias("cy"))
    return L.smooth_fit(t, g, "cx", "cy", "n", "poisson", 2).select("gx", "gy", F.col("prediction").alias("expected"))


@register("tp_surface")
def tp_surface(spark, sf):
    """X8 binomial: share of true positives over box width and height, predicted for every size
    that occurs; boxes of one size are counted first and weighted."""
    b = S.boxes(spark, sf).groupBy("w", "h", F.col("species").isNotNull().cast("double").alias("is_tp")).agg(
        F.count("*").cast("double").alias("n"))
    t = b.withColumns({"cx": (F.col("w") - 6) / 5, "cy": (F.col("h") - 5) / 4})
    g = t.groupBy("w", "h", "cx", "cy").agg((F.sum(F.col("n") * F.col("is_tp")) / F.sum("n")).alias("observed"))
    return L.smooth_fit(t, g, "cx", "cy", "is_tp", "binomial", 2, weight="n").select(
        "w", "h", "observed", F.col("prediction").alias("expected"))


def _status_table(spark, sf):
    from camstat.operators import images as IM
    from camstat.session import written
    ci = IM.colour_indices(C._pixels(spark, sf), ["vec_id"])
    st = S.table(spark, sf, "embeddings").select("vec_id", (F.col("label") % 2).cast("double").alias("status"))
    # model fits read this many times: written once instead of cached, so nothing stays in memory
    return written(M.folds(ci.join(st, "vec_id", "inner"), "vec_id", 10), "status")


FEATURES = ["r_av", "g_av", "b_av", "gi_av", "bri_sd", "gei_av"]


@register("forest_status")
def forest_status(spark, sf):
    """X9 + X10 + X12: random forest on colour indices tuned over ten folds, held-out metrics
    and per-row correctness counts."""
    t = M.split_stratified(_status_table(spark, sf), "status", "vec_id", 0.25, 42)
    train, test = t.filter(F.col("split") == "train"), t.filter(F.col("split") == "eval")
    cv = L.tune_forest(train, FEATURES, "status")
    pred, m = L.last_fit(cv.bestModel, test, "status")
    return (pred.groupBy("status", "correct").agg(F.count("*").alias("n"))
            .withColumns({"auc": F.lit(m["auc"]), "accuracy": F.lit(m["accuracy"])}))


@register("tree_status")
def tree_status(spark, sf):
    """Decision tree of the status on time of day and green share, scored on held-out rows;
    predicted vs true counts."""
    from camstat.functions.timefn import seconds_of_day
    times = S.table(spark, sf, "events").select(F.col("event_id").alias("vec_id"), seconds_of_day("ts").alias("time_of_day"))
    t = M.split_stratified(_status_table(spark, sf).join(times, "vec_id").filter(F.col("status").isNotNull()), "status", "vec_id", 0.25, 42)
    model = L.tree_fit(t.filter(F.col("split") == "train"), ["time_of_day", "gi_av"], "status")
    return model.transform(t.filter(F.col("split") == "eval")).groupBy("status", "prediction").agg(F.count("*").alias("n"))


@register("permutation_importance")
def permutation_importance(spark, sf):
    """X11: AUC drop per shuffled feature for a forest on colour indices tuned over ten folds."""
    t = _status_table(spark, sf)
    cv = L.tune_forest(t, FEATURES, "status")
    return L.perm_importance(cv.bestModel, t, FEATURES, "status", "vec_id")


@register("head_classifier_scores")
def head_classifier_scores(spark, sf):
    """X14 + X15: logistic-regression head on embedding vectors; held-out scores
    summarised as accuracy per class."""
    e = M.split_stratified(S.table(spark, sf, "embeddings"), "label", "vec_id", 0.25, 42)
    model = L.train_head(e.filter(F.col("split") == "train"), "embedding", "label", 10)
    s = L.score(model, e.filter(F.col("split") == "eval"), "embedding", "vec_id")
    s = s.join(e.select("vec_id", "label"), "vec_id", "inner")
    return s.groupBy("label").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                                  F.count("*").alias("n"), F.avg(F.array_max("scores")).alias("mean_top_score"))


@register("rda_presence_axes")
def rda_presence_axes(spark, sf):
    """X1 presence variant: RDA of the untransformed 0/1 presence table on land
    cover (the presence ordination is fitted on the raw table)."""
    pa = A.pivot_wide(A.presence_absence(S.observations(spark, sf)), "camera_id", "species", "present",
                      S.OBS_SPECIES)
    site = _site_table(spark, sf).drop(*S.OBS_SPECIES).join(pa, "camera_id", "inner")
    return L.rda(site.select("camera_id", *[F.col(c).cast("double") for c in S.OBS_SPECIES], *COVER_CLASSES),
                 "camera_id", S.OBS_SPECIES, COVER_CLASSES)[0]
