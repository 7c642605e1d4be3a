"""Remaining inventory items as queries: value patch, two-key EXIF join,
two-raster fallback, first capture per camera, JSON properties, formatted
counts (O15, J1, Q1, J13, A12, F13, F28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.functions import textfn as X
from camstat.functions import timefn as Tm
from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import joins as J
from camstat.plans import classify_q as CQ
from camstat.plans import spatial_q as SQ
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

WRONG_YEAR, RIGHT_YEAR = 2001, 2000


@register("patched_dates", with_views(["long_observations"], f"""
SELECT obs_id, strftime(d, '%Y-%m-%d %H:%M:%S') AS date_time, year(d) AS year, strftime(d, '%b') AS month,
       dayofmonth(d) AS day, concat_ws('_', year(d), strftime(d, '%b'), dayofmonth(d)) AS ymd
FROM (SELECT obs_id, CASE WHEN year = {WRONG_YEAR} THEN date_time - INTERVAL 1 YEAR ELSE date_time END AS d
      FROM long_observations) o"""))
def patched_dates(spark, sf):
    """A wrong-year repair (one year back for the flagged year) with every
    derived date key recomputed after the patch."""
    o = S.long_observations(spark, sf)
    o = O.patch(o, F.col("year") == WRONG_YEAR, {"date_time": F.add_months(F.col("date_time"), -12)})
    o = Tm.with_date_keys(o.drop("year", "month", "day", "ymd"), "date_time")
    return o.select("obs_id", "date_time", "year", "month", "day", "ymd")


_EXIF_SQL = """
SELECT 'img_' || CAST(o_orderkey AS VARCHAR) || '.JPG' AS source_file, CAST(o_orderkey AS VARCHAR) AS image_id,
       strftime(o_orderdate, '%Y:%m:%d %H:%M:%S') AS exif_date_time_original, CAST(o_custkey AS VARCHAR) AS maker_notes_user_label
FROM orders"""


def _exif(spark, sf):
    o = S.table(spark, sf, "orders")
    return o.select(F.concat(F.lit("img_"), F.col("o_orderkey").cast("string"), F.lit(".JPG")).alias("source_file"),
                    F.col("o_orderkey").cast("string").alias("image_id"),
                    F.date_format("o_orderdate", "yyyy:MM:dd HH:mm:ss").alias("exif_date_time_original"),
                    F.col("o_custkey").cast("string").alias("maker_notes_user_label"))


@register("boxes_with_capture_time", with_views(["boxes"], """
SELECT b.box_id, e.exif_date_time_original, e.maker_notes_user_label AS camera
FROM (SELECT box_id, 'img_' || CAST(image_id AS VARCHAR) || '.JPG' AS source_file, CAST(image_id AS VARCHAR) AS image_id
      FROM boxes) b
LEFT JOIN (SELECT DISTINCT * FROM exif) e ON b.source_file = e.source_file AND b.image_id = e.image_id""",
    {"exif": _EXIF_SQL}))
def boxes_with_capture_time(spark, sf):
    """Boxes left-joined to EXIF rows on (source_file, image_id); the right
    side is de-duplicated so the row count is conserved (Q1)."""
    b = S.boxes(spark, sf).select(
        "box_id", F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".JPG")).alias("source_file"),
        F.col("image_id").cast("string").alias("image_id"))
    j = J.join_exif(b, _exif(spark, sf))
    return j.select("box_id", "exif_date_time_original", F.col("maker_notes_user_label").alias("camera"))


@register("camera_first_capture", with_views([], """
SELECT maker_notes_user_label AS camera_id,
       strftime(min(strptime(exif_date_time_original, '%Y:%m:%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS camera_first_day
FROM exif GROUP BY maker_notes_user_label""", {"exif": _EXIF_SQL}))
def camera_first_capture(spark, sf):
    """A12 + F14: first capture time per camera from EXIF text (parse, then min)."""
    return A.camera_first_day(_exif(spark, sf))


def _utm_sql(z):
    return f"""
SELECT camera_id, count(*) AS n_cells, avg(coverage_fraction) AS mean_cover FROM ({SQ._pairs_sql(f"l.utm = {z}")}) p
GROUP BY camera_id"""


@register("cover_two_rasters", with_views(["cameras", "cells"], """
SELECT coalesce(a.camera_id, b.camera_id) AS camera_id,
       CASE WHEN a.n_cells IS NULL AND a.mean_cover IS NULL THEN b.n_cells ELSE a.n_cells END AS n_cells,
       CASE WHEN a.n_cells IS NULL AND a.mean_cover IS NULL THEN b.mean_cover ELSE a.mean_cover END AS mean_cover
FROM z16 a FULL OUTER JOIN z17 b ON a.camera_id = b.camera_id""", {"z16": _utm_sql(16), "z17": _utm_sql(17)}))
def cover_two_rasters(spark, sf):
    """Per camera, the zone-16 raster summary, falling back to zone 17 where
    zone 16 has nothing."""
    # one radius join for both rasters: sums per camera and zone, then the fallback
    per = SQ._cam_cells(spark, sf, {"n_cells": F.count("*"), "cover": F.sum("coverage_fraction")}, ["utm"])
    per = per.select("camera_id", "utm", "n_cells", (F.col("cover") / F.col("n_cells")).alias("mean_cover"))
    best = F.min_by(F.struct("n_cells", "mean_cover"), "utm")  # 16 where it has cells, else 17
    return per.groupBy("camera_id").agg(best.alias("_b")).select("camera_id", "_b.n_cells", "_b.mean_cover")


@register("event_props", with_views([], """
SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_sum,
       count(*) FILTER (WHERE json_extract(props, '$.k') IS NULL) AS n_missing,
       to_json({'type': event_type, 'n': count(*)}) AS summary
FROM events GROUP BY event_type"""))
def event_props(spark, sf):
    """JSON properties parsed with a schema, summed, and a JSON summary written."""
    e = S.table(spark, sf, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    g = e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("k_sum"),
                                    F.count_if(F.col("p.k").isNull()).alias("n_missing"))
    return g.withColumn("summary", F.to_json(F.struct(F.col("event_type").alias("type"), "n")))


@register("progress_formatted", with_views(["boxes"], f"""
SELECT status, format('{{:,}}', images) AS images_fmt FROM (
SELECT 'Total' AS status, count(DISTINCT image_id) AS images FROM boxes
UNION ALL SELECT 'Filtered', count(DISTINCT image_id) FROM boxes WHERE confidence > 0.1
UNION ALL SELECT 'Processed', count(DISTINCT image_id) FROM boxes WHERE confidence > 0.1) t"""))
def progress_formatted(spark, sf):
    """progress counts with thousands separators."""
    b = S.boxes(spark, sf)
    t = A.progress_table(b, O.above(b, 0.1), 0.1).filter(F.col("status").isin("Total", "Filtered", "Processed"))
    return t.select("status", X.thousands("images").alias("images_fmt"))


_OVERLAY_SQL = """
WITH base AS (SELECT l_orderkey AS image, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey),
upd AS (SELECT l_orderkey AS image, count(*) FILTER (WHERE l_returnflag <> 'R') AS n FROM lineitem
        WHERE l_linestatus = 'O' GROUP BY l_orderkey)
SELECT coalesce(b.image, u.image) AS image, CASE WHEN u.image IS NOT NULL THEN u.n ELSE b.n END AS n_annotations,
       u.image IS NOT NULL AS from_update
FROM base b FULL OUTER JOIN upd u ON b.image = u.image
WHERE b.image IS NOT NULL OR (u.image IS NOT NULL AND u.n > 0)"""


@register("annotation_overlay", with_views([], _OVERLAY_SQL))
def annotation_overlay(spark, sf):
    """An update export replaces base annotations per image; images only in
    the update are added when they carry annotations (as counts per image)."""
    li = S.table(spark, sf, "lineitem")
    base = (li.filter(F.col("l_linestatus") == "F")
            .groupBy(F.col("l_orderkey").alias("image")).agg(F.count("*").alias("n_annotations")))
    upd = (li.filter(F.col("l_linestatus") == "O")
           .groupBy(F.col("l_orderkey").alias("image")).agg(F.count_if(F.col("l_returnflag") != "R").alias("n_annotations")))
    return J.overlay_annotations(base, upd, "image", "n_annotations")


@register("conversation_bursts", with_views([], """
WITH c AS (SELECT conv_id, turn, length(text) / 2000.0 AS confidence FROM conversations),
b AS (SELECT conv_id, max(confidence) AS burst_max_conf FROM c GROUP BY conv_id HAVING max(confidence) > 0.5)
SELECT c.conv_id, c.turn, c.confidence, b.burst_max_conf FROM c JOIN b ON c.conv_id = b.conv_id"""))
def conversation_bursts(spark, sf):
    """W7 with given burst ids: every turn (image) of a conversation (burst) whose
    longest turn passes the threshold."""
    from camstat.operators import windows as W
    c = S.table(spark, sf, "conversations").select("conv_id", "turn", (F.length("text") / 2000.0).alias("confidence"))
    return W.expand_bursts(c, [], "turn", 0.5, burst="conv_id").select("conv_id", "turn", "confidence", "burst_max_conf")


@register("label_metrics", with_views([], """
WITH cm AS (SELECT quality AS truth, toxic AS pred, count(*) AS n FROM labels GROUP BY quality, toxic),
t AS (SELECT truth AS class, sum(n) AS n_true FROM cm GROUP BY truth),
p AS (SELECT pred AS class, sum(n) AS n_pred FROM cm GROUP BY pred),
tp AS (SELECT truth AS class, n AS tp FROM cm WHERE truth = pred),
m AS (SELECT coalesce(t.class, p.class) AS class, coalesce(t.n_true, 0) AS n_true, coalesce(p.n_pred, 0) AS n_pred,
             coalesce(tp.tp, 0) AS tp, (SELECT sum(n) FROM cm) AS nn
      FROM t FULL OUTER JOIN p ON t.class = p.class LEFT JOIN tp ON tp.class = coalesce(t.class, p.class)),
r AS (SELECT class, tp, n_pred - tp AS fp, n_true - tp AS fn, nn - n_pred - n_true + tp AS tn,
             CASE WHEN n_pred > 0 THEN tp * 1.0 / n_pred END AS precision,
             CASE WHEN n_true > 0 THEN tp * 1.0 / n_true END AS recall FROM m)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END AS f1 FROM r"""))
def label_metrics(spark, sf):
    """A28 on the label table (truth = quality, prediction = toxic)."""
    from camstat.operators import metrics as M
    lab = S.table(spark, sf, "labels").select(F.col("quality").alias("truth"), F.col("toxic").alias("pred"))
    return M.class_metrics(lab)


@register("prediction_correctness", with_views([], """
SELECT truth, count(*) AS n, count(*) FILTER (WHERE pred = truth) AS n_correct FROM scores GROUP BY truth""",
    {"means": CQ._MEANS_SQL, "scores": CQ._SCORES_SQL}))
def prediction_correctness(spark, sf):
    """Correctness flag (true class equals predicted) counted per class."""
    e = O.flag_correct(CQ._scores(spark, sf), "truth", "pred")
    return e.groupBy("truth").agg(F.count("*").alias("n"), F.count_if("correct").alias("n_correct"))


# fixed values: one species vocabulary for the two tagging platforms
PLATFORM_SPECIES = {"1-URGENT": "click", "2-HIGH": "error", "3-MEDIUM": "purchase", "4-NOT SPECIFIED": "signup", "5-LOW": "view"}
_VOCAB_SQL = "CASE species " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PLATFORM_SPECIES.items()) + " END"


@register("platform_comparison", with_views(["observations", "long_observations", "deployments"], f"""
WITH p1 AS (SELECT DISTINCT o.plot_id, o.species, o.image_id FROM observations o JOIN deployments d ON o.camera_id = d.camera_id),
p2 AS (SELECT DISTINCT o.plot_id, {_VOCAB_SQL} AS species, o.obs_id AS image_id FROM long_observations o
       JOIN deployments d ON o.camera_id = d.camera_id),
a AS (SELECT plot_id, species, count(*) AS n_a FROM p1 GROUP BY plot_id, species),
b AS (SELECT plot_id, species, count(*) AS n_b FROM p2 GROUP BY plot_id, species)
SELECT coalesce(a.plot_id, b.plot_id) AS plot_id, coalesce(a.species, b.species) AS species,
       coalesce(a.n_a, 0) AS n_a, coalesce(b.n_b, 0) AS n_b, coalesce(a.n_a, 0) - coalesce(b.n_b, 0) AS diff
FROM a FULL OUTER JOIN b ON a.plot_id = b.plot_id AND a.species = b.species"""))
def platform_comparison(spark, sf):
    """Images per plot and species in two tagging systems with one vocabulary, at
    cameras that have a deployment, full outer joined."""
    names = F.create_map(*[F.lit(x) for kv in PLATFORM_SPECIES.items() for x in kv])
    dep = S.deployments(spark, sf).select("camera_id")
    a = J.semi(S.observations(spark, sf), dep, "camera_id")
    b = J.semi(S.long_observations(spark, sf), dep, "camera_id").select(
        "plot_id", names[F.col("species")].alias("species"), F.col("obs_id").cast("string").alias("image_id"))
    return J.compare_platforms(a, b, ["plot_id"])


@register("wide_score_argmax", with_views([], """
SELECT vec_id, 's' || CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR) AS pred
FROM embeddings"""))
def wide_score_argmax(spark, sf):
    """R6 + R2: a wide score table (one column per dimension) to the name of its
    best column, ties to the first column."""
    from camstat.operators.reshape import rowwise_argmax
    e = S.table(spark, sf, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].alias(f"s{i}") for i in range(CQ.DIM)])
    return rowwise_argmax(wide, [f"s{i}" for i in range(CQ.DIM)]).select("vec_id", "pred")


def _export_files(spark, sf):
    from camstat.plans.identity import _exports
    ex = _exports(spark, sf)
    k = (F.regexp_extract("source_file", r"img_(\d+)", 1).cast("bigint") % 10)
    f = F.when(k % 2 == 1, F.concat(F.lit("TrailCamStorage_P"), k.cast("string"), F.lit("_exp1_output.csv"))) \
        .otherwise(F.concat(F.lit("TrailCamStorage_P"), k.cast("string"), F.lit("_exp"), F.col("orig").cast("string"),
                            F.lit("_output.csv")))
    return ex.withColumn("file", f).drop("orig")


def _annotation_flow_sql(rows=""):
    from camstat.plans.identity import _DECIDE_SQL, _EXPORTS_SQL
    files = f"""
SELECT {rows} source_file, id, species, CASE WHEN k % 2 = 1 THEN 'TrailCamStorage_P' || CAST(k AS VARCHAR) || '_exp1_output.csv'
       ELSE 'TrailCamStorage_P' || CAST(k AS VARCHAR) || '_exp' || CAST(orig AS VARCHAR) || '_output.csv' END AS file
FROM (SELECT *, CAST(regexp_extract(source_file, 'img_(\\d+)', 1) AS BIGINT) % 10 AS k FROM ({_EXPORTS_SQL}) e) x"""
    return with_views(["annotation_ids"], f"""
WITH ex AS (SELECT *, array_to_string(string_split(replace(replace(file, 'TrailCamStorage_2', 'T2'),
              'TrailCamStorage', 'T1'), '_')[1:2], '_') AS project FROM files),
pf AS (SELECT project, count(DISTINCT file) AS nf, min(file) AS f1 FROM ex GROUP BY project),
exports AS (SELECT ex.source_file, CASE WHEN ex.file = pf.f1 THEN 1 ELSE 2 END AS orig, ex.id, ex.species
            FROM ex JOIN pf ON ex.project = pf.project WHERE pf.nf = 2),
{_DECIDE_SQL}
SELECT ex.project, ex.source_file, ex.id, nullif(ex.species, 'None') AS species
FROM ex JOIN pf ON ex.project = pf.project WHERE pf.nf = 1
UNION ALL
SELECT e2.project, e.source_file, e.id, nullif(e.species, 'None') AS species
FROM exports e JOIN d ON e.source_file = d.source_file
JOIN (SELECT DISTINCT source_file, project FROM ex) e2 ON e.source_file = e2.source_file
WHERE (d.rule IN ('D1', 'D4') AND e.orig = 1) OR (d.rule = 'D5' AND e.orig = 2)
   OR (d.rule = 'D2' AND TRY_CAST(e.id AS BIGINT) = d.min_num)
   OR (d.rule IN ('D3', 'D6') AND TRY_CAST(e.id AS BIGINT) IS NULL)""", {"files": files})


@register("annotation_flow", _annotation_flow_sql())
def annotation_flow(spark, sf):
    """S3 + reconcile + U1 + O12: export files grouped into projects by name;
    single-export projects pass through, projects exported twice are reconciled
    per image (export 1 = first file name), then everything is unioned."""
    from camstat.operators.reconcile import process_annotations
    out, _ = process_annotations(_export_files(spark, sf), "file", ["project", "source_file"])
    return out.select("project", "source_file", "id", "species")
