"""Detector-output tables: breakdowns, progress, review, histograms, boxes,
repeats (A2-A6, A17, A18, A22, A23, O6, O7, O9, F20-F22, J5, J14, A33, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.functions import geometry as G
from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import joins as J
from camstat.operators.repeats import repeat_pairs, suppress_repeats
from camstat.plans.registry import register
from camstat.plans.sqlviews import VIEWS, with_views
from camstat.sources import adapters as S

CONF_T = 0.1
IOU_T = 0.85


@register("empty_image_share", with_views(["boxes"], """
SELECT isempty, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM (SELECT DISTINCT image_id, isempty FROM boxes) d GROUP BY isempty"""))
def empty_image_share(spark, sf):
    """A2: images with / without detections (distinct images first)."""
    return A.freq_pct(S.boxes(spark, sf), "isempty", distinct_on=["image_id", "isempty"])


@register("category_breakdown", with_views(["boxes"], f"""
SELECT category_id, count(*) AS n_all, count(*) FILTER (WHERE confidence > {CONF_T}) AS n_filtered,
       count(*) * 100.0 / sum(count(*)) OVER () AS pct_all,
       count(*) FILTER (WHERE confidence > {CONF_T}) * 100.0
         / sum(count(*) FILTER (WHERE confidence > {CONF_T})) OVER () AS pct_filtered
FROM boxes WHERE confidence > 0 GROUP BY category_id"""))
def category_breakdown(spark, sf):
    """A3: detections per category above 0 and above 0.1."""
    return A.category_breakdown(S.boxes(spark, sf), CONF_T)


@register("progress_table", with_views(["boxes"], f"""
SELECT 1 AS "order", 'Total' AS status, count(DISTINCT image_id) AS images,
       count(*) FILTER (WHERE confidence > 0) AS detections, CAST(NULL AS BIGINT) AS false_positives FROM boxes
UNION ALL SELECT 2, 'With detections', count(DISTINCT image_id), NULL, NULL FROM boxes WHERE NOT isempty
UNION ALL SELECT 3, 'Empty', count(DISTINCT image_id), NULL, NULL FROM boxes WHERE isempty
UNION ALL SELECT 4, 'Filtered', count(DISTINCT image_id), count(*), NULL FROM boxes WHERE confidence > {CONF_T}
UNION ALL SELECT 5, 'Processed', count(DISTINCT image_id), count(*), count(*) FILTER (WHERE species IS NULL)
FROM boxes WHERE confidence > {CONF_T}"""))
def progress_table(spark, sf):
    """A4: five-row tagging progress table (processed = boxes above 0.1)."""
    b = S.boxes(spark, sf)
    return A.progress_table(b, O.above(b, CONF_T), CONF_T)


@register("review_outcome", with_views(["boxes"], """
SELECT count(*) AS n, count(*) FILTER (WHERE species IS NULL) AS false_pos,
       count(*) FILTER (WHERE species IS NOT NULL AND NOT manual) AS true_pos,
       count(*) FILTER (WHERE species IS NOT NULL AND manual) AS missed,
       count(*) FILTER (WHERE species IS NULL AND manual) AS manual_fp,
       count(*) FILTER (WHERE species IS NULL) * 100.0 / count(*) AS false_pos_pct,
       count(*) FILTER (WHERE species IS NOT NULL AND NOT manual) * 100.0 / count(*) AS true_pos_pct,
       count(*) FILTER (WHERE species IS NOT NULL AND manual) * 100.0 / count(*) AS missed_pct
FROM boxes"""))
def review_outcome(spark, sf):
    """A5: false positives / true positives / missed-by-detector shares."""
    return A.review_outcome(S.boxes(spark, sf))


@register("origin_breakdown", with_views(["boxes"], """
SELECT origin, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM boxes WHERE origin IS NOT NULL GROUP BY origin"""))
def origin_breakdown(spark, sf):
    """Frequency and share of box origins (prediction / adjusted / manual)
    over all non-empty boxes."""
    return A.origin_breakdown(S.boxes(spark, sf))


@register("confidence_histogram", with_views(["boxes"], f"""
SELECT type, bin, count(*) AS n, {CONF_T} + (bin - 1) * {(1 - CONF_T) / 100} AS bin_lo,
       {CONF_T} + bin * {(1 - CONF_T) / 100} AS bin_hi FROM (
  SELECT CASE category_id WHEN 0 THEN 'Empty' WHEN 1 THEN 'Animal' WHEN 2 THEN 'Person'
              WHEN 3 THEN 'Vehicle' END AS type,
         least(CAST(floor((confidence - {CONF_T}) / ({1 - CONF_T} / 100)) AS BIGINT) + 1, 100) AS bin
  FROM boxes WHERE confidence > {CONF_T} AND confidence BETWEEN {CONF_T} AND 1.0) x
GROUP BY type, bin"""))
def confidence_histogram(spark, sf):
    """A17 + O6 + O9: 100-bin histogram of confidence above 0.1 by category label."""
    b = O.label_category(O.above(S.boxes(spark, sf), CONF_T))
    return A.histogram(b, "confidence", 100, CONF_T, 1.0, by=["type"])


@register("box_size_stats", with_views(["boxes"], """
WITH q AS (SELECT category_id, count(w * h) AS n, quantile_cont(w * h, 0.25) AS q1,
                  quantile_cont(w * h, 0.5) AS median, quantile_cont(w * h, 0.75) AS q3
           FROM boxes GROUP BY category_id)
SELECT q.category_id, q.n, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr,
       min(CASE WHEN b.w * b.h >= q.q1 - 1.5 * (q.q3 - q.q1) THEN b.w * b.h END) AS whisker_lo,
       max(CASE WHEN b.w * b.h <= q.q3 + 1.5 * (q.q3 - q.q1) THEN b.w * b.h END) AS whisker_hi,
       count(*) FILTER (WHERE b.w * b.h < q.q1 - 1.5 * (q.q3 - q.q1) OR b.w * b.h > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM boxes b JOIN q ON b.category_id = q.category_id
GROUP BY q.category_id, q.n, q.q1, q.median, q.q3"""))
def box_size_stats(spark, sf):
    """A18 + F21: box-area quartiles and whiskers per category."""
    b = S.boxes(spark, sf).withColumn("area", G.box_area("w", "h"))
    return A.box_stats(b, "area", ["category_id"])


@register("images_per_folder", with_views(["boxes"], """
SELECT folder AS location, count(DISTINCT image_id) AS n_images FROM boxes GROUP BY folder"""))
def images_per_folder(spark, sf):
    """Images per location folder."""
    imgs = S.boxes(spark, sf).select(F.col("folder").alias("location"), "image_id").distinct()
    return A.images_per_location(imgs)


@register("duplicate_box_keys", with_views(["boxes"], """
WITH c AS (SELECT image_id, box, count(*) AS dupe_count FROM boxes GROUP BY image_id, box HAVING count(*) > 1)
SELECT b.image_id, b.box, b.box_id, c.dupe_count FROM boxes b JOIN c ON b.image_id = c.image_id AND b.box = c.box"""))
def duplicate_box_keys(spark, sf):
    """Rows whose (image, box number) key is repeated."""
    b = S.boxes(spark, sf).select("image_id", "box", "box_id")
    return A.get_dupes(b, ["image_id", "box"])


@register("box_pixels", with_views(["boxes"], """
SELECT box_id, floor(x * 1920 / 100.0) AS px_x, floor(y * 1080 / 100.0) AS px_y,
       ceil(w * 1920 / 100.0) AS px_w, ceil(h * 1080 / 100.0) AS px_h, w * h AS area
FROM boxes"""))
def box_pixels(spark, sf):
    """F20 + F21: percent boxes to pixel boxes on a 1920 x 1080 frame, area."""
    b = S.boxes(spark, sf)
    return b.select("box_id",
                    F.floor(G.pct_to_pixels("x", F.lit(1920))).alias("px_x"),
                    F.floor(G.pct_to_pixels("y", F.lit(1080))).alias("px_y"),
                    F.ceil(G.pct_to_pixels("w", F.lit(1920))).alias("px_w"),
                    F.ceil(G.pct_to_pixels("h", F.lit(1080))).alias("px_h"),
                    G.box_area("w", "h").alias("area"))


_NODES_SQL = f"""
SELECT folder, x, y, w, h, min(box_id) AS rep, count(*) AS n FROM boxes WHERE confidence >= {CONF_T} GROUP BY folder, x, y, w, h"""
_PAIRS_SQL = f"""
SELECT folder, a, b, inter / (sum_area - inter) AS iou, n_a, n_b FROM (
  SELECT a.folder, a.rep AS a, b.rep AS b, a.n AS n_a, b.n AS n_b,
         greatest(0.0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x))
         * greatest(0.0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS inter,
         a.w * a.h + b.w * b.h AS sum_area
  FROM nodes a JOIN nodes b ON a.folder = b.folder AND a.rep < b.rep) p
WHERE sum_area - inter > 0 AND inter / (sum_area - inter) >= {IOU_T}"""


@register("repeat_pairs", with_views(["boxes"], _PAIRS_SQL, {"nodes": _NODES_SQL}))
def repeat_pairs_q(spark, sf):
    """J14 + F22: same-folder pairs of different boxes with IoU >= 0.85, with the number of
    equal boxes each stands for (size-class grid join)."""
    return repeat_pairs(S.boxes(spark, sf), IOU_T, CONF_T)


# reachability over the pairs, in both directions
_GROUPS_SQL = f"""
WITH RECURSIVE boxes AS ({VIEWS["boxes"]}), nodes AS ({_NODES_SQL}), pairs AS ({_PAIRS_SQL}),
e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(src, dst) AS (SELECT rep, rep FROM nodes UNION SELECT r.src, e.b FROM reach r JOIN e ON r.dst = e.a),
comp AS (SELECT src AS rep, min(dst) AS repeat_group FROM reach GROUP BY src),
sized AS (SELECT n.*, c.repeat_group, sum(n.n) OVER (PARTITION BY c.repeat_group) AS group_size FROM nodes n JOIN comp c ON n.rep = c.rep)"""


@register("repeat_suppression", _GROUPS_SQL + f"""
SELECT b.folder, count(*) FILTER (WHERE s.rep IS NOT NULL AND b.confidence > 0) AS n_suppressed,
       count(DISTINCT s.repeat_group) AS n_groups, count(*) AS n_boxes
FROM boxes b LEFT JOIN (SELECT * FROM sized WHERE group_size >= 3) s
  ON b.folder = s.folder AND b.x = s.x AND b.y = s.y AND b.w = s.w AND b.h = s.h AND b.confidence >= {CONF_T}
GROUP BY b.folder""")
def repeat_suppression(spark, sf):
    """Connected repeat groups of >= 3 boxes get negative confidence; summary
    per folder of suppressed boxes."""
    s = suppress_repeats(S.boxes(spark, sf), min_count=3, iou_t=IOU_T, conf_t=CONF_T)
    return (s.groupBy("folder").agg(F.count_if(F.col("confidence") < 0).alias("n_suppressed"),
                                    F.count_distinct("repeat_group").alias("n_groups"),
                                    F.count("*").alias("n_boxes")))


@register("repeat_groups", _GROUPS_SQL + f"""
SELECT b.box_id, s.repeat_group, s.group_size FROM boxes b JOIN sized s
  ON b.folder = s.folder AND b.x = s.x AND b.y = s.y AND b.w = s.w AND b.h = s.h
WHERE b.confidence >= {CONF_T} AND s.group_size >= 3""")
def repeat_groups(spark, sf):
    """The group and group size of every suppressed box."""
    s = suppress_repeats(S.boxes(spark, sf), min_count=3, iou_t=IOU_T, conf_t=CONF_T)
    return s.filter(F.col("repeat_group").isNotNull()).select("box_id", "repeat_group", "group_size")


@register("filtered_vs_raw", with_views(["boxes"], f"""
SELECT r.box_id, r.confidence, f.confidence AS confidence_filtered, f.confidence IS NOT NULL AS kept
FROM boxes r LEFT JOIN (SELECT box_id, confidence FROM boxes WHERE confidence > {CONF_T} OR confidence < 0) f
ON r.box_id = f.box_id"""))
def filtered_vs_raw(spark, sf):
    """O7 + J5: raw detections left-joined to the two-sided filtered set."""
    b = S.boxes(spark, sf).select("box_id", "confidence")
    f = O.mark_filtered(b, CONF_T).select("box_id", "confidence")
    out = J.compare_detections(b, f, ["box_id"], "left")
    return out.withColumn("kept", F.col("confidence_filtered").isNotNull())
