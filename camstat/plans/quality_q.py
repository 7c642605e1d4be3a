"""Data-quality checks and streaming jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import quality as Q
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.plans.windows_q import VISITS_SQL
from camstat.session import shared_path
from camstat.sources import adapters as S
from camstat.streaming.sessions import replay


@register("quality_summary", with_views(["observations", "cameras", "deployments", "boxes"], """
SELECT 'Q1_join_conserves' AS check_name,
       abs((SELECT count(*) FROM observations) - (SELECT count(*) FROM observations o LEFT JOIN cameras c ON o.camera_id = c.camera_id))
       + (SELECT count(*) FROM observations o LEFT JOIN cameras c ON o.camera_id = c.camera_id WHERE c.lon IS NULL) AS n_fail
UNION ALL SELECT 'Q2_covered', count(*) FROM (SELECT DISTINCT camera_id FROM observations) o
  WHERE camera_id NOT IN (SELECT camera_id FROM deployments)
UNION ALL SELECT 'Q4_one_deployment', count(*) FROM (SELECT camera_id FROM deployments GROUP BY camera_id HAVING count(*) > 1) d
UNION ALL SELECT 'Q5_parts_sum', abs((SELECT count(DISTINCT image_id) FROM boxes)
  - (SELECT sum(n) FROM (SELECT isempty, count(*) AS n FROM (SELECT DISTINCT image_id, isempty FROM boxes) x GROUP BY isempty) y))
UNION ALL SELECT 'Q6_manual_fp', count(*) FROM boxes WHERE species IS NULL AND manual"""))
def quality_summary(spark, sf):
    """Q1, Q2, Q4, Q5, Q6 as failing-row counts (0 = pass; Q6 is expected to fail
    on the synthetic boxes, which mark every 7th line manual)."""
    obs = S.observations(spark, sf)
    cams = S.cameras(spark, sf)
    dep = S.deployments(spark, sf)
    boxes = S.boxes(spark, sf)
    q1 = Q.expect_join_conserves(obs, obs.join(cams, "camera_id", "left"), "lon").select(
        (F.abs(F.col("n_left") - F.col("n_joined")) + F.col("n_null")).alias("n_fail"))
    q2 = Q.expect_covered(obs, dep, "camera_id").agg(F.count("*").alias("n_fail"))
    q4 = Q.expect_unique(dep, ["camera_id"]).agg(F.count("*").alias("n_fail"))
    parts = A.freq_pct(boxes, "isempty", distinct_on=["image_id", "isempty"])
    q5 = Q.expect_total(boxes, "image_id", parts=parts).select(
        F.abs(F.col("total") - F.col("parts_sum")).alias("n_fail"))
    q6 = Q.expect_no_manual_fp(boxes).agg(F.count("*").alias("n_fail"))
    out = None
    for name, d in [("Q1_join_conserves", q1), ("Q2_covered", q2), ("Q4_one_deployment", q4),
                    ("Q5_parts_sum", q5), ("Q6_manual_fp", q6)]:
        r = d.select(F.lit(name).alias("check_name"), "n_fail")
        out = r if out is None else out.unionByName(r)
    return out


# s_suppkey % 40 names the project, so projects get one, two, three or more export files as the table grows
_FILE_SQL = """SELECT 'TrailCamStorage' || CASE WHEN s_suppkey % 3 = 0 THEN '_2' ELSE '' END || '_P' || CAST(s_suppkey % 13 AS VARCHAR)
  || '_export' || CAST(s_suppkey AS VARCHAR) || '_output.csv' AS file FROM supplier WHERE s_suppkey % 13 <> 5 OR s_suppkey % 2 = 0"""


@register("project_file_check", with_views([], f"""
WITH p AS (SELECT file, array_to_string(string_split(replace(replace(file, 'TrailCamStorage_2', 'T2'),
             'TrailCamStorage', 'T1'), '_')[1:2], '_') AS project FROM ({_FILE_SQL}) f)
SELECT project, count(DISTINCT file) AS n_files FROM p GROUP BY project HAVING count(DISTINCT file) > 1
  AND count(DISTINCT file) <> 2"""))
def project_file_check(spark, sf):
    """Q7: duplicated projects that do not have exactly two export files."""
    from camstat.operators.reconcile import tag_projects
    k = F.col("s_suppkey")
    s = S.table(spark, sf, "supplier").filter((k % 13 != 5) | (k % 2 == 0))
    f = tag_projects(s.select(F.concat(F.when(k % 3 == 0, F.lit("TrailCamStorage_2"))
                                       .otherwise(F.lit("TrailCamStorage")), F.lit("_P"),
                                       (k % 13).cast("string"), F.lit("_export"),
                                       k.cast("string"), F.lit("_output.csv")).alias("file")))
    return Q.expect_two_files(f)


@register("same_keys_check", with_views(["observations", "deployments"], """
SELECT coalesce(o.camera_id, d.camera_id) AS camera_id FROM (SELECT DISTINCT camera_id FROM observations) o
FULL OUTER JOIN deployments d ON o.camera_id = d.camera_id WHERE o.camera_id IS NULL OR d.camera_id IS NULL"""))
def same_keys_check(spark, sf):
    """Q3: cameras that are in only one of the observation and deployment tables."""
    return Q.expect_same_keys(S.observations(spark, sf), S.deployments(spark, sf), "camera_id").select("camera_id")


@register("rows_match_folders_check", with_views(["cameras", "boxes"], """
SELECT camera_id AS folder FROM cameras WHERE camera_id NOT IN (SELECT DISTINCT folder FROM boxes)"""))
def rows_match_folders_check(spark, sf):
    """Q8: cameras of the camera table that have no image folder."""
    cams = S.cameras(spark, sf).select(F.col("camera_id").alias("folder"))
    return Q.expect_rows_match_folders(cams, S.boxes(spark, sf).select("folder").distinct(), "folder").select("folder")


@register("stream_visit_sessions", with_views(["observations"], VISITS_SQL))
def stream_visit_sessions(spark, sf):
    """T2 as a Structured Streaming job: the observations are replayed in time order as a file
    stream, sessions with a 30-minute gap are emitted once the watermark (1 hour) closes them, into
    a Parquet sink under the cluster's checkpoint folder; the sink is read back."""
    return replay(S.observations(spark, sf), shared_path(spark, "stream-sessions"))


# fixed value: folders that an export of all camera folders is dealt to
EXPORT_FOLDERS = 240


@register("stream_ingest_detections", with_views(["boxes"], """
SELECT category_id, count(*) AS n, count(DISTINCT image_id) AS n_images FROM boxes GROUP BY category_id"""))
def stream_ingest_detections(spark, sf):
    """T1 + S2 + S17: boxes exported as per-image COCO documents (compressed JSON lines, the camera
    folders dealt to a fixed number of folders) under the cluster's checkpoint folder, ingested
    by an exactly-once file stream (availableNow), counted from the sink."""
    from camstat.streaming.ingest import export_documents, ingest_detections
    base = shared_path(spark, "stream-ingest")
    # the listing and the commits of the driver grow with the bytes, not with the cameras
    export_documents(S.boxes(spark, sf), F.pmod(F.xxhash64("folder"), F.lit(EXPORT_FOLDERS)), base + "/in")
    ingest_detections(spark, base + "/in", base + "/out", base + "/ck", pattern="*.txt.snappy", multi_line=False)
    out = spark.read.parquet(base + "/out")
    return out.groupBy("category_id").agg(F.count("*").alias("n"), F.count_distinct("image_id").alias("n_images"))
