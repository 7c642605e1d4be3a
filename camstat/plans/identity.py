"""Ids, paths, names, dates, wide annotations and export reconciliation
(F1-F19, F29, O5, O10, O12, O13, O16, O17, O21-O23, R1, S3, J18, reconcile)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.functions import ids as I
from camstat.functions import textfn as X
from camstat.functions import timefn as Tm
from camstat.operators import filters as O
from camstat.operators import joins as J
from camstat.operators.reconcile import reconcile, tag_projects
from camstat.operators.reshape import unpivot, widen_tags
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S

_SP_SQL = ("['Moose', 'Caribou', 'Black Bear', 'Gray Wolf', 'Sandhill Crane', 'Human', 'Vehicle', "
           "'Unknown', 'Other [See more species]'][CAST(l_partkey % 9 AS INTEGER) + 1]")


def _species(col="l_partkey"):
    return F.element_at(F.array(*[F.lit(s) for s in S.BOX_SPECIES]), (F.col(col) % 9 + 1).cast("int"))


@register("annotation_id_parts", with_views(["annotation_ids"], """
SELECT id, regexp_replace(id, '_[^_]*$', '') AS image_id, split_part(id, '_', 2) AS camera_id,
       substr(id, 1, 4) AS plot_id, split_part(regexp_replace(id, '_[^_]*$', ''), '_', 1) AS site_id,
       len(string_split(id, '_')) AS n_tokens, contains(id, '_M') AS manual,
       starts_with(string_split(id, '_')[-1], 'M') AS manual_strict,
       regexp_matches(id, '^[+-]?[0-9]+$') AS numeric_id,
       NOT (contains(id, 'P') OR contains(id, 'Q')) AS numeric_id_letters,
       array_to_string(string_split(id, '_')[1:5], '_') AS first5
FROM annotation_ids"""))
def annotation_id_parts(spark, sf):
    """Image, camera, plot and site ids, token count, manual and
    numeric-id flags, first five tokens."""
    a = S.annotation_ids(spark, sf)
    return a.select("id", I.image_id("id").alias("image_id"), I.camera_id("id").alias("camera_id"),
                    I.plot_id("id").alias("plot_id"), I.site_id(I.image_id("id")).alias("site_id"),
                    I.token_count("id").alias("n_tokens"), I.is_manual("id").alias("manual"),
                    I.is_manual("id", strict=True).alias("manual_strict"),
                    I.is_numeric_id("id").alias("numeric_id"),
                    I.is_numeric_id("id", "letters").alias("numeric_id_letters"),
                    I.first_tokens("id", 5).alias("first5"))


@register("animal_observations", with_views(["annotation_ids"], f"""
SELECT id, split_part(id, '_', 2) AS camera_id, substr(id, 1, 4) AS plot_id,
       CASE WHEN species = 'Other [See more species]' THEN 'Red Fox' ELSE species END AS species
FROM (SELECT id, CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_SP_SQL} END AS species FROM annotation_ids) a
WHERE species NOT IN ('Human', 'Vehicle') AND len(string_split(id, '_')) > 1 AND species <> 'Unknown'"""))
def animal_observations(spark, sf):
    """O5 + O10 + O12: animals only (no Human/Vehicle/Unknown, >= 2 id tokens),
    catch-all species resolved to the free-text one."""
    a = S.annotation_ids(spark, sf).select(
        "id", F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_species()).alias("species"),
        F.lit(S.OTHER_TEXT).alias("other_species"))
    a = O.none_to_null(O.null_to_none(a))
    a = O.animals_only(O.resolve_species(a))
    return a.select("id", I.camera_id("id").alias("camera_id"), I.plot_id("id").alias("plot_id"), "species")


_REL_SQL = ("CASE WHEN l_returnflag = 'R' THEN 'NonWildlife' ELSE 'Wildlife' END || '/DCIM/100RECNX/RCNX' "
            "|| CAST(l_orderkey AS VARCHAR) || '.JPG'")


def _rename_tokens_sql(p):
    return (f"array_to_string(list_transform(list_filter(string_split({p}, '/'), lambda x: x <> 'DCIM'), "
            "lambda x: replace(replace(regexp_replace(replace(replace(x, 'RECNX', ''), 'RCNX', ''), "
            "'\\.(jpg|jpeg|JPG|JPEG)$', ''), 'NonWildlife', 'NW'), 'Wildlife', 'W')), '_')")


def _first2_sql(p):
    return (f"array_to_string(list_transform(list_filter(string_split({p}, '/'), lambda x: x <> 'DCIM'), "
            "lambda x: replace(replace(regexp_replace(replace(replace(x, 'RECNX', ''), 'RCNX', ''), "
            "'\\.(jpg|jpeg|JPG|JPEG)$', ''), 'NonWildlife', 'NW'), 'Wildlife', 'W'))[1:2], '_')")


@register("image_rename_plan", with_views([], f"""
SELECT rel_path, new_name, route,
       CASE WHEN contains(new_name, '_W_') THEN base || '_W' WHEN contains(new_name, '_NW_') THEN base || '_NW'
            ELSE base END AS sub_folder
FROM (SELECT rel_path, route,
             concat_ws('_', 'D2022', location, {_rename_tokens_sql('rel_path')},
                       replace(replace(capture, ':', '_'), ' ', '_')) || '.JPG' AS new_name,
             concat_ws('_', 'D2022', location, {_first2_sql('rel_path')}) AS base
      FROM (SELECT {_REL_SQL} AS rel_path, 'P' || CAST(l_suppkey AS VARCHAR) AS location,
                   strftime(l_shipdate, '%Y:%m:%d %H:%M:%S') AS capture,
                   CASE WHEN l_returnflag = 'R' THEN 'NW' ELSE 'W' END AS route
            FROM lineitem) a) b"""))
def image_rename_plan(spark, sf):
    """F9 + F10 + O23: standard image names and sub-folders for a copy plan."""
    li = S.table(spark, sf, "lineitem")
    rel = F.concat(F.when(F.col("l_returnflag") == "R", F.lit("NonWildlife")).otherwise(F.lit("Wildlife")),
                   F.lit("/DCIM/100RECNX/RCNX"), F.col("l_orderkey").cast("string"), F.lit(".JPG"))
    df = li.select(rel.alias("rel_path"),
                   F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("location"),
                   F.date_format("l_shipdate", "yyyy:MM:dd HH:mm:ss").alias("capture"))
    df = O.route_wildlife(df, "rel_path")
    df = df.withColumn("new_name", I.standard_image_name("rel_path", "capture", F.lit("D2022"), "location"))
    df = df.withColumn("sub_folder", I.standard_sub_folder("rel_path", "new_name", F.lit("D2022"), "location"))
    return df.select("rel_path", "new_name", "route", "sub_folder")


@register("url_paths", with_views([], """
SELECT page_id, string_split(url, '/')[-1] AS basename, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dirname,
       regexp_replace(url, '^https://', '') AS relpath, 'https://' || regexp_replace(url, '^https://', '') AS url_back,
       regexp_replace(url, '\\.example', '') AS no_example, regexp_replace(url, '[0-9]', '#', 'g') AS masked,
       regexp_matches(url, '^https') AS secure, contains(url, '?') AS has_query,
       concat_ws('/', 'pages', CAST(page_id AS VARCHAR), string_split(url, '/')[-1]) AS local_path
FROM pages"""))
def url_paths(spark, sf):
    """Base / dir names, prefix strip and rebuild, first-match
    removal, replace-all, detection, path join."""
    p = S.table(spark, sf, "pages")
    rel = I.url_to_relpath("url", "https://")
    return p.select("page_id", I.basename("url").alias("basename"), I.dirname("url").alias("dirname"),
                    rel.alias("relpath"), I.relpath_to_url(rel, "https://").alias("url_back"),
                    X.remove_first("url", ".example", fixed=True).alias("no_example"),
                    X.replace_all("url", "[0-9]", "#").alias("masked"),
                    X.detect("url", "^https").alias("secure"), X.detect("url", "?", fixed=True).alias("has_query"),
                    I.path_join(F.lit("pages"), F.col("page_id").cast("string"), I.basename("url")).alias("local_path"))


@register("network_paths", with_views([], """
SELECT c_custkey, CASE WHEN len(parts) <= 1 THEN NULL ELSE parts[2] END AS root,
       CASE WHEN len(parts) <= 1 THEN NULL ELSE array_to_string(parts[3:5], '/') END AS path
FROM (SELECT c_custkey, string_split(CASE WHEN c_acctbal < 0 THEN c_name
        ELSE 'srv' || CAST(c_nationkey AS VARCHAR) || '\\share\\' || c_mktsegment || '\\' || c_name || '\\DCIM' END, '\\') AS parts
      FROM customer) c"""))
def network_paths(spark, sf):
    """network storage path split into root (2nd part) and path (parts 3-5);
    null when the value has no separator."""
    c = S.table(spark, sf, "customer")
    loc = F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(
        F.concat(F.lit("srv"), F.col("c_nationkey").cast("string"), F.lit("\\share\\"), F.col("c_mktsegment"),
                 F.lit("\\"), F.col("c_name"), F.lit("\\DCIM")))
    return c.select("c_custkey", I.network_root(loc).alias("root"), I.network_path(loc).alias("path"))


@register("capture_time_keys", with_views([], """
SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, year(ts) AS year, strftime(ts, '%b') AS month,
       dayofmonth(ts) AS day, concat_ws('_', year(ts), strftime(ts, '%b'), dayofmonth(ts)) AS ymd,
       strftime(ts, '%b %Y') AS month_year, datediff('day', DATE '1995-01-01', CAST(ts AS DATE)) AS days_since,
       hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds_of_day
FROM (SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y:%m:%d %H:%M:%S'), '%Y:%m:%d %H:%M:%S') AS ts FROM orders) o"""))
def capture_time_keys(spark, sf):
    """EXIF-style text parsed back to time; date keys, month-year label,
    day differences, time of day."""
    o = S.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy:MM:dd HH:mm:ss").alias("exif_date_time_original"))
    o = o.withColumn("date_time", Tm.parse_capture_time("exif_date_time_original"))
    o = Tm.with_date_keys(o, "date_time")
    return o.select("o_orderkey", "date_time", "year", "month", "day", "ymd",
                    Tm.month_year_label("date_time").alias("month_year"),
                    Tm.days_between("date_time", F.lit("1995-01-01")).alias("days_since"),
                    Tm.seconds_of_day("date_time").alias("seconds_of_day"))


@register("event_time_of_day", with_views([], """
SELECT event_id, hour(t) * 3600 + minute(t) * 60 + second(t) AS seconds_of_day, strftime(t, '%Y-%m-%d %H:%M:%S') AS local_time
FROM (SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
                            THEN ts + INTERVAL 1 HOUR ELSE ts END AS t FROM events) e
WHERE hour(t) * 3600 + minute(t) * 60 + second(t) <> 0"""))
def event_time_of_day(spark, sf):
    """F18 + F19 + O18: daylight-saving shift for a stated window, time of day,
    zero-time rows dropped."""
    e = S.table(spark, sf, "events").select("event_id", "ts")
    t = Tm.dst_shift("ts", [("2024-01-10 00:00:00", "2024-01-20 00:00:00")])
    e = e.select("event_id", t.alias("t")).withColumn("seconds_of_day", Tm.seconds_of_day("t"))
    e = O.nonzero_time(e, "seconds_of_day")
    return e.select("event_id", "seconds_of_day", F.col("t").alias("local_time"))


@register("deployment_table", with_views(["deployments"], """
SELECT camera_id, strftime(date_deployed, '%Y-%m-%d') AS date_deployed,
       strftime(date_retrieved, '%Y-%m-%d') AS date_retrieved, date_retrieved IS NOT NULL AS is_retrieved,
       CASE WHEN date_retrieved IS NOT NULL AND date_deployed < date_retrieved THEN 'valid' ELSE 'invalid' END AS status,
       concat_ws(' - ', strftime(date_deployed, '%b %Y'), strftime(date_retrieved, '%b %Y')) AS deployment_group,
       datediff('day', date_deployed, date_retrieved) AS deploy_interval
FROM deployments"""))
def deployment_table(spark, sf):
    """O13 + F16 + F17: retrieved flag, validity, deployment group, interval."""
    d = O.deployment_status(S.deployments(spark, sf))
    return d.select("camera_id", F.date_format("date_deployed", "yyyy-MM-dd").alias("date_deployed"),
                    F.date_format("date_retrieved", "yyyy-MM-dd").alias("date_retrieved"), "is_retrieved", "status",
                    Tm.deployment_group("date_deployed", "date_retrieved").alias("deployment_group"),
                    Tm.days_between("date_retrieved", "date_deployed").alias("deploy_interval"))


@register("observations_in_deployment", with_views(["long_observations", "deployments"], """
SELECT o.camera_id, count(*) AS n_obs,
       count(*) FILTER (WHERE CAST(o.date_time AS DATE) >= d.date_deployed
                          AND (d.date_retrieved IS NULL OR CAST(o.date_time AS DATE) <= d.date_retrieved)) AS n_inside
FROM long_observations o LEFT JOIN deployments d ON o.camera_id = d.camera_id GROUP BY o.camera_id"""))
def observations_in_deployment(spark, sf):
    """Observations inside their camera's deployed-retrieved span."""
    obs = S.long_observations(spark, sf)
    dep = S.deployments(spark, sf)
    j = J.in_deployment(obs, dep)
    return j.groupBy("camera_id").agg(F.count("*").alias("n_obs"), F.count_if("in_deployment").alias("n_inside"))


_LONG_TAGS_SQL = f"""
SELECT a.id, a.source_file, v.variable, v.tag, a.value_text FROM (
  SELECT id, 'img_' || CAST(l_orderkey AS VARCHAR) || '.JPG' AS source_file,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_SP_SQL} END AS species,
         CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'M' ELSE 'UNS' END AS sex,
         CASE WHEN l_linestatus = 'O' THEN 'Adult' ELSE 'Juvenile' END AS age,
         CASE WHEN l_linenumber = 6 THEN 'see notes' END AS value_text
  FROM annotation_ids) a,
  LATERAL (VALUES ('species', a.species), ('sex', a.sex), ('age', a.age),
                  ('other_species', CASE WHEN a.species = 'Other [See more species]' THEN 'Red Fox' END)) AS v(variable, tag)"""


def _long_tags(spark, sf):
    a = S.annotation_ids(spark, sf).select(
        "id", F.concat(F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit(".JPG")).alias("source_file"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_species()).alias("species"),
        F.when(F.col("l_returnflag") == "R", "F").when(F.col("l_returnflag") == "A", "M").otherwise("UNS").alias("sex"),
        F.when(F.col("l_linestatus") == "O", "Adult").otherwise("Juvenile").alias("age"),
        F.when(F.col("l_linenumber") == 6, F.lit("see notes")).alias("value_text"))
    a = a.withColumn("other_species", F.when(F.col("species") == O.OTHER_SPECIES, F.lit(S.OTHER_TEXT)))
    return unpivot(a, ["id", "source_file", "value_text"], ["species", "sex", "age", "other_species"],
                   "variable", "tag").select("id", "source_file", "variable", "tag", "value_text")


@register("annotations_wide", with_views(["annotation_ids"], """
SELECT id, source_file, value_text, contains(id, '_M') AS manual, regexp_replace(id, '_[^_]*$', '') AS image_id,
       CASE WHEN species = 'Other [See more species]' THEN other_species ELSE species END AS species,
       other_species, sex, age, behavior, unique_markings, comment, notes
FROM (SELECT id, source_file, value_text,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'species') AS species,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'other_species') AS other_species,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'sex') AS sex,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'age') AS age,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'behavior') AS behavior,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'unique_markings') AS unique_markings,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'comment') AS comment,
             string_agg(DISTINCT tag, ', ' ORDER BY tag) FILTER (WHERE variable = 'notes') AS notes
      FROM long_tags GROUP BY id, source_file, value_text) w
WHERE value_text IS NULL""", {"long_tags": _LONG_TAGS_SQL}))
def annotations_wide(spark, sf):
    """R1 + R2 + O10 + O11: long tag rows pivoted to one row per box over the
    fixed variable list; comment rows dropped; catch-all species resolved."""
    return widen_tags(_long_tags(spark, sf), drop=(), rows=4 * S.table(spark, sf, "lineitem").count())


_EXPORTS_SQL = f"""
SELECT 'img_' || CAST(l_orderkey AS VARCHAR) || '.JPG' AS source_file, 1 AS orig,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 AND l_orderkey % 2 = 0 THEN CAST(l_orderkey * 10 + 1 AS VARCHAR)
            ELSE id END AS id,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_SP_SQL} END AS species
FROM annotation_ids WHERE l_linestatus = 'F' OR l_linenumber <= 2
UNION ALL
SELECT 'img_' || CAST(l_orderkey AS VARCHAR) || '.JPG', 2,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(l_orderkey * 10 + 2 AS VARCHAR) ELSE id END,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_SP_SQL} END
FROM annotation_ids WHERE l_linestatus = 'O' OR l_linenumber <= 2"""


def _exports(spark, sf):
    """Two exports of the same images built from one scan: each row is tagged
    export 1 and/or 2 by explode + filter (no union of two scans)."""
    a = S.annotation_ids(spark, sf)
    src = F.concat(F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit(".JPG"))
    sp = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_species())
    r1 = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    e = a.withColumn("orig", F.explode(F.array(F.lit(1), F.lit(2))))
    low = F.col("l_linenumber") <= 2
    e = e.filter(((F.col("orig") == 1) & ((F.col("l_linestatus") == "F") | low))
                 | ((F.col("orig") == 2) & ((F.col("l_linestatus") == "O") | low)))
    id_ = (F.when((F.col("orig") == 1) & r1 & (F.col("l_orderkey") % 2 == 0),
                  (F.col("l_orderkey") * 10 + 1).cast("string"))
           .when((F.col("orig") == 2) & r1, (F.col("l_orderkey") * 10 + 2).cast("string"))
           .otherwise(F.col("id")))
    return e.select(src.alias("source_file"), F.col("orig"), id_.alias("id"), sp.alias("species"))


_DECIDE_SQL = """
r AS (SELECT source_file, orig, id, coalesce(species, 'None') AS sp, TRY_CAST(id AS BIGINT) IS NOT NULL AS num FROM exports),
pair AS (SELECT source_file, id, sp, num, count(*) FILTER (WHERE orig = 1) AS c1, count(*) FILTER (WHERE orig = 2) AS c2
         FROM r GROUP BY source_file, id, sp, num),
f AS (SELECT source_file, sum(c1) AS n1, sum(c2) AS n2, count(*) FILTER (WHERE c1 <> c2) AS mism,
             bool_and(sp = 'None') AS all_none, sum(CASE WHEN num THEN c1 + c2 ELSE 0 END) AS n_num,
             min(CASE WHEN num THEN TRY_CAST(id AS BIGINT) END) AS min_num FROM pair GROUP BY source_file),
d AS (SELECT source_file, min_num, CASE
        WHEN n1 = n2 AND mism = 0 THEN 'D1'
        WHEN n1 = 1 AND n2 = 1 AND all_none AND n_num = 2 THEN 'D2'
        WHEN n1 = 1 AND n2 = 1 AND all_none AND n_num = 1 THEN 'D3'
        WHEN n2 = 0 THEN 'D4' WHEN n1 = 0 THEN 'D5'
        WHEN n1 <> n2 AND all_none AND n_num = 1 THEN 'D6' ELSE 'E' END AS rule FROM f)"""


@register("reconcile_exports", with_views(["annotation_ids"], f"""
WITH {_DECIDE_SQL}
SELECT e.source_file, e.id, nullif(e.species, 'None') AS species, d.rule
FROM exports e JOIN d ON e.source_file = d.source_file
WHERE (d.rule IN ('D1', 'D4') AND e.orig = 1) OR (d.rule = 'D5' AND e.orig = 2)
   OR (d.rule = 'D2' AND TRY_CAST(e.id AS BIGINT) = d.min_num)
   OR (d.rule IN ('D3', 'D6') AND TRY_CAST(e.id AS BIGINT) IS NULL)""", {"exports": _EXPORTS_SQL}))
def reconcile_exports(spark, sf):
    """Section 2.9: two exports of the same images reconciled by rules D1-D6."""
    kept, _ = reconcile(_exports(spark, sf))
    return kept


@register("reconcile_conflicts", with_views(["annotation_ids"], f"""
WITH {_DECIDE_SQL}
SELECT d.rule, count(DISTINCT e.source_file) AS n_files, count(*) AS n_rows
FROM exports e JOIN d ON e.source_file = d.source_file WHERE d.rule = 'E' GROUP BY d.rule""", {"exports": _EXPORTS_SQL}))
def reconcile_conflicts(spark, sf):
    """Rule E quarantine: files whose exports disagree."""
    _, conf = reconcile(_exports(spark, sf))
    return conf.groupBy("rule").agg(F.count_distinct("source_file").alias("n_files"), F.count("*").alias("n_rows"))


@register("reconcile_rule_counts", with_views(["annotation_ids"], f"""
WITH {_DECIDE_SQL}
SELECT rule, count(*) AS n_files FROM d GROUP BY rule""", {"exports": _EXPORTS_SQL}))
def reconcile_rule_counts(spark, sf):
    from camstat.operators.reconcile import decide
    return decide(_exports(spark, sf), ["source_file"]).groupBy("rule").agg(F.count("*").alias("n_files"))


_FILES_SQL = """
SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'TrailCamStorage_2' ELSE 'TrailCamStorage' END || '_P'
       || CAST(s_suppkey % 40 AS VARCHAR) || '_export' || CAST(s_suppkey AS VARCHAR) || '_output.csv' AS file
FROM supplier"""


@register("export_projects", with_views([], """
WITH p AS (SELECT file, array_to_string(string_split(replace(replace(string_split(file, '/')[-1],
             'TrailCamStorage_2', 'T2'), 'TrailCamStorage', 'T1'), '_')[1:2], '_') AS project FROM files)
SELECT p.file, p.project, n.n_files, n.n_files > 1 AS duplicated
FROM p JOIN (SELECT project, count(DISTINCT file) AS n_files FROM p GROUP BY project) n ON p.project = n.project""",
    {"files": _FILES_SQL}))
def export_projects(spark, sf):
    """S3: project key from export file names; duplicated projects flagged."""
    s = S.table(spark, sf, "supplier")
    f = s.select(F.concat(F.when(F.col("s_suppkey") % 3 == 0, F.lit("TrailCamStorage_2"))
                          .otherwise(F.lit("TrailCamStorage")), F.lit("_P"),
                          (F.col("s_suppkey") % 40).cast("string"), F.lit("_export"),
                          F.col("s_suppkey").cast("string"), F.lit("_output.csv")).alias("file"))
    return tag_projects(f).select("file", "project", "n_files", "duplicated")


@register("crop_buckets", with_views(["boxes"], """
SELECT box_id, CASE WHEN label IS NULL THEN (CASE WHEN species IS NOT NULL AND species NOT IN ('Human', 'Vehicle')
                    THEN 'TRUE/Animal' ELSE 'TRUE/Other' END)
                    WHEN label = 'animal' THEN 'FP/Animal' ELSE 'FP/Other' END AS bucket,
       CASE WHEN species IS NULL OR species IN ('Human', 'Vehicle') THEN NULL
            ELSE replace(replace(species, ' ', '_'), '.', '') || '_' || box_id || '.JPG' END AS crop_name,
       label IS NULL AS is_tp
FROM (SELECT *, CASE WHEN species IS NULL THEN (CASE WHEN category_id = 1 THEN 'animal' ELSE 'person' END) END AS label
      FROM boxes) b"""))
def crop_buckets(spark, sf):
    """O21 + O22 + F8: crop category path, crop file name, true-positive flag."""
    b = S.boxes(spark, sf)
    b = b.withColumn("label", F.when(F.col("species").isNull(),
                                     F.when(F.col("category_id") == 1, "animal").otherwise("person")))
    b = O.crop_bucket(b, "label")
    b = O.flag_tp(b, "label")
    return b.select("box_id", "bucket", I.crop_name("species", "box_id").alias("crop_name"), "is_tp")


@register("species_list_filters", with_views(["boxes"], """
SELECT 'in_list' AS test, count(*) AS n FROM boxes WHERE species IN ('Moose', 'Caribou')
UNION ALL SELECT 'not_in_list', count(*) FROM boxes WHERE NOT (species IN ('Moose', 'Caribou'))
UNION ALL SELECT 'contains', count(*) FROM boxes WHERE contains(species, 'Bear')
UNION ALL SELECT 'not_null', count(*) FROM boxes WHERE species IS NOT NULL AND x IS NOT NULL"""))
def species_list_filters(spark, sf):
    """O8 + O16 + O17: list membership, substring filters, null drops."""
    b = S.boxes(spark, sf)
    parts = [("in_list", O.in_list(b, "species", ["Moose", "Caribou"])),
             ("not_in_list", O.in_list(b, "species", ["Moose", "Caribou"], negate=True)),
             ("contains", O.contains(b, "species", "Bear")),
             ("not_null", O.drop_nulls(b, ["species", "x"]))]
    out = None
    for name, d in parts:
        r = d.agg(F.count("*").alias("n")).select(F.lit(name).alias("test"), "n")
        out = r if out is None else out.unionByName(r)
    return out
