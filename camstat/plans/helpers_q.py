"""Projections, joins, reshaping and checks that have no table of their own in the survey
reports (O1-O4, J3, J4, J17, U5, U7, L6, R3, R5, A31, X9), and rows with null keys and payload
(W5, X9, A23, section 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from camstat.operators import aggregates as A
from camstat.operators import filters as O
from camstat.operators import images as IM
from camstat.operators import joins as J
from camstat.operators import metrics as M
from camstat.operators import reshape as R
from camstat.operators import spatial as SP
from camstat.operators import stats as ST
from camstat.operators import windows as W
from camstat.operators.reconcile import decide, reconcile
from camstat.plans import classify_q as CQ
from camstat.plans.identity import _EXPORTS_SQL, _LONG_TAGS_SQL, _exports, _long_tags
from camstat.plans.registry import register
from camstat.plans.sqlviews import with_views
from camstat.sources import adapters as S


@register("names_and_columns", with_views(["cameras"], """
SELECT lat AS gps_lat, camera_id, plot_id AS plot, site_id, lon AS gps_lon FROM cameras"""))
def names_and_columns(spark, sf):
    """O1 + O2 + O3: cleaned names, a column range, a suffix selection, rename and relocate."""
    raw = S.cameras(spark, sf).toDF("Camera ID", "plotId", "Site.ID", "GPSLon", "gps lat", "Habitat Type")
    d = O.select_range(O.clean_names(raw), "camera_id", "gps_lat")
    d = O.rename(O.select_suffix(d, "_id", keep=["gps_lon", "gps_lat"]), {"plot_id": "plot"})
    return O.relocate(d, ["gps_lat"])


@register("drawn_regions", with_views(["annotation_ids"], """
SELECT id, variable, tag FROM long_tags WHERE variable <> 'age'""", {"long_tags": _LONG_TAGS_SQL}))
def drawn_regions(spark, sf):
    """Rows of a drawn region (the rows of one variable belong to none)."""
    t = _long_tags(spark, sf).withColumn("to_name", F.when(F.col("variable") != "age", F.lit("image")))
    return O.non_empty(t).select("id", "variable", "tag")


@register("camera_nations", with_views(["cameras"], """
SELECT c.camera_id, n.n_name AS country FROM cameras c LEFT JOIN nation n
ON (CASE WHEN c.site_id % 5 = 0 THEN NULL ELSE c.site_id END) IS NOT DISTINCT FROM (CASE WHEN n.n_nationkey = 0 THEN NULL ELSE n.n_nationkey END)"""))
def camera_nations(spark, sf):
    """Join on differently named keys where a missing key matches a missing key."""
    cams = S.cameras(spark, sf).select("camera_id", F.when(F.col("site_id") % 5 != 0, F.col("site_id")).alias("site_id"))
    n = S.table(spark, sf, "nation").select(F.nullif("n_nationkey", F.lit(0)).alias("nation_key"), F.col("n_name").alias("country"))
    return J.join_on(cams, n, "site_id", "nation_key", null_safe=True).select("camera_id", "country")


# fixed values: class groups of the box species
GROUPS = {"Moose": "ungulate", "Caribou": "ungulate", "Black Bear": "carnivore", "Gray Wolf": "carnivore", "Sandhill Crane": "bird"}
_GROUPS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in GROUPS.items()) + ") AS t(species, grp)"


@register("one_hot_class_groups", with_views(["boxes"], """
SELECT b.box_id, """ + ", ".join(f"CASE WHEN g.grp = '{g}' THEN 1 ELSE 0 END AS {g}" for g in ("ungulate", "carnivore", "bird"))
    + " FROM boxes b LEFT JOIN class_groups g ON b.species = g.species", {"class_groups": _GROUPS_SQL}))
def one_hot_class_groups(spark, sf):
    """J4 + A8 + R7: classes joined to their groups, groups as one-hot columns."""
    groups = F.broadcast(R.named_list(spark, GROUPS, "species", "grp"))  # literal table
    return A.one_hot_groups(S.boxes(spark, sf), groups, ["box_id"], "species", "grp", ["ungulate", "carnivore", "bird"])


@register("bound_columns", with_views(["cameras", "deployments"], """
SELECT coalesce(c.camera_id, d.camera_id) AS camera_id, c.lon, strftime(d.date_deployed, '%Y-%m-%d') AS date_deployed
FROM (SELECT * FROM cameras WHERE camera_id % 3 <> 0) c FULL OUTER JOIN deployments d ON c.camera_id = d.camera_id"""))
def bound_columns(spark, sf):
    """Columns of two tables bound by row key, rows of either side kept."""
    c = S.cameras(spark, sf).filter(F.col("camera_id") % 3 != 0).select("camera_id", "lon")
    d = S.deployments(spark, sf).select("camera_id", F.date_format("date_deployed", "yyyy-MM-dd").alias("date_deployed"))
    return J.bind_by_key(c, d, "camera_id")


@register("literal_rows", with_views(["observations"], """
SELECT species, count(*) AS n FROM observations GROUP BY species UNION ALL SELECT 'Moose', 0 UNION ALL SELECT NULL, -1"""))
def literal_rows(spark, sf):
    """Rows written in code added to a table."""
    t = S.observations(spark, sf).groupBy("species").agg(F.count("*").alias("n"))
    return R.add_rows(t, [("Moose", 0), (None, -1)])


@register("camera_grid_counts", with_views(["cameras"], """
SELECT g.gx, g.gy, -90.0 + (g.gx + 0.5) * 0.5 AS x, 50.0 + (g.gy + 0.5) * 0.5 AS y, count(c.camera_id) AS n_cameras
FROM (SELECT gx, gy FROM range(0, 14) a(gx), range(0, 11) b(gy)) g LEFT JOIN cameras c
  ON floor((c.lon + 90.0) / 0.5) = g.gx AND floor((c.lat - 50.0) / 0.5) = g.gy GROUP BY g.gx, g.gy"""))
def camera_grid_counts(spark, sf):
    """U7 + J16: every node of the prediction grid with its number of cameras."""
    box = (-90.0, -83.0, 50.0, 55.5, 0.5)
    n = SP.grid_points(S.cameras(spark, sf), *box).filter(F.col("gx").isNotNull()).groupBy("gx", "gy").agg(F.count("*").alias("n_cameras"))
    g = R.grid(spark, *box)
    return J.join_back(g, n, ["gx", "gy"]).withColumn("n_cameras", F.coalesce("n_cameras", F.lit(0)))


@register("species_order", with_views(["observations"], """
SELECT species, avg(confidence) AS confidence_mean, row_number() OVER (ORDER BY avg(confidence) DESC NULLS LAST, species) AS level
FROM observations GROUP BY species"""))
def species_order(spark, sf):
    """Species ordered by their mean confidence."""
    return R.label_order(S.observations(spark, sf), "species", "confidence", desc=True)


@register("nested_orders", with_views([], """
SELECT l_orderkey, count(*) AS nr, sum(l_quantity) AS quantity, max(l_linenumber) AS last_line FROM lineitem GROUP BY l_orderkey"""))
def nested_orders(spark, sf):
    """Rows nested per key and unnested again."""
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    n = R.nest(li, ["l_orderkey"])
    back = R.unnest(n).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.max("l_linenumber").alias("last_line"))
    return n.groupBy("l_orderkey").agg(F.max("nr").alias("nr")).join(back, "l_orderkey")


@register("correlated_indices")
def correlated_indices(spark, sf):
    """Colour indices dropped so that no two kept ones correlate beyond 0.9, with their mean
    absolute correlation."""
    ci = IM.colour_indices(CQ._pixels(spark, sf), ["vec_id"])
    drop = ST.prune_correlated(ci, IM.INDEX_COLUMNS, 0.9)
    r = ST.correlations(ci, IM.INDEX_COLUMNS)
    both = r.select("a", "r").unionByName(r.select(F.col("b").alias("a"), "r"))
    return both.groupBy(F.col("a").alias("index")).agg(F.avg(F.abs("r")).alias("mean_abs_r")).withColumn(
        "dropped", F.col("index").isin(drop) if drop else F.lit(False))


@register("validation_folds", with_views([], """
SELECT label, (vec_id * 2654435761 + 42) % 4294967296 % 10 AS fold, count(*) AS n FROM embeddings GROUP BY 1, 2"""))
def validation_folds(spark, sf):
    """Ten folds by a seeded hash of the key."""
    e = S.table(spark, sf, "embeddings").select("vec_id", "label")
    return M.folds(e, "vec_id", 10, hash_col=M.portable_hash(F.col("vec_id"), 42)).groupBy("label", "fold").agg(F.count("*").alias("n"))


@register("observation_sequence_wide", with_views(["observations"], """
SELECT obs_id, camera_id, species, image_id, confidence, row_number() OVER (PARTITION BY species ORDER BY confidence, obs_id) AS seq
FROM observations"""))
def observation_sequence_wide(spark, sf):
    """Sequence numbers within species over rows that carry other columns."""
    o = S.observations(spark, sf).select("obs_id", "camera_id", "species", "image_id", "confidence")
    return W.seq_id(o, ["confidence", "obs_id"], by=["species"])


_NULL_CLASS_SQL = "SELECT vec_id, CASE WHEN label = 3 THEN NULL ELSE label END AS label, embedding[64] AS last_value FROM embeddings"


@register("stratified_split_nulls", f"""
SELECT vec_id, label, last_value, CASE WHEN rn <= round(n * 0.25) THEN 'eval' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY (vec_id * 2654435761 + 42) % 4294967296, vec_id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM ({_NULL_CLASS_SQL}) e) x""")
def stratified_split_nulls(spark, sf):
    """Hold-out per class where one class is null and rows carry another column."""
    e = S.table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("label") != 3, F.col("label")).alias("label"), F.col("embedding")[63].alias("last_value"))
    return M.split_stratified(e, "label", "vec_id", 0.25, 42)


@register("duplicate_null_keys", with_views(["boxes"], """
WITH b AS (SELECT box_id, folder, CASE WHEN category_id <> 2 THEN category_id END AS category_id FROM boxes),
c AS (SELECT folder, category_id, count(*) AS dupe_count FROM b GROUP BY folder, category_id HAVING count(*) > 1)
SELECT b.box_id, b.folder, b.category_id, c.dupe_count FROM b JOIN c ON b.folder = c.folder AND b.category_id IS NOT DISTINCT FROM c.category_id"""))
def duplicate_null_keys(spark, sf):
    """Repeated keys, null being one."""
    b = S.boxes(spark, sf).select("box_id", "folder", F.when(F.col("category_id") != 2, F.col("category_id")).alias("category_id"))
    return A.get_dupes(b, ["folder", "category_id"])


# The rules decided from sorted row lists, rule by rule as the survey describes them.
_ROWWISE_SQL = """
lists AS (SELECT source_file, list(struct_pack(id := id, sp := sp) ORDER BY id, sp) FILTER (orig = 1) AS l1,
                 list(struct_pack(id := id, sp := sp) ORDER BY id, sp) FILTER (orig = 2) AS l2,
                 list(struct_pack(id := id, sp := sp)) AS l
          FROM (SELECT source_file, orig, id, coalesce(species, 'None') AS sp FROM exports) r GROUP BY source_file),
facts AS (SELECT *, coalesce(len(l1), 0) AS n1, coalesce(len(l2), 0) AS n2,
                 len(list_filter(l, lambda x: x.sp <> 'None')) = 0 AS all_none,
                 len(list_filter(l, lambda x: regexp_matches(x.id, '^[+-]?[0-9]+$'))) AS n_num FROM lists),
ruled AS (SELECT *, CASE
    WHEN n1 = n2 AND l1 = l2 THEN 'D1'
    WHEN n1 = n2 AND n1 = 1 AND all_none AND n_num = 2 THEN 'D2'
    WHEN n1 = n2 AND n1 = 1 AND all_none AND n_num = 1 THEN 'D3'
    WHEN n1 > 0 AND n2 = 0 THEN 'D4' WHEN n2 > 0 AND n1 = 0 THEN 'D5'
    WHEN n1 <> n2 AND n_num = 1 AND all_none THEN 'D6' ELSE 'E' END AS rule FROM facts),
kept AS (SELECT source_file, rule, unnest(CASE rule
    WHEN 'D1' THEN l1 WHEN 'D4' THEN l1 WHEN 'D5' THEN l2
    WHEN 'D2' THEN [CASE WHEN CAST(l[1].id AS HUGEINT) <= CAST(l[2].id AS HUGEINT) THEN l[1] ELSE l[2] END]
    WHEN 'D3' THEN list_filter(l, lambda x: NOT regexp_matches(x.id, '^[+-]?[0-9]+$'))
    WHEN 'D6' THEN list_filter(l, lambda x: NOT regexp_matches(x.id, '^[+-]?[0-9]+$'))
    ELSE [] END) AS r FROM ruled)"""
_NULL_FILE_SQL = f"SELECT CASE WHEN source_file LIKE '%7.JPG' THEN NULL ELSE source_file END AS source_file, orig, id, species FROM ({_EXPORTS_SQL}) x"


@register("reconcile_rowwise", with_views(["annotation_ids"], f"""
WITH {_ROWWISE_SQL} SELECT source_file, r.id AS id, nullif(r.sp, 'None') AS species, rule FROM kept""", {"exports": _EXPORTS_SQL}))
def reconcile_rowwise(spark, sf):
    """Section 2.9 against rules decided on sorted row lists."""
    kept, _ = reconcile(_exports(spark, sf))
    return kept


@register("reconcile_null_file", with_views(["annotation_ids"], f"""
WITH {_ROWWISE_SQL}
SELECT source_file, rule, n1, n2 FROM ruled""", {"exports": _NULL_FILE_SQL}))
def reconcile_null_file(spark, sf):
    """Section 2.9: rows without a file name are one file and get a rule."""
    e = _exports(spark, sf).withColumn("source_file", F.when(~F.col("source_file").endswith("7.JPG"), F.col("source_file")))
    return decide(e, ["source_file"]).select("source_file", "rule", "n1", "n2")


def _with_null(df, row: dict):
    """``df`` and one more row, whose other columns (the key) are null."""
    one = df.sparkSession.range(1).select(*[F.lit(row.get(c)).cast(t).alias(c) for c, t in df.dtypes])
    return df.unionByName(one)


@register("null_key_joins", with_views(["cameras", "boxes"], """
WITH c AS (SELECT camera_id AS k, lon AS v FROM cameras UNION ALL SELECT NULL, 1.0),
d AS (SELECT camera_id AS k, lat AS w FROM cameras WHERE camera_id % 3 <> 0 UNION ALL SELECT NULL, 2.0),
p AS (SELECT species AS truth, CASE WHEN category_id = 0 THEN NULL ELSE species END AS pred FROM boxes)
SELECT 'J1' AS operator, count(*) AS n, count(w) AS matched FROM c LEFT JOIN d ON c.k IS NOT DISTINCT FROM d.k
UNION ALL SELECT 'J8', sum(t.n), sum(r.n) FROM (SELECT truth, count(*) AS n FROM p GROUP BY truth) t JOIN (SELECT pred, count(*) AS n FROM p GROUP BY pred) r ON t.truth IS NOT DISTINCT FROM r.pred
UNION ALL SELECT 'J9', count(*), count(*) FILTER (WHERE b.k IS NOT DISTINCT FROM u.k AND u.x = 1) FROM c b LEFT JOIN (SELECT *, 1 AS x FROM d) u ON b.k IS NOT DISTINCT FROM u.k
UNION ALL SELECT 'J13', count(*), count(*) FILTER (WHERE c.k IS NULL) FROM c FULL JOIN d ON c.k IS NOT DISTINCT FROM d.k
UNION ALL SELECT 'J17', count(*), count(*) FILTER (WHERE w IS NOT NULL AND v IS NOT NULL) FROM c FULL JOIN d ON c.k IS NOT DISTINCT FROM d.k
UNION ALL SELECT 'S18', count(*), 0 FROM c WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.k IS NOT DISTINCT FROM c.k)
UNION ALL SELECT 'A28', count(*) FILTER (WHERE truth IS NULL), count(*) FILTER (WHERE truth IS NULL AND pred IS NULL) FROM p"""))
def null_key_joins(spark, sf):
    """J1, J8, J9, J13, J17, S18, A28 over whole tables with one more row whose key is null: rows and matches of each."""
    from camstat.operators import metrics as M
    from camstat.sources import readers as RD
    cams = S.cameras(spark, sf)
    c = _with_null(cams.select(F.col("camera_id").alias("k"), F.col("lon").alias("v")), {"v": 1.0})
    d = _with_null(cams.filter(F.col("camera_id") % 3 != 0).select(F.col("camera_id").alias("k"), F.col("lat").alias("w")), {"w": 2.0})
    p = S.boxes(spark, sf).select(F.col("species").alias("truth"), F.when(F.col("category_id") != 0, F.col("species")).alias("pred"))
    n = F.count("*").alias("n")
    rows = [
        ("J1", J.join_exif(c, d, ["k"]).agg(n, F.count("w").alias("matched"))),
        ("J8", J.pred_vs_real(p.select(F.col("pred").alias("class")), p.select(F.col("truth").alias("class"))).agg(F.sum("n_true").alias("n"), F.sum("n_pred").alias("matched"))),
        ("J9", J.overlay_annotations(c.select("k", F.lit(1).alias("x")), d.select("k", F.lit(1).alias("x")), "k", "x").agg(n, F.count_if("from_update").alias("matched"))),
        ("J13", J.first_non_null(c, d.withColumnRenamed("w", "v"), "k", ["v"]).agg(n, F.count_if(F.col("k").isNull()).alias("matched"))),
        ("J17", J.bind_by_key(c, d, "k").agg(n, F.count_if(F.col("v").isNotNull() & F.col("w").isNotNull()).alias("matched"))),
        ("S18", RD.pending(c, d, "k").agg(n, F.lit(0).cast("long").alias("matched"))),
        ("A28", M.class_metrics(p).filter(F.col("class").isNull()).select((F.col("tp") + F.col("fn")).alias("n"), F.col("tp").alias("matched"))),
    ]
    out = None
    for name, df in rows:
        own = df.select(F.lit(name).alias("operator"), F.col("n").cast("long").alias("n"), F.col("matched").cast("long").alias("matched"))
        out = own if out is None else out.unionByName(own)
    return out


@register("split_by_species", with_views(["boxes"], "SELECT species, count(*) AS n, sum(w * h) AS area FROM boxes GROUP BY species"))
def split_by_species(spark, sf):
    """Boxes written as one folder per species (null is one) and read back."""
    from camstat.session import shared_path
    path = shared_path(spark, "split")
    R.split_write(S.boxes(spark, sf).select("species", "w", "h"), ["species"], path)
    return spark.read.parquet(path).groupBy("species").agg(F.count("*").alias("n"), F.sum(F.col("w") * F.col("h")).alias("area"))
