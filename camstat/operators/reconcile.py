"""Duplicate-export reconciliation (S3, section 2.9 rules D1-D6 / E).

A project exported twice gives two annotation files.  Per ``source_file`` the
rows of export 1 and export 2 are compared and one side (or some rows) kept:

=====  ==========================================================  ==============
rule   condition (n1, n2 rows per export; None = no species)         keep
=====  ==========================================================  ==============
D1     n1 = n2, same (id, species) rows                              export 1
D2     n1 = n2 = 1, both None, ids differ, both ids numeric          smaller id
D3     n1 = n2 = 1, both None, ids differ, exactly one numeric id    non-numeric
D4     n2 = 0                                                        export 1
D5     n1 = 0                                                        export 2
D6     n1 != n2 (both > 0), all None, exactly one numeric id         non-numeric
E      anything else                                                 -> conflicts
=====  ==========================================================  ==============

The decision is pure aggregation: rows are first counted per
``(file, id, species)`` and export (map-side combined), then summarised per
file -- no per-file row lists are ever collected, so a huge file is as cheap
as a small one.  Conflicting files go to a quarantine frame instead of
stopping the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camstat.functions.ids import first_tokens, is_numeric_id, numeric_order
from camstat.operators.joins import join_back

# fixed values: storage names aliased in export file names
STORAGE_ALIASES = [("TrailCamStorage_2", "T2"), ("TrailCamStorage", "T1")]
NONE = "None"


def project_key(file_col: str = "file") -> F.Column:
    """S3: project = first two ``_`` tokens of the file's base name after the
    storage aliases are applied."""
    base = F.element_at(F.split(F.col(file_col), "/"), -1)
    for a, b in STORAGE_ALIASES:
        base = F.replace(base, F.lit(a), F.lit(b))
    return first_tokens(base, 2)


def tag_projects(files: DataFrame, file_col: str = "file") -> DataFrame:
    """S3: add ``project`` and ``n_files``; ``duplicated`` when a project has more
    than one export file."""
    f = files.withColumn("project", project_key(file_col))
    n = f.groupBy("project").agg(F.count_distinct(file_col).alias("n_files"))
    return join_back(f, n, ["project"], "inner").withColumn("duplicated", F.col("n_files") > 1)


def decide(rows: DataFrame, key: list[str], orig: str = "orig", id_col: str = "id",
           species: str = "species", numeric_rule: str = "cast") -> DataFrame:
    """Per-file decision: ``key + [rule, keep_orig, min_numeric_id]``.  Rows without a
    file are one file.  ``min_numeric_id`` is the smallest ``numeric_order`` of its ids."""
    sp = F.coalesce(F.col(species), F.lit(NONE))
    r = rows.select(*key, orig, id_col, sp.alias("_sp"),
                    is_numeric_id(id_col, numeric_rule).alias("_num"))
    pair = (r.groupBy(*key, id_col, "_sp", "_num")
            .agg(F.count_if(F.col(orig) == 1).alias("_c1"), F.count_if(F.col(orig) == 2).alias("_c2")))
    num_val = F.when(F.col("_num"), numeric_order(id_col))
    f = pair.groupBy(*key).agg(
        F.sum("_c1").alias("n1"), F.sum("_c2").alias("n2"),
        F.count_if(F.col("_c1") != F.col("_c2")).alias("_mismatch"),
        F.bool_and(F.col("_sp") == NONE).alias("_all_none"),
        F.sum(F.when(F.col("_num"), F.col("_c1") + F.col("_c2")).otherwise(0)).alias("_n_num"),
        F.min(num_val).alias("min_numeric_id"))
    n1, n2 = F.col("n1"), F.col("n2")
    rule = (F.when((n1 == n2) & (F.col("_mismatch") == 0), F.lit("D1"))
            .when((n1 == 1) & (n2 == 1) & F.col("_all_none") & (F.col("_n_num") == 2), F.lit("D2"))
            .when((n1 == 1) & (n2 == 1) & F.col("_all_none") & (F.col("_n_num") == 1), F.lit("D3"))
            .when(n2 == 0, F.lit("D4"))
            .when(n1 == 0, F.lit("D5"))
            .when((n1 != n2) & F.col("_all_none") & (F.col("_n_num") == 1), F.lit("D6"))
            .otherwise(F.lit("E")))
    keep = F.when(rule.isin("D1", "D4"), F.lit(1)).when(rule == "D5", F.lit(2))
    return f.select(*key, rule.alias("rule"), keep.alias("keep_orig"), "min_numeric_id", "n1", "n2")


def reconcile(rows: DataFrame, key: list[str] | None = None, orig: str = "orig",
              id_col: str = "id", species: str = "species",
              numeric_rule: str = "cast") -> tuple[DataFrame, DataFrame]:
    """Reconcile two exports.  ``rows`` carries ``orig`` (1 or 2).  Returns
    ``(kept, conflicts)``: kept rows (``orig`` dropped, "None" species -> null,
    ``rule`` added) and the rows of files that match no rule."""
    key = key or ["source_file"]
    d = decide(rows, key, orig, id_col, species, numeric_rule)
    j = join_back(rows, d, key, "inner")
    num = is_numeric_id(id_col, numeric_rule)
    keep = (F.when(F.col("rule").isin("D1", "D4", "D5"), F.col(orig) == F.col("keep_orig"))
            .when(F.col("rule") == "D2", num & (numeric_order(id_col) == F.col("min_numeric_id")))
            .when(F.col("rule").isin("D3", "D6"), ~num)
            .otherwise(F.lit(False)))
    kept = (j.filter(keep)
            .withColumn(species, F.nullif(F.col(species), F.lit(NONE)))
            .drop(orig, "keep_orig", "min_numeric_id", "n1", "n2"))
    conflicts = j.filter(F.col("rule") == "E").drop("keep_orig", "min_numeric_id")
    return kept, conflicts


def process_annotations(wide: DataFrame, file_col: str = "file", key: list[str] | None = None,
                        numeric_rule: str = "cast") -> tuple[DataFrame, DataFrame]:
    """Whole flow on wide annotations carrying their export ``file``: projects with
    one file pass through; projects with exactly two files are reconciled
    (export 1 = the first file name); projects with more go to conflicts (Q7)."""
    key = key or ["project", "source_file"]
    # project facts come from the small table of files, so the rows are joined once
    files = tag_projects(wide.select(file_col).distinct(), file_col)
    per_file = join_back(files, files.groupBy("project").agg(F.min(file_col).alias("_first")), ["project"], "inner")
    t = join_back(wide, per_file.withColumn(
        "orig", F.when(F.col(file_col).eqNullSafe(F.col("_first")), 1).otherwise(2)).drop("_first", "duplicated"), [file_col], "inner")
    single = t.filter(F.col("n_files") < 2).drop("n_files", "orig")
    single = single.withColumn("species", F.nullif(F.col("species"), F.lit(NONE)))
    kept, conflicts = reconcile(t.filter(F.col("n_files") == 2).drop("n_files"), key, numeric_rule=numeric_rule)
    too_many = t.filter(F.col("n_files") > 2).drop("orig")
    out = single.unionByName(kept.drop("rule"), allowMissingColumns=True)
    return out, conflicts.unionByName(too_many, allowMissingColumns=True)
