"""Projections, filters and row predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camstat.functions.ids import token_count

# fixed values: species labels the observation filters exclude
NON_ANIMALS = ["Human", "Vehicle"]
UNKNOWN = "Unknown"
OTHER_SPECIES = "Other [See more species]"
# fixed values: detector category codes
CATEGORY_LABELS = {0: "Empty", 1: "Animal", 2: "Person", 3: "Vehicle"}


def snake_case(name: str) -> str:
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9a-zA-Z]+", "_", s).strip("_").lower()
    return s or "x"


def clean_names(df: DataFrame) -> DataFrame:
    """O1: snake_case every column name; duplicates get ``_2``, ``_3`` suffixes."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = snake_case(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return df.toDF(*out)


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """O2: columns ``first:last`` inclusive, in schema order."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return df.select(*cols[i:j + 1])


def select_suffix(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    """O2: keep columns named ``*suffix`` (plus ``keep``)."""
    keep = list(keep)
    return df.select(*keep, *[c for c in df.columns if c.endswith(suffix) and c not in keep])


def relocate(df: DataFrame, cols: list[str]) -> DataFrame:
    """O3: move ``cols`` to the front."""
    return df.select(*cols, *[c for c in df.columns if c not in cols])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """O3."""
    return df.withColumnsRenamed(mapping)


def non_empty(df: DataFrame, col: str = "to_name") -> DataFrame:
    """Rows that belong to a drawn region."""
    return df.filter(F.col(col).isNotNull())


def animals_only(df: DataFrame, species: str = "species", id_col: str = "id",
                 drop_unknown: bool = True) -> DataFrame:
    """Not Human, not Vehicle, at least two id tokens, not Unknown.
    ``!=`` drops null species, as in the source."""
    cond = ~F.col(species).isin(*NON_ANIMALS) & (token_count(id_col) > 1)
    if drop_unknown:
        cond = cond & (F.col(species) != UNKNOWN)
    return df.filter(cond)


def above(df: DataFrame, t: float, col: str = "confidence", inclusive: bool = False) -> DataFrame:
    """Confidence threshold."""
    c = F.col(col)
    return df.filter(c >= t if inclusive else c > t)


def mark_filtered(df: DataFrame, t: float = 0.1, col: str = "confidence") -> DataFrame:
    """Keep ``> t`` or ``< 0`` (suppressed repeats) and flag the latter."""
    c = F.col(col)
    return df.filter((c > t) | (c < 0)).withColumn("filtered_out", c < 0)


def drop_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """O8."""
    return df.dropna(how="any", subset=cols)


def category_label(col: str = "category_id") -> Column:
    """Detector category code -> label."""
    c = F.col(col).cast("int")
    e = F.lit(None).cast("string")
    for k in sorted(CATEGORY_LABELS, reverse=True):
        e = F.when(c == k, F.lit(CATEGORY_LABELS[k])).otherwise(e)
    return e


def label_category(df: DataFrame, col: str = "category_id", out: str = "type") -> DataFrame:
    return df.withColumn(out, category_label(col))


def resolve_species(df: DataFrame, species: str = "species", other: str = "other_species") -> DataFrame:
    """The catch-all label is replaced by the free-text species."""
    return df.withColumn(species, F.when(F.col(species) == OTHER_SPECIES, F.col(other))
                         .otherwise(F.col(species)))


def drop_comments(df: DataFrame, col: str = "value_text") -> DataFrame:
    """Region rows only."""
    return df.filter(F.col(col).isNull())


def none_to_null(df: DataFrame, col: str = "species") -> DataFrame:
    """``"None"`` -> null."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit("None")))


def null_to_none(df: DataFrame, col: str = "species") -> DataFrame:
    """Null -> ``"None"``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit("None")))


def deployment_status(df: DataFrame, deployed: str = "date_deployed",
                      retrieved: str = "date_retrieved") -> DataFrame:
    """``is_retrieved`` and ``status`` (valid only when deployed < retrieved)."""
    d, r = F.col(deployed), F.col(retrieved)
    return df.withColumns({
        "is_retrieved": r.isNotNull(),
        "status": F.when(r.isNotNull() & (d < r), F.lit("valid")).otherwise(F.lit("invalid")),
    })


def merge_classes(long: DataFrame, spec: dict[str, list[str]], key: list[str],
                  cls: str = "class", val: str = "value") -> DataFrame:
    """Merge classes on the long form: parts listed in ``spec`` are summed into
    their target class; other classes pass through."""
    m = F.col(cls)
    for target, parts in spec.items():
        m = F.when(F.col(cls).isin(*parts), F.lit(target)).otherwise(m)
    return (long.withColumn(cls, m).groupBy(*key, cls).agg(F.sum(val).alias(val)))


def patch(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """Targeted value patch; non-matching rows are untouched."""
    return df.withColumns({k: F.when(predicate, v).otherwise(F.col(k)) for k, v in values.items()})


def contains(df: DataFrame, col: str, s: str, negate: bool = False) -> DataFrame:
    """Fixed-substring filter."""
    c = F.col(col).contains(s)
    return df.filter(~c if negate else c)


def in_list(df: DataFrame, col: str, values: list, negate: bool = False) -> DataFrame:
    """O17."""
    c = F.col(col).isin(*values)
    return df.filter(~c if negate else c)


def nonzero_time(df: DataFrame, col: str = "time_of_day") -> DataFrame:
    """O18."""
    return df.filter(F.col(col) != 0)


def fill0(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """O19."""
    return df.fillna(0, subset=cols)


def columns_by_sum(long: DataFrame, col: str, val: str, min_total: float,
                   inclusive: bool = False) -> DataFrame:
    """Keep long-form rows whose column (``col``) total passes ``min_total``
    (drop all-zero columns with ``min_total=0``)."""
    tot = long.groupBy(col).agg(F.sum(val).alias("_tot"))
    keep = tot.filter(F.col("_tot") >= min_total if inclusive else F.col("_tot") > min_total)
    return long.join(keep.select(col), col, "left_semi")


def flag_tp(df: DataFrame, label: str = "original_label", out: str = "is_tp") -> DataFrame:
    """True positive = no original false-positive label."""
    return df.withColumn(out, F.col(label).isNull())


def flag_correct(df: DataFrame, truth: str, pred: str, out: str = "correct") -> DataFrame:
    """O21."""
    return df.withColumn(out, F.col(truth) == F.col(pred))


def crop_bucket(df: DataFrame, label: str = "value_rectanglelabels",
                species: str = "species", out: str = "bucket") -> DataFrame:
    """Crop category path.  No label -> ``TRUE/Animal`` or ``TRUE/Other``;
    label ``animal`` -> ``FP/Animal``; any other label -> ``FP/Other``."""
    lab, sp = F.col(label), F.col(species)
    tp = F.when(sp.isNotNull() & ~sp.isin(*NON_ANIMALS), F.lit("TRUE/Animal")).otherwise(F.lit("TRUE/Other"))
    return df.withColumn(out, F.when(lab.isNull(), tp)
                         .when(lab == "animal", F.lit("FP/Animal"))
                         .otherwise(F.lit("FP/Other")))


def route_wildlife(df: DataFrame, path: str = "path", out: str = "route") -> DataFrame:
    """``NW`` for NonWildlife folders, ``W`` for Wildlife, null otherwise
    (NonWildlife is tested first because it contains Wildlife)."""
    p = F.col(path)
    return df.withColumn(out, F.when(p.contains("NonWildlife"), F.lit("NW"))
                         .when(p.contains("Wildlife"), F.lit("W")))
