"""The corpus pipeline: documents -> training ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame; ``run`` writes it as Parquet in the shared folder and hands the reread table to the next.
All stages but the last return the columns of ``documents`` (further columns pass through).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.llm import bpe, mixing, secretscan, simhash, toxicity
from camstat.llm.common import digest, table, written
from camstat.llm.queries import REPEAT, TOXIC, tokenizer, toxicity_model


def _one_row_each(df: DataFrame, keys: list[str], repeated: DataFrame) -> DataFrame:
    """One row for each value of ``keys``: the one with the smallest text hash, then text.  Combines
    before the shuffle, so a key with very many rows is fine.  ``repeated``: the keys of all rows in
    a narrow table; if none occurs twice, ``df`` is returned untouched."""
    if not repeated.groupBy(*keys).count().where("count > 1").limit(1).count():
        return df
    first = F.min_by(F.struct(*df.columns), F.struct(F.xxhash64("text"), F.col("text")))
    return df.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).agg(first.alias("__row")).select("__row.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the model is fitted on these documents' labels outside
    the held-out part.  Null and empty texts score as clean as the model finds an empty text.
    Without labels of both kinds nothing scores high and all documents stay."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scorer(spark, model)(F.col("text")) < TOXIC)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id (nulls last),
    then the smallest text digest.

    Groups are told apart by their fingerprints: rows with a null or repeated doc_id whose texts are
    no near-duplicates all stay.  Rows equal in doc_id and text are one document.  Null and empty
    texts have fingerprint 0 and form one group."""
    first = written(simhash.survivors(docs, words=3), "stage-groups").select(
        F.col("doc_id").alias("__first"), F.col("digest").alias("__of"))
    own = docs.withColumn("__digest", digest(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("__digest") == F.col("__of"))
    keys = ["doc_id", "__digest"]
    kept = written(own.join(first, same, "left_semi"), "stage-kept")
    return _one_row_each(kept, keys, kept.select(*keys)).select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by ``[SECRET]``; n_chars follows where a text changed.
    Null texts stay null."""
    clean = secretscan.redact(spark, secretscan.identifiers(docs))
    out = docs.withColumn("__clean", clean(F.col("text")))
    if "n_chars" in docs.columns:
        changed = ~F.col("__clean").eqNullSafe(F.col("text"))
        out = out.withColumn("n_chars", F.when(changed, F.char_length("__clean").cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__clean")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: every document at least once, rows of lifted sources repeated, no source over
    ``REPEAT`` times.  Files hold whole blocks, blocks hold their rows in the mixed order.

    Rows equal in doc_id, source and text are one document.  Null sources are one source."""
    plan = mixing.mix(docs, mixing.Target(repeat=REPEAT), told_by="told").select(
        *[F.col(c).alias(f"__{c}") for c in ("doc_id", "source", "told", "block", "slot")])
    keyed = docs.withColumn("__digest", digest(F.col("text")))
    keys = ["doc_id", "source", "__digest"]
    keyed = _one_row_each(keyed, keys, keyed.select(*keys))
    same = [F.col("doc_id").eqNullSafe(F.col("__doc_id")), F.col("source").eqNullSafe(F.col("__source")), F.col("__digest") == F.col("__told")]
    mixed = keyed.join(plan, same[0] & same[1] & same[2])
    return mixed.repartition("__block").sortWithinPartitions("__block", "__slot").select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ids (little-endian unsigned 32-bit integers) in place of its text; null and
    empty texts have none."""
    encode = bpe.encode(spark, tokenizer("word_bpe_49k.json"))
    ids = docs.withColumn("ids", encode(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return ids.select(*[c for c in docs.columns if c not in ("text", "ids", "n_tokens")],
                      (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", simhash_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL can express neither the trained scorer, the fingerprints nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
