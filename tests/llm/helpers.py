"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import duckdb
import public_tokenizers

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

#: null and empty texts, ties, repeated rows, null keys and sources, control strings, a long text.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "a"),
    (3, None, "b"),
    (4, "", "b"),
    (5, "   \n\t ", None),
    (6, "I'll say: ÅÁÉ é 12 <|endoftext|> x<|startoftext|>y    tabs\tand\x0bmore end", "c"),
    (7, "word " * 30_000, "a"),
    (None, "no id here at all", None),
    (8, "中文 \U0001f600\U0001f600 mixed 12.5% <s>[INST] ok [/INST]</s>", "c"),
    (9, "a" * 5_000 + "é" * 3_000, "c"),
]


def docs(spark, rows=None, extra=True):
    """documents with two more columns whose names clash with the operators' own."""
    df = spark.createDataFrame(DOCS if rows is None else rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "'x' AS fp", "1 AS key", "2 AS shard") if extra else df


def duck(sql: str, sf: str = SF):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.execute(sql).df()


def same(a, b) -> None:
    """Two pandas tables hold the same rows."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    rows = [sorted(map(tuple, x[cols].astype(object).where(x[cols].notna(), None).values.tolist()), key=repr) for x in (a, b)]
    assert rows[0] == rows[1]
