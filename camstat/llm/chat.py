"""Chat formatting in DataFrame operations only.

Turns of a conversation are collected as structs, sorted, and adjacent turns of one role are
merged into a block; blocks are concatenated under this template:

    <|turn|>ROLE<|text|>TEXT<|more|>TEXT ...<|end|>

Every string in ``CONTROL`` (the template's own marks and common chat marks) that occurs in a
role or text is escaped by a backslash after its first character; strings that already hold
such backslashes get one more, so unescaping returns the exact text.

Turns are collected in two levels: first per (conversation, range of turn numbers), where texts
are escaped and merged, then per conversation, where only finished blocks meet.  The formatted
conversation itself is one value, so its size bounds the second level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
#: Strings that a text must not bring into the output unescaped.
CONTROL = (TURN, TEXT, MORE, END, "<s>", "</s>", "[INST]", "[/INST]")
#: CONTROL as one pattern: first character, backslashes so far, the rest.
_MARK = r"([<\[])(\\*)(/?s>|/?INST\]|\|(?:turn|text|more|end)\|>)"
#: Turn numbers collected together at the first level.
RANGE = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_MARK), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_MARK.replace(r"(\\*)", r"\\(\\*)")), F.lit("$1$2$3"))


def _merge(blocks: Column) -> Column:
    """Adjacent blocks of one role as one block: struct(role, texts)."""
    last = F.size(blocks) - 1
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: (i == 0) | (F.get(blocks, i)["role"] != F.get(blocks, i - 1)["role"]))

    def one(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(blocks))
        return F.struct(
            F.get(blocks, start)["role"].alias("role"),
            F.flatten(F.transform(F.slice(blocks, start + 1, end - start), lambda b: b["texts"])).alias("texts"))

    return F.transform(starts, one)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its key, ``formatted`` string, and ``segments``
    array<struct<text, loss>> whose texts concatenate to ``formatted``; ``loss`` marks the
    texts of ``loss_role``, without headers or separators (the training loss mask).

    Order: turn (nulls first), then role, then text, so ties and repeated rows are kept and
    placed alike on every run.  Null text or role: empty string.  A null key is a conversation
    of its own.  Further columns are ignored; no rows give no rows."""
    rows = turns.select(
        F.col(conv).alias("__conv"), F.col(turn).alias("__turn"),
        F.coalesce(F.col(role), F.lit("")).alias("__role"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    part = (
        rows.groupBy("__conv", F.floor(F.col("__turn") / RANGE).alias("__range"))
        .agg(F.sort_array(F.collect_list(F.struct("__turn", "__role", "__text"))).alias("__turns"))
        .select("__conv", "__range", F.transform("__turns", lambda t: F.struct(
            escape(t["__role"]).alias("role"), F.array(escape(t["__text"])).alias("texts"))).alias("__each"))
        .select("__conv", "__range", _merge(F.col("__each")).alias("__blocks"))
    )
    whole = (
        part.groupBy("__conv")
        .agg(F.sort_array(F.collect_list(F.struct("__range", "__blocks"))).alias("__parts"))
        .select("__conv", F.flatten(F.transform("__parts", lambda p: p["__blocks"])).alias("__blocks"))
        .select("__conv", _merge(F.col("__blocks")).alias("__blocks"))
    )

    def piece(s: Column, loss: Column) -> Column:
        return F.struct(s.alias("text"), loss.alias("loss"))

    def segments(b: Column) -> Column:
        under = b["role"] == escape(F.lit(loss_role))
        texts = F.flatten(F.transform(b["texts"], lambda t, i: F.when(
            i > 0, F.array(piece(F.lit(MORE), F.lit(False)), piece(t, under))).otherwise(F.array(piece(t, under)))))
        return F.concat(
            F.array(piece(F.concat(F.lit(TURN), b["role"], F.lit(TEXT)), F.lit(False))), texts,
            F.array(piece(F.lit(END), F.lit(False))))

    return (
        whole.select(F.col("__conv").alias(conv), F.flatten(F.transform("__blocks", segments)).alias("segments"))
        .select(conv, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>, unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        head = F.split(b, r"<\|text\|>", 2)
        name = unescape(F.substring(F.get(head, F.lit(0)), len(TURN) + 1, 2**31 - 1))
        texts = F.split(F.get(head, F.lit(1)), r"<\|more\|>", -1)
        return F.transform(texts, lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
