"""Temperature mixing of sources.

With p_i the share of source i in all tokens, weights are p_i^a / sum of p_j^a.  The exponent a is
found by bisection: the smallest a in [0, 1] at which no source is repeated more than ``repeat``
times, or the a in [0, 8] at which the weights have a target entropy.  The weights are then realised
as a stream of blocks: every source is laid out as one seeded permutation of its rows per pass
(epoch), passes follow each other up to the source's token budget, and the layout is cut so that
each block takes its weighted share from each source.  Inside a block rows stand in seeded order.

Without a given budget the stream is the shortest one that holds every row at least once, so mixing
repeats rows of lifted sources and drops none.

Bisection runs six halvings at a time: one aggregation over the table of sources evaluates 63
exponents, so any number of sources is fine and only 63 numbers reach the driver.  Layouts are
running sums over (source, epoch, hash range) cells, then inside a cell; a source with a third of
all rows is spread over all its cells, and nothing is sorted whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camstat.llm.common import digest, written

#: Halvings in one pass over the sources, and passes: the exponent is exact to 2^-24 of its range.
HALVINGS, PASSES = 6, 4
#: Rows aimed at in one cell, and fewest cells of a source.
CELL_ROWS, MIN_CELLS = 20_000, 64


def words(text: Column) -> Column:
    """Tokens of a text for mixing: white-space characters plus one; at least 1 (null: 1)."""
    t = F.coalesce(text, F.lit(""))
    return (F.char_length(t) - F.char_length(F.translate(t, " \t\n\r", "")) + 1).cast("long")


@dataclass
class Target:
    """``repeat``: most passes over any source; or ``entropy``: of the weights, in nats."""

    repeat: float | None = None
    entropy: float | None = None

    def top(self) -> float:
        return 1.0 if self.entropy is None else 8.0

    def reached(self, at: Column, shares: Column) -> Column:
        """Aggregate over sources, true from the wanted exponent on."""
        w = F.pow(shares, at)
        if self.entropy is None:
            # passes over source i = weight * budget / tokens; the normaliser cancels
            return F.max(w / shares) * F.max(shares / w) <= F.lit(float(self.repeat))
        z = F.sum(w)
        return F.log(z) - F.sum(w * at * F.log(shares)) / z <= F.lit(float(self.entropy))


def exponent(sources: DataFrame, target: Target) -> float:
    """Bisected exponent for sources(share > 0).  The range's end if the target is not met before."""
    low, high = 0.0, target.top()
    if sources.select(F.lit(1)).limit(1).count() == 0:
        return high
    if sources.agg(target.reached(F.lit(low), F.col("share"))).first()[0]:
        return low
    for _ in range(PASSES):
        step = (high - low) / 2**HALVINGS
        grid = [low + step * j for j in range(1, 2**HALVINGS)]
        met = (
            sources.select("share", F.explode(F.array(*map(F.lit, grid))).alias("at"))
            .groupBy("at").agg(target.reached(F.col("at"), F.col("share")).alias("met")).where("met")
            .agg(F.min("at")).first()[0])
        high = met if met is not None else high
        low = high - step
    return high


def _running(df: DataFrame, groups: list[str], cell: str, order: list, amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over earlier rows of the group, in order of
    (cell, order).  Cells are summed first and their sums accumulated, so no group meets whole."""
    keys = [*groups, cell]
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("__cell_sum"))
    before = F.sum("__cell_sum").over(Window.partitionBy(*groups).orderBy(cell)) - F.col("__cell_sum")
    sums = sums.select(*[F.col(k).alias(f"__k_{k}") for k in keys], before.alias("__before"))
    inside = F.sum(amount).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount)
    same = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    return (
        df.withColumn("__inside", inside).join(sums, same)
        .withColumn(name, F.col("__before") + F.col("__inside"))
        .drop("__inside", "__before", *[f"__k_{k}" for k in keys]))


def mix(df: DataFrame, target: Target, key: str = "doc_id", source: str = "source", tokens: Column | None = None,
        budget: int | None = None, block_tokens: int = 1_000_000, seed: str = "mix", told_by: str | None = None) -> DataFrame:
    """The mixed stream: (key, source, n_tokens, epoch, block, slot), one row for each use of a row.

    A row's tokens count at least 1; ``tokens`` defaults to ``words`` of column ``text``.  Rows equal
    in key, source, tokens and text are one document and are used once an epoch; where only the text
    differs they are documents of their own (without a column ``text`` nothing tells them apart).
    ``told_by`` names a further result column, the digest of the text.  Null sources are one source;
    null keys are ordered by the digest.  ``budget``: tokens of the whole stream; None:
    the shortest stream with every row at least once.  An empty table gives an empty stream."""
    count = words(F.col("text")) if tokens is None else F.greatest(tokens.cast("long"), F.lit(1))
    apart = digest(F.col("text")) if "text" in df.columns else F.lit("")
    rows = written(
        df.select(F.col(key).alias("key"), F.col(source).alias("source"), count.alias("n_tokens"), apart.alias("digest")).distinct()
        .withColumn("src", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))), "mix-rows")
    totals = rows.groupBy("src").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("n_rows"))
    whole, n_rows = totals.agg(F.sum("total"), F.sum("n_rows")).first()
    if not n_rows:
        whole, n_rows = 1, 1
    sources = written(totals.withColumn("share", F.col("total") / F.lit(float(whole))), "mix-sources")
    a = exponent(sources, target)
    power = F.pow("share", F.lit(a))
    z, longest = sources.agg(F.sum(power), F.max(F.col("total") / power)).first()
    if not z:
        z, longest = 1.0, 1.0
    stream = float(budget) if budget is not None else longest * z
    blocks = max(1, -(-int(stream) // block_tokens))
    cells = max(MIN_CELLS, -(-n_rows // CELL_ROWS))
    plan = sources.select(
        F.col("src").alias("of"), "total",
        F.floor(power / F.lit(z) * F.lit(stream) + F.lit(0.5)).cast("long").alias("budget")
    ).withColumn("share_of_block", F.greatest(F.lit(1), F.expr(f"(budget + {blocks - 1}) div {blocks}")))
    used = (
        rows.join(plan, F.col("src") == F.col("of"))
        .withColumn("epoch", F.explode(F.expr("sequence(0L, greatest(0L, (budget - 1) div total))")))
        .withColumn("hash", F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch"), F.coalesce(F.col("key").cast("string"), F.col("digest")))))
        .withColumn("cell", F.expr(f"cast(conv(substr(hash, 1, 8), 16, 10) as bigint) * {cells} div 4294967296L")))
    laid = (
        _running(used, ["src", "epoch"], "cell", ["hash", "key", "n_tokens", "digest"], "n_tokens", "at")
        .withColumn("at", F.col("at") + F.col("epoch") * F.col("total"))
        .where(F.col("at") < F.col("budget"))
        .withColumn("block", F.expr("at div share_of_block"))
        .withColumn("shuffled", F.md5(F.concat_ws(":", "hash", "block"))))
    slot = F.row_number().over(Window.partitionBy("block").orderBy("shuffled", "src", "key", "epoch", "n_tokens", "digest")) - 1
    return laid.select(
        F.col("key").alias(key), F.col("source").alias(source), "n_tokens", F.col("epoch").cast("int").alias("epoch"),
        "block", slot.cast("long").alias("slot"), *([F.col("digest").alias(told_by)] if told_by else []))
