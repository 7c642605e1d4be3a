"""Sharding by proportional stratified interleaving, in DataFrame operations only.

Rows of every source are shuffled by a seeded hash and ranked; a row's fractional rank is
(rank - 1/2) / rows of its source.  Sorting all rows by that fraction interleaves the sources
in proportion, so equal consecutive cuts give every shard the mixture of the whole table
(within one row per source) and row counts at most one apart.

Neither a source nor the whole table is ever sorted in one task.  Ranks are taken inside
(source, hash range) cells and fractions inside ranges of the fraction; the number of ranges
follows the row count, and a cell's offset is a running sum over the small table of cell
counts.  A source with a third of all rows is spread over all its hash ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at in one cell.
CELL_ROWS = 20_000
#: Cells at least, so that a hot source is spread over many tasks in small tables too.
MIN_CELLS = 256


def _ranks_in_band(cells: int):
    """Columns (band, ranks in it) for step ``__k`` of a source of ``__total`` rows.  Rank r lies
    in band (2r-1) * cells div (2 * total).  A source of at most ``cells`` rows has one step for
    each rank; a larger one has one for each band, counted in closed form."""
    small = F.col("__total") <= cells

    def upto(k: str) -> str:
        return f"(({k} * 2 * __total - 1) div {cells} + 1) div 2"

    band = F.when(small, F.expr(f"(2 * __k - 1) * {cells} div (2 * __total)")).otherwise(F.col("__k") - 1)
    count = F.when(small, F.lit(1)).otherwise(
        F.expr(upto("__k")) - F.when(F.col("__k") > 1, F.expr(upto("(__k - 1)"))).otherwise(F.lit(0)))
    return band.cast("int").alias("__oband"), count.cast("long").alias("__in")


def interleave(df: DataFrame, n_shards: int, key: str = "doc_id", source: str = "source",
               seed: int = 17, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 .. n_shards-1) and ``slot`` (0-based place in the shard).

    Order inside a source: seeded 64-bit hash of the key, then the key; rows repeated with
    one key keep any order among themselves (they are interchangeable when equal).  Null
    sources form a stratum of their own, null keys hash as the seed alone.  An empty table
    gives an empty result.  Columns named ``shard`` or ``slot`` in the input are replaced;
    all others stay."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    df = df.drop("shard", "slot")
    n = df.count()
    cells = max(MIN_CELLS, -(-n // cell_rows))
    top = float(2**63)
    rows = (
        df.withColumn("__src", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")))
        .withColumn("__hash", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1))
        .withColumn("__cell", F.least(F.floor(F.col("__hash") / top * cells), F.lit(cells - 1)).cast("int"))
    )
    per_cell = rows.groupBy("__src", "__cell").agg(F.count("*").alias("__rows"))
    in_source = Window.partitionBy("__src")
    offsets = per_cell.select(
        F.col("__src").alias("__osrc"), F.col("__cell").alias("__ocell"),
        (F.sum("__rows").over(in_source.orderBy("__cell")) - F.col("__rows")).alias("__before"),
        F.sum("__rows").over(in_source).alias("__total"),
    )
    place = F.row_number().over(Window.partitionBy("__src", "__cell").orderBy("__hash", key))
    ranked = (
        rows.withColumn("__place", place)
        .join(offsets, (F.col("__src") == F.col("__osrc")) & (F.col("__cell") == F.col("__ocell")))
        .withColumn("__twice", 2 * (F.col("__before") + F.col("__place")) - 1)
        .withColumn("__frac", F.col("__twice") / (2 * F.col("__total")))
        .withColumn("__band", F.expr(f"__twice * {cells} div (2 * __total)").cast("int"))
    )
    bands = (
        per_cell.groupBy("__src").agg(F.sum("__rows").alias("__total"))
        .select("__total", F.explode(F.sequence(F.lit(1), F.least(F.col("__total"), F.lit(cells)))).alias("__k"))
        .select(*_ranks_in_band(cells))
        .groupBy("__oband").agg(F.sum("__in").alias("__in"))
    )
    starts = bands.select(
        "__oband", (F.sum("__in").over(Window.orderBy("__oband")) - F.col("__in")).alias("__start"))
    at = F.row_number().over(Window.partitionBy("__band").orderBy("__frac", "__src", "__hash", key))
    pos = F.col("__start") + F.col("__at") - 1
    shard = F.expr(f"__pos * {n_shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {max(n, 1)} + {n_shards - 1}) div {n_shards}")
    return (
        ranked.withColumn("__at", at)
        .join(starts, F.col("__band") == F.col("__oband"))
        .withColumn("__pos", pos.cast("long"))
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("__pos") - first).cast("long"))
        .select(*df.columns, "shard", "slot")
    )
