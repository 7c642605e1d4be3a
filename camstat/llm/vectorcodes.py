"""Vector code compression: product quantization trained with norm-of-sum bounds.

Vectors become integers, are cut into equal parts, and every part position gets its own codebook,
refined by Lloyd rounds in integer arithmetic (ties to the lower index, floors downwards), so the
result depends on neither partitioning nor order.

Each vector keeps, per part and per group of codebook entries, a lower bound of its distance to the
group's entries other than its own, and the round in which that bound was measured (its stamp).
The codebooks of all rounds are retained: a bound measured in round s holds in round t less the largest
net displacement ||c_t - c_s|| of the group's entries (the norm of the sum of their moves, never more than
the sum of the norms).  A group whose bound exceeds the exact distance to the own entry cannot hold a nearer
or equal one and is skipped; other groups are scanned exactly and stamped anew.

A round is one narrow job: it reads the rows of the round before, and writes rows with new bounds
and, from each task, one partial sum per entry.  Only those sums are shuffled; the driver holds the
codebooks (parts x entries x part length integers per round).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camstat.llm.common import drop, written_at

#: Groups of codebook entries that share a bound.
GROUPS = 16


def shifts(books: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """(stamp, part, group): largest net displacement of the group's entries from the round of the stamp
    to the last one."""
    moved = [np.sqrt(((books[-1] - b).astype(np.float64) ** 2).sum(axis=2)) for b in books]
    return np.array([[[m[p, g].max() for g in groups] for p in range(m.shape[0])] for m in moved])


def nearest(x: np.ndarray, books: list[np.ndarray], near: np.ndarray, low: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, int]:
    """Assign rows to the last codebooks: updates ``near`` (rows, parts), ``low`` and ``stamp`` (rows, parts,
    groups) in place; returns the exact squared distances (rows, parts) and the number of entries compared.

    ``x``: (rows, parts, length) integers as doubles or, where squares pass 2^53, as 64-bit integers."""
    n, parts, _ = x.shape
    now, book = len(books) - 1, books[-1].astype(x.dtype)
    groups = np.array_split(np.arange(book.shape[1]), min(GROUPS, book.shape[1]))
    home = np.empty(book.shape[1], np.int64)
    for g, entries in enumerate(groups):
        home[entries] = g
    moved = shifts(books, groups)
    error, compared = np.empty((n, parts), np.int64), n * parts
    every = np.arange(n)
    for p in range(parts):
        v, old = x[:, p], near[:, p].astype(np.int64)
        own = ((v - book[p, old]) ** 2).sum(axis=1)
        first = np.sqrt(own.astype(np.float64))
        # Bounds hold in exact arithmetic; a relative margin absorbs the rounding of the roots.
        bound = low[:, p] - moved[stamp[:, p], p, np.arange(len(groups))] * (1 + 1e-9)
        best, arg = own.copy(), old.copy()
        size, square = (v * v).sum(axis=1), (book[p] * book[p]).sum(axis=1)
        scans = []
        for g, entries in enumerate(groups):
            rows = every[bound[:, g] <= np.sqrt(best.astype(np.float64)) * (1 + 1e-9)]
            if not len(rows):
                continue
            d = size[rows, None] - 2 * (v[rows] @ book[p, entries].T) + square[entries]
            compared += d.size
            at = d.argmin(axis=1)
            least = d[np.arange(len(rows)), at]
            take = (least < best[rows]) | ((least == best[rows]) & (entries[at] < arg[rows]))
            best[rows[take]], arg[rows[take]] = least[take], entries[at[take]]
            d[np.arange(len(rows)), at] = np.inf if d.dtype.kind == "f" else np.iinfo(np.int64).max
            scans.append((g, rows, entries[at], least, d.min(axis=1)))
        lost = arg != old
        # The own entry of before joins the others of its group; a scan below measures them anew.
        g = home[old[lost]]
        low[every[lost], p, g] = np.minimum(bound[every[lost], g], first[lost] * (1 - 1e-9))
        stamp[every[lost], p, g] = now
        for g, rows, at, least, second in scans:
            others = np.where(at == arg[rows], second, least).astype(np.float64)
            low[rows, p, g] = np.sqrt(others) * (1 - 1e-9)
            stamp[rows, p, g] = now
        near[:, p], error[:, p] = arg, best
    return error, compared


def _integers(df: DataFrame, key: str, vector: str, label: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """(key, label, x: integers as doubles) and the vectors' length, without the rows that take no part."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * scale).cast("double"))
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        F.col(vector).cast("array<double>"), lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = df.where(sound).select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), x.alias("x"))
    head = rows.orderBy(F.col("key").asc_nulls_last(), "x").limit(1).collect()
    dim = len(head[0]["x"]) if head else parts
    # Beyond this the squared distance of two vectors could pass 62 bits.
    most = float(np.floor(np.sqrt(2.0**62 / dim) / 2))
    return rows.where((F.size("x") == dim) & F.forall("x", lambda c: F.abs(c) <= most)), dim


def _part_length(dim: int, parts: int) -> int:
    return -(-dim // parts)


_ROWS = "key long, label {label}, x binary, near binary, low binary, stamp binary, error long, part int, entry int, n long, sums array<long>"


def _bytes(rows: np.ndarray, kind: str):
    """Row k of an array as value k of a binary column."""
    import pyarrow as pa

    return pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary())


def _stacked(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _round(batches: Iterator, books: list[np.ndarray], wide: bool) -> Iterator:
    """Rows under the last codebooks, then this task's partial sums per entry."""
    import pyarrow as pa

    parts, entries, length = books[-1].shape
    width = min(GROUPS, entries)
    count, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, length), np.int64)
    names = ["key", "label", "x", "near", "low", "stamp", "error", "part", "entry", "n", "sums"]
    label = None
    for batch in batches:
        n, label = batch.num_rows, batch["label"].type
        if not n:
            continue
        x = _stacked(batch["x"], "<i8").reshape(n, parts, length)
        if batch["near"].null_count:  # the first round: nothing is known
            near = np.zeros((n, parts), np.uint16)
            low, stamp = np.full((n, parts, width), -np.inf), np.zeros((n, parts, width), np.uint8)
        else:
            near = _stacked(batch["near"], "<u2").reshape(n, parts).copy()
            low = _stacked(batch["low"], "<f4").reshape(n, parts, width).astype(np.float64)
            stamp = _stacked(batch["stamp"], np.uint8).reshape(n, parts, width).copy()
        error, _ = nearest(x if wide else x.astype(np.float64), books, near, low, stamp)
        for p in range(parts):
            count[p] += np.bincount(near[:, p], minlength=entries)
            np.add.at(sums[p], near[:, p], x[:, p])
        # Stored a little lower, so that rounding to four bytes keeps them bounds.
        stored = np.nextafter(low.astype("<f4"), np.float32(-np.inf))
        yield pa.RecordBatch.from_arrays([
            batch["key"], batch["label"], batch["x"], _bytes(near, "<u2"), _bytes(stored, "<f4"), _bytes(stamp, "u1"), pa.array(error.sum(axis=1)),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names)
    if label is not None:
        part, entry = np.nonzero(count)
        n, blank = len(part), pa.nulls(len(part), pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()), pa.nulls(n, label), blank, blank, blank, blank, pa.nulls(n, pa.int64()),
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names)


def compress(df: DataFrame, key: str, vector: str, label: str, parts: int = 4, entries: int = 256, rounds: int = 4,
             scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """((key, label, code, error), codebooks): every vector as the indexes of its parts' nearest entries
    (``code``: 16-bit little-endian indexes in part order; ``error``: squared distance, summed over parts).

    Vectors that are null, empty, or hold null or non-finite components take no part; neither do those of
    another length than the one of the smallest key, nor those so long that squared distances would not
    fit 64 bits.  The last part is padded with zeros where the length is no multiple of ``parts``.
    Codebooks start as the parts of the ``entries`` smallest keys (null keys last; rows that repeat a key
    by their vectors); fewer rows make smaller codebooks.  Repeated rows count each.  An empty table
    gives no rows and codebooks without entries."""
    spark = df.sparkSession
    rows, dim = _integers(df, key, vector, label, scale, parts)
    length = _part_length(dim, parts)
    first = rows.orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).select("x").collect()
    kind = rows.schema["label"].dataType.simpleString()
    if not first:
        empty = rows.select("key", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.limit(0), np.zeros((parts, 0, length), np.int64)

    def cut(vectors) -> np.ndarray:
        out = np.zeros((len(vectors), parts * length), np.int64)
        for k, v in enumerate(vectors):
            out[k, :dim] = np.asarray(v, np.float64).astype(np.int64)
        return out

    books = [cut([r["x"] for r in first]).reshape(len(first), parts, length).transpose(1, 0, 2).copy()]
    most = rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0]
    wide = length * (2 * most) ** 2 >= 2.0**52
    schema = _ROWS.format(label=kind)

    def packed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            x = np.zeros((n, parts * length), np.int64)
            x[:, :dim] = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
            blank = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["label"], _bytes(x, "<i8"), blank, blank, blank], ["key", "label", "x", "near", "low", "stamp"])

    now = rows.mapInArrow(packed, f"key long, label {kind}, x binary, near binary, low binary, stamp binary")
    path = None
    for t in range(rounds + 1):
        sent = spark.sparkContext.broadcast(books)
        done, at = written_at(now.mapInArrow(lambda batches, sent=sent: _round(batches, sent.value, wide), schema), "codes")
        if path:
            drop(spark, path)
        path, now = at, done.where("part IS NULL").select("key", "label", "x", "near", "low", "stamp")
        if t == rounds:
            break
        totals = done.where("part IS NOT NULL").groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[k]) for k in range(length)]).alias("sums")).collect()
        book = books[-1].copy()
        for r in totals:
            book[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
        books = [*books, book]
    return done.where("part IS NULL").select("key", "label", F.col("near").alias("code"), "error"), books[-1]


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all integers in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
