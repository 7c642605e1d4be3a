"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 3 bits meet half-way: a variant of one with at most 1 bit flipped equals a
variant of the other with at most 2 bits flipped.  Of three differing bits two have positions of
the same parity, so flipping pairs of equal parity is enough: 1 + 64 + 992 variants ("far" side)
against 1 + 64 ("near" side).  Every fingerprint plays both sides.

Variants are shuffled by their leading bits.  All variants that a fingerprint sends to the same
leading bits travel as one row (the fingerprint and how many flips are spent) and are spelled out
where they meet, so a fingerprint costs a few dozen shuffled rows instead of 1122.  The number of
leading bits follows the number of fingerprints.  A group that is still large is divided by a hash
of the variant: near variants go to one part, far rows to each.

Where variants collide, all far fingerprints are linked to the smallest near one (each such pair
is within 3 bits, and is verified), which gives the same components as all colliding pairs without
listing them.  Each group is contracted to a forest before its links leave the task.

Equal fingerprints are collapsed before any of this, so copies cost nothing.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from camstat.llm.common import digest, written
from camstat.operators.components import components, forest

RADIUS = 3
#: Fingerprints aimed at in one group, and most near fingerprints in one part of a group.
GROUP, PART = 4096, 32_768
#: Far fingerprints spelled out at once.
CHUNK = 2048
#: Shingles hashed and counted at once.
BLOCK = 65_536


def simhash(text: bytes | None, words: int) -> int:
    """64-bit fingerprint as a signed integer; null or wordless texts: 0."""
    from xxhash import xxh64_intdigest

    tokens = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    whole = b" ".join(tokens)
    if len(tokens) < words:
        starts, ends = [0], [len(whole)]
    else:
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        stop = np.cumsum(sizes + 1) - 1
        starts, ends = (stop - sizes)[: len(tokens) - words + 1].tolist(), stop[words - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), BLOCK):
        h = np.array([xxh64_intdigest(whole[a:b], 42) for a, b in zip(starts[i:i + BLOCK], ends[i:i + BLOCK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """SimHash over shingles of ``words`` words: ASCII lower case, XXH64 with seed 42, a bit set
    where over half of the shingle hashes (repeats counted) have it."""

    @pandas_udf("long")
    def of(texts):
        return texts.map(lambda t: simhash(t, words)).astype("int64")

    return of(text.cast("binary"))


def _masks(bits: int) -> list[tuple[int, int]]:
    """(mask, kind) for flips inside the ``bits`` leading bits.  kind: 0, 1: near side with 0, 1
    flips spent; 2: far side with none; 3, 4: one at an even, odd position; 5: two of one parity."""
    at = range(64 - bits, 64)
    out = [(0, 0), (0, 2)]
    for i in at:
        out += [(1 << i, 1), (1 << i, 3 + i % 2)]
    out += [(1 << i | 1 << j, 5) for i, j in combinations(at, 2) if (i - j) % 2 == 0]
    return [(m - (1 << 64) if m >> 63 else m, k) for m, k in out]


def _flips(bits: int) -> dict[int, np.ndarray]:
    """For each kind, the masks of the flips left for the trailing bits."""
    low = range(64 - bits)
    one = [1 << i for i in low]
    pairs = [1 << i | 1 << j for i, j in combinations(low, 2) if (i - j) % 2 == 0]
    sets = {0: [0, *one], 1: [0], 2: [0, *one, *pairs], 3: [0, *one[0::2]], 4: [0, *one[1::2]], 5: [0]}
    return {k: np.array(v, np.uint64) for k, v in sets.items()}


def _mix(v: np.ndarray, shift: int) -> np.ndarray:
    return (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)


def _meet(fp: np.ndarray, kind: np.ndarray, part: int, parts: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest near fingerprint) of one part of a group."""
    flips, low = _flips(bits), np.uint64((1 << (64 - bits)) - 1)

    def spell(k: int, own: np.ndarray):
        values = ((own & low)[:, None] ^ flips[k][None, :]).ravel()
        whose = np.repeat(own, len(flips[k]))
        if parts > 1:
            mine = _mix(values, 40) % np.uint64(parts) == part
            values, whose = values[mine], whose[mine]
        return values, whose

    values, whose = [], []
    for k in (0, 1):
        side = fp[kind == k]
        for i in range(0, len(side), CHUNK):
            v, w = spell(k, side[i:i + CHUNK])
            values.append(v)
            whose.append(w)
    near, owner = np.concatenate(values), np.concatenate(whose)
    order = np.lexsort((owner.view(np.int64), near))
    near, owner = near[order], owner[order]
    first = np.flatnonzero(np.r_[True, near[1:] != near[:-1]])
    near, owner = near[first], owner[first]
    size = max(16, math.ceil(math.log2(len(near) + 1)) + 4)
    there = np.zeros(1 << size, bool)  # most far variants meet nothing: a quick test before the search
    there[_mix(near, 64 - size)] = True
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for k in (2, 3, 4, 5):
        side = fp[kind == k]
        for i in range(0, len(side), CHUNK):
            v, w = spell(k, side[i:i + CHUNK])
            hit = there[_mix(v, 64 - size)]
            v, w = v[hit], w[hit]
            at = np.minimum(np.searchsorted(near, v), len(near) - 1)
            met = (near[at] == v) & (owner[at] != w)
            x, y = w[met], owner[at[met]]
            close = np.bitwise_count(x ^ y) <= RADIUS
            if close.any():
                pairs = np.unique(np.stack([x[close], y[close]], 1), axis=0)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
    return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)


def links(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints within 3 bits.
    ``prints``: distinct fingerprints (long, no nulls)."""
    n = prints.count()
    bits = min(24, max(8, math.ceil(math.log2(max(1, n / GROUP)))))
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).cast("byte").alias("kind")) for m, k in _masks(bits)])
    prefix = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("m.mask")), 64 - bits).cast("int")
    sent = (
        prints.select(F.col(fp).alias("fp")).withColumn("m", F.explode(masks))
        .select("fp", prefix.alias("prefix"), F.col("m.kind").alias("kind")))
    held = (
        prints.groupBy(F.shiftrightunsigned(F.col(fp), 64 - bits).cast("int").alias("at")).agg(F.count("*").alias("held"))
        .where(F.col("held") > PART)
        .select("at", F.ceil(F.col("held") / PART).cast("int").alias("parts")))
    parted = (
        sent.join(held, F.col("prefix") == F.col("at"), "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", "kind", "prefix", "part", "parts"))

    def meet(group):
        import pandas as pd

        own = group["fp"].to_numpy(np.int64).view(np.uint64)
        kind = group["kind"].to_numpy()
        empty = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        if not (kind <= 1).any():
            return empty
        a, b = _meet(own, kind, int(group["part"].iat[0]), int(group["parts"].iat[0]), bits)
        if not len(a):
            return empty
        a, b = forest(a, b)
        return pd.DataFrame({"a": a, "b": b})

    return parted.groupBy("prefix", "part").applyInPandas(meet, "a long, b long").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key whose document is reachable by
    links of at most 3 differing bits, itself included.

    Null and empty texts have fingerprint 0 and link like any other.  Repeated rows stay, one result
    row each.  Rows with a null key take part; a component of null keys only has a null id.  Other
    columns of ``df`` are ignored; an empty table gives no rows."""
    prints = written(df.select(F.col(key).alias("key"), fingerprint(F.col(text), words).alias("fp")), "prints")
    return prints.join(_components(prints), F.col("fp") == F.col("f")).select(F.col("key").alias(key), "fp", "component_id")


def _components(prints: DataFrame) -> DataFrame:
    """(f, component, component_id) of every fingerprint in prints(key, fp): the root fingerprint of
    its component, and the smallest key there."""
    distinct = written(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct-prints")
    comps = components(links(distinct.select("fp")))
    named = distinct.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    return written(
        named.join(ids, F.col("component") == F.col("c")).select(F.col("fp").alias("f"), "component", "component_id"), "print-components")


def survivors(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, digest): one row for each component, its smallest key (nulls last), then smallest
    ``digest`` of the text.  Keys may be null or repeated: components are told apart by their
    fingerprints, not by keys."""
    prints = written(
        df.select(F.col(key).alias("key"), digest(F.col(text)).alias("digest"), fingerprint(F.col(text), words).alias("fp")), "prints")
    rank = F.struct(F.col("key").isNull().alias("none"), "key", "digest")
    return (
        prints.join(_components(prints), F.col("fp") == F.col("f")).groupBy("component").agg(F.min(rank).alias("first"))
        .select(F.col("first.key").alias(key), F.col("first.digest").alias("digest")))
