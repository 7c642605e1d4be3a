import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from camstat.llm import queries, vectorcodes
from tests.llm.helpers import SF, duck, same


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The contract in Python integers: rows of (key, vector, label) that take part."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = [[int(np.floor(c * scale)) for c in rows[i][1]] for i in range(len(rows))]
    length = -(-len(x[0]) // parts)
    cut = [[(v + [0] * length)[p * length:(p + 1) * length] if (p + 1) * length > len(v) else v[p * length:(p + 1) * length] for p in range(parts)] for v in x]
    cut = [[(q + [0] * length)[:length] for q in v] for v in cut]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(v[p], c)), e) for e, c in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(x)) if near[i][p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    codes = sorted(((rows[i][0], bytes(np.array([e for _, e in near[i]], "<u2")), sum(d for d, _ in near[i])) for i in range(len(x))), key=repr)
    return codes, np.array(books)


def check(spark, rows, schema="vec_id long, embedding array<double>, label int", usable=None, **kw):
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS x", "2 AS near", "3 AS key")
    codes, books = vectorcodes.compress(df, "vec_id", "embedding", "label", **kw)
    got = sorted(((r["key"], bytes(r["code"]), r["error"]) for r in codes.collect()), key=repr)
    want, want_books = plain(rows if usable is None else usable, **kw)
    assert got == want and (books == want_books).all()


def clustered(n, dim, seed=3, scale=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(int(k), [float(c) for c in centres[k % 12] + scale * rng.normal(size=dim)], int(k % 5) if k % 7 else None) for k in rng.permutation(n)]


def test_query_against_sql(spark):
    same(queries.op13_vector_codes(spark, SF).toPandas(), duck(queries.ORACLES["op13_vector_codes"]))


def test_against_plain_integers(spark):
    check(spark, clustered(150, 8), entries=24)
    check(spark, clustered(90, 8, seed=5), entries=24, parts=2, rounds=6)


def test_ties_copies_and_small_tables(spark):
    flat = [(k, [float((k * j) % 2) for j in range(8)], 1) for k in range(40)] + [(100 + k, [0.5] * 8, None) for k in range(60)]
    check(spark, flat, entries=16)
    check(spark, flat[:3])
    check(spark, [(7, [0.1, -0.2, 0.3, 0.4], 1)] * 5 + [(None, [1.0, 1.0, 0.0, -1.0], None), (7, [0.0, 0.0, 0.0, 0.0], 1)], entries=4)


def test_rows_that_take_no_part(spark):
    good = clustered(30, 8)
    bad = [(1000, None, 1), (1001, [], 1), (1002, [1.0] * 7 + [float("nan")], 1), (1003, [1.0] * 7 + [float("inf")], 1),
           (1004, [1.0] * 7 + [None], 1), (1005, [1.0] * 5, 1), (1006, [1e30] * 8, 1)]
    check(spark, good + bad, usable=good, entries=8)


def test_large_components_and_odd_lengths(spark):
    rng = np.random.default_rng(2)
    check(spark, [(k, [float(c) for c in rng.integers(-(2**18), 2**18, 6)], 1) for k in range(40)], entries=8)  # wide: beyond 2^53
    check(spark, [(k, [float(c) for c in rng.normal(size=3)], 1) for k in range(20)], entries=8)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    codes, books = vectorcodes.compress(df, "vec_id", "embedding", "label")
    assert codes.collect() == [] and books.size == 0
    assert vectorcodes.codebook_digest(books) == hashlib.sha256(b"").hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 6), st.sampled_from([3, 30, 3000]))
def test_bounds_never_lose_the_nearest(seed, entries, rounds, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, (60, 2, 3)).astype(float)
    near, width = np.zeros((60, 2), np.uint16), min(vectorcodes.GROUPS, entries)
    low, stamp = np.full((60, 2, width), -np.inf), np.zeros((60, 2, width), np.uint8)
    books = [rng.integers(-spread, spread + 1, (2, entries, 3))]
    for _ in range(rounds):
        error, _ = vectorcodes.nearest(x, books, near, low, stamp)
        d = ((x[:, :, None] - books[-1][None]) ** 2).sum(axis=3)
        assert (near == d.argmin(axis=2)).all() and (error == d.min(axis=2)).all()
        books.append(books[-1] + rng.integers(-max(1, spread // 10), max(1, spread // 10) + 1, (2, entries, 3)))


def test_net_displacement_spares_work():
    """Entries that move to and fro: the sum of norms would forget every bound, the norm of the sum keeps it."""
    rng = np.random.default_rng(4)
    book = rng.integers(-2000, 2000, (1, 64, 4))
    x = (book[0, rng.integers(0, 64, 500)] + rng.integers(-30, 30, (500, 4)))[:, None].astype(float)
    near, low, stamp = np.zeros((500, 1), np.uint16), np.full((500, 1, 16), -np.inf), np.zeros((500, 1, 16), np.uint8)
    books, work = [book], []
    for t in range(8):
        _, compared = vectorcodes.nearest(x, books, near, low, stamp)
        work.append(compared)
        books.append(book + (t + 1) % 2 * 150)
    assert work[0] > 500 * 64 and work[2] < 0.3 * work[0] and work[-1] < 0.3 * work[0]


def test_shifts_are_net():
    a = np.zeros((1, 2, 2), np.int64)
    groups = [np.array([0, 1])]
    assert vectorcodes.shifts([a, a + 5, a], groups)[0, 0, 0] == 0
    assert vectorcodes.shifts([a, a + [3, 4]], groups)[0, 0, 0] == pytest.approx(5)
