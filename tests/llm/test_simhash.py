import re

import numpy as np
import pytest
import xxhash

from camstat.llm import queries, simhash
from tests.llm.helpers import SF, docs
from tests.llm.test_components import roots


def fingerprint(text, words=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(tokens[i:i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        counts = [c + (h >> b & 1) for b, c in enumerate(counts)]
    return sum(1 << b for b in range(64) if grams and 2 * counts[b] > len(grams))


def brute(prints):
    """prints: {row: (key, fp)} -> {row: smallest key reachable}."""
    items = list(prints.items())
    edges = [(i, i) for i in range(len(items))]
    fps = np.array([fp for _, (_, fp) in items], np.uint64)
    for i in range(len(items)):
        edges += [(i, int(j)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3) if j > i]
    root = roots(edges)
    least = {}
    for i, (_, (key, _)) in enumerate(items):
        if key is not None:
            least[root[i]] = min(least.get(root[i], key), key)
    return {row: least.get(root[i]) for i, (row, _) in enumerate(items)}


def test_fingerprint_of_awkward_texts():
    for text in (None, "", " \n", "One", "one two", "A b C d", "İ É a b \x1cx", "x " * 70_000):
        assert simhash.simhash(None if text is None else text.encode(), 3) % 2**64 == fingerprint(text)


def test_given_documents(spark):
    got = queries.op10_simhash_dedup(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: (d, fingerprint(t)) for d, t in texts.items()}
    want = brute(prints)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        d: (f"{prints[d][1]:016x}", want[d]) for d in texts}


def test_edge_cases(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    assert len(got) == 11
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[1] == by[2] == 1 and by[3] == by[4] == by[5] == 3
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("part", [32_768, 40])
def test_links_of_planted_fingerprints(spark, part, monkeypatch):
    """All pairs within 3 bits, also inside a group that is divided; none at 4."""
    monkeypatch.setattr(simhash, "PART", part)
    rng = np.random.default_rng(9)
    fps = []
    for base in rng.integers(0, 2**63, 40, dtype=np.uint64):
        for flips in (0, 1, 2, 3, 3, 3, 4, 4):
            at = rng.choice(64, flips, replace=False)
            fps.append(int(base) ^ sum(1 << int(i) for i in at))
    ball = int(rng.integers(0, 2**63))
    fps += [ball ^ 1 << i ^ 1 << j for i in range(0, 64, 3) for j in range(i + 1, 64, 5)]
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    assert all((x["a"] % 2**64 ^ x["b"] % 2**64).bit_count() <= 64 for x in got)
    want = brute({f: (f, f % 2**64) for f in signed})
    have = roots([(f, f) for f in signed] + [(x["a"], x["b"]) for x in got])
    assert have == want
