import numpy as np
import pytest

from camstat.llm import queries, vecdedup
from tests.llm.helpers import SF
from tests.llm.test_ann import frame
from tests.llm.test_components import roots


def brute(ids, x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T >= threshold
    np.fill_diagonal(s, False)
    a, b = np.nonzero(s)
    root = roots([(int(i), int(i)) for i in ids] + [(int(ids[i]), int(ids[j])) for i, j in zip(a, b)])
    return {int(i): (int(s[k].sum()), root[int(i)]) for k, i in enumerate(ids)}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vecdedup.near_duplicates(df).collect()}


def test_query(spark):
    got = queries.op6_vector_dedup(spark, SF).collect()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    want = brute(e.vec_id.to_numpy(), np.stack(e.embedding.values).astype(float))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_groups_of_all_sizes(spark, monkeypatch):
    """Pairs to a dense group beyond the lists' limit, exact copies, chains, a wide dense group."""
    monkeypatch.setattr(vecdedup, "BLOCK", 64)
    rng = np.random.default_rng(6)
    parts = [rng.standard_normal((300, 32))]
    for size, spread in ((2, 0.02), (2, 0.02), (5, 0.02), (12, 0.02), (60, 0.02), (150, 0.15), (90, 0.2)):
        parts.append(rng.standard_normal(32) + spread * rng.standard_normal((size, 32)))
    copy = rng.standard_normal(32)
    parts.append(np.repeat(copy[None], 50, axis=0))
    a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
    parts.append(np.array([np.cos(t) * a + np.sin(t) * b for t in np.arange(12) * 0.25]))
    x = np.vstack(parts)
    ids = rng.permutation(len(x)) * 3
    want = brute(ids, x)
    got = result(frame(spark, ids, x, "double"))
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 0.01 * len(want), [(i, got[i], want[i]) for i in wrong[:5]]


def test_tight_groups_that_link_across(spark, monkeypatch):
    """Two groups whose lists are full of their own members, linked at about 0.96, and one out of reach."""
    monkeypatch.setattr(vecdedup, "BLOCK", 16)
    rng = np.random.default_rng(9)
    a, b, c = np.linalg.qr(rng.standard_normal((32, 3)))[0].T
    t = np.arccos(0.962)
    x = np.vstack([p + 0.001 * rng.standard_normal((40, 32)) for p in (a, np.cos(t) * a + np.sin(t) * b, c)] + [rng.standard_normal((60, 32))])
    ids = rng.permutation(len(x)) * 2 + 1
    want = brute(ids, x)
    assert sorted(n for n, _ in want.values())[-80:] == [79] * 80
    assert result(frame(spark, ids, x, "double")) == want


def test_partitions_grow_with_the_table():
    """An isolated pair at the threshold misses all leaves in at most 1 % of cases."""
    for n in (10**4, 10**5, 10**6, 10**7):
        share = (1 - np.arccos(0.95) / np.pi) ** vecdedup._bits(n)
        assert (1 - share) ** vecdedup._partitions(n, 0.95) <= 0.01 + 1e-12


def test_audit_of_rare_links(spark, monkeypatch):
    """The sample grows until links are seen, and a search that is not confirmed raises."""
    monkeypatch.setattr(vecdedup, "AUDIT", 4)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 32))
    x[7] = x[3] + 0.01
    sizes = []

    def seen(graph, vecs, sample, *rest):
        sizes.append(len(sample[0]))
        return (0, 2) if len(sample[0]) > 100 else (0, 0)

    monkeypatch.setattr(vecdedup, "_seen", seen)
    with pytest.raises(RuntimeError):
        vecdedup.near_duplicates(frame(spark, np.arange(200), x, "double"), max_rounds=2)
    assert sizes[:4] == [2, 4, 32, 200]


def test_edge_cases(spark):
    rows = [(4, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]),
            (None, [1.0, 1.0]), (9, [2.0, 4.0]), (9, [2.0, 4.0]), (10, [1.0, 2.0, 3.0]), (11, [-1.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS id", "1 AS vec", "2 AS comp")
    assert result(df) == {2: (2, 2), 4: (2, 2), 9: (2, 2), 3: (0, 3), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 10: (0, 10), 11: (0, 11)}
    assert result(df.limit(0)) == {}
    assert result(df.where("vec_id = 3")) == {3: (0, 3)}
