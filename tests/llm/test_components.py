import random

import numpy as np

from camstat.operators.components import components, forest


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(200)]
    df = spark.createDataFrame([*edges, edges[0], (7, 7), (None, 3), (9, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {k: v for k, v in roots([e for e in edges if e[0] != e[1]]).items()}
    assert components(df.limit(0)).count() == 0


def test_forest():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-99, 99, 150), rng.integers(-99, 99, 150)
    x, y = forest(a, b)
    assert roots(zip(x.tolist(), y.tolist())).items() <= roots(zip(a.tolist(), b.tolist())).items()
    want = {k for k, v in roots(zip(a.tolist(), b.tolist())).items() if k != v}
    assert set(x.tolist()) == want
