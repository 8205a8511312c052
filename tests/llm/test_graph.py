import random

import numpy as np

from clickloom.llm.graph import components, settle


def roots_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components_equal_union_find(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (5000, 5000)]
    df = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == roots_of(edges)
    assert components(df.limit(0)).count() == 0


def test_settle_equals_union_find():
    draw = random.Random(4)
    for n in (1, 5, 200):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(n)]
        expected = roots_of(edges)
        got = settle(np.arange(n), np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
        assert all(got[x] == expected.get(x, x) for x in range(n))
