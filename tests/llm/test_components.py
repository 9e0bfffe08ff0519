import random

from quadrille.llm._components import connected_components
from quadrille.llm._store import Scratch


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in parent}


def check(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = connected_components(df, Scratch(spark, "test")).collect()
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert {r["node"]: r["component"] for r in found} == brute(real)
    assert len(found) == len({r["node"] for r in found})


def test_shapes(spark):
    draw = random.Random(2)
    check(spark, [])
    check(spark, [(1, 1), (None, 2), (3, None)])
    check(spark, [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(5, 5), (41, 0)])
    check(spark, [(draw.randrange(200), draw.randrange(200)) for _ in range(150)])
