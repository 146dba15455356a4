"""Star contraction against union-find."""

import random

from fieldmart.llm import components


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 120)] + [(500, 500 + i) for i in range(1, 90)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)] + [(7, 7)]
    parent = {}
    for a, b in edges:
        components.union(parent, a, b)
    expected = {n: components.root(parent, n) for n in list(parent)}
    rnd.shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a long, b long").repartition(6))
    got = {r.node: r.component for r in found.collect()}
    assert got == {n: c for n, c in expected.items() if n in got} and set(expected) - set(got) <= {n for n, c in expected.items() if n == c}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
