import random

import numpy as np
import pytest

from dimflow.llm import components as under_test
from dimflow.llm.components import components, contracted, forest


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        up[high] = low
    return {x: root(x) for x in up}


def some_edges(seed, n, nodes):
    rand = random.Random(seed)
    chain = [(10_000 + i, 10_001 + i) for i in range(200)]
    star = [(20_000 + i, -5) for i in range(300)]
    return [(rand.randrange(nodes), rand.randrange(nodes)) for _ in range(n)] + chain + star


def test_forest_joins_the_same_nodes():
    for seed in range(5):
        edges = some_edges(seed, 200, 300)
        a, b = forest(*np.array(edges).T)
        want = brute(edges)
        assert len(a) <= len(want) and brute(zip(a.tolist(), b.tolist())).items() <= want.items()
        assert {x: r for x, r in want.items() if x != r} == dict(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("held", [500_000, 40])
def test_contracted_edges_have_the_same_components(spark, monkeypatch, held):
    monkeypatch.setattr(under_test, "FOREST_EDGES", held)
    edges = some_edges(7, 500, 400)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(6)
    few = contracted(frame)
    want = brute(edges)
    found = {r.node: r.component for r in components(few, "test-components").collect()}
    assert found == {x: r for x, r in want.items() if x in found}
    assert {x for x, r in want.items() if x != r} <= found.keys()


def test_many_edges_of_few_nodes_shrink(spark):
    edges = [(i, j) for i in range(1000) for j in range(0, 36)]
    assert contracted(spark.createDataFrame(edges, "a long, b long").repartition(4)).count() <= 1100
