import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import neighbours
from dimflow.llm.common import stored

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, rank STRING, score STRING"


def asked():
    return F.col("id") % 50 == 0


def brute(rows, k=5):
    good = [(i, np.array(v, float)) for i, v, *_ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % 50 == 0:
            near = sorted(((-float((v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum())), i) for i, w in good
                           if i != q and len(w) == len(v)))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("block", [300, 8192])
def test_recall(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist(), "x", "y") for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index = neighbours.build_index(stored(neighbours.usable(docs, "vec_id", "embedding"), "test-vectors"), block)
    assert index.count() == -(-1500 // block)
    found, want = {}, brute(rows)
    for r in neighbours.nearest(docs, asked()).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(want) and all([r["rank"] for r in v] == [1, 2, 3, 4, 5] for v in found.values())
    hits = sum(len({r.vec_id for r in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    scores = {(q, i): s for q, v in brute(rows, 1500).items() for i, s in v}
    assert all(abs(scores[q, r.vec_id] - r.score) < 1e-12 for q, v in found.items() for r in v)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, []), (200, [1.0, None]), (250, [1.0, float("nan")]),
            (300, [float("inf"), 1.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [-1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (0, [1.0, 0.0])]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    found = sorted({(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(docs, asked()).collect()})
    assert {(q, i) for q, _, i, _ in found} == {(0, 1), (0, 2), (0, 3)}
    assert [i for _, _, i, _ in found[:1]] == [1]


def test_ties_go_to_the_smaller_id_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 7)
    docs = spark.createDataFrame([(i, [3.0, 4.0], None, None) for i in range(101)], SCHEMA)
    index = neighbours.build_index(stored(neighbours.usable(docs, "vec_id", "embedding"), "test-vectors"), 7)
    assert index.count() > 5
    found = {}
    for r in neighbours.nearest(docs, asked()).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4]}


def test_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), asked()).count() == 0


def test_identical_rows_spread_over_blocks(spark):
    docs = spark.createDataFrame([(7, [3.0, 4.0], None, None)] * 400, SCHEMA).repartition(3)
    index = neighbours.build_index(stored(neighbours.usable(docs, "vec_id", "embedding"), "test-vectors"), 50)
    sizes = [len(r.ids) for r in index.collect()]
    assert len(sizes) == 8 and sum(sizes) == 400 and max(sizes) <= 50 + 8


@pytest.mark.parametrize("n,kind", [(500, np.uint16), (70_000, np.uint32)])
def test_windows_of_blocks_of_any_size(n, kind):
    rng = np.random.default_rng(n)
    values = rng.standard_normal((neighbours.PROJECTIONS, n))
    places = np.argsort(values, axis=1, kind="stable")
    ranks = np.empty(places.shape, kind)
    np.put_along_axis(ranks, places, np.arange(n, dtype=kind)[None, :], axis=1)
    query, spread = rng.standard_normal(neighbours.PROJECTIONS), values.std(axis=1) + 1e-6
    flat = (np.sort(values, axis=1) + neighbours.APART * np.arange(neighbours.PROJECTIONS)[:, None]).ravel()
    found = neighbours.candidates(query, ranks, flat, spread)
    width = neighbours.FIRST_WIDTH
    while True:
        met = (np.abs(values - query[:, None]) <= width * spread[:, None]).sum(axis=0)
        want = np.flatnonzero(met >= neighbours.COLLISIONS)
        if len(want) >= min(n, max(neighbours.CANDIDATES, int(neighbours.SHARE * n))):
            break
        width *= neighbours.WIDEN
    assert len(set(found) ^ set(want)) <= n // 1000  # borders differ by rounding


def test_components_whose_squares_leave_the_range(spark):
    rows = [(0, [1e-170, 0.0]), (50, [1e200, 1e200]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [5e-324, 5e-324])]
    docs = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    found = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 9)) for r in neighbours.nearest(docs, asked(), 4).collect()}
    assert found[0, 1] == (1, 1.0) and [found[50, r][0] for r in (1, 2)] == [2, 3] and found[50, 1][1] == 1.0
