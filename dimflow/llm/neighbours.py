"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks by a running number. A block keeps, for each of ``PROJECTIONS`` random directions, its vectors
sorted by their projection, and the place of each vector in that array. A query opens a window around its own projection in
every sorted array and widens all of them together, which is hashing anew at twice the radius. Vectors met in at least
``COLLISIONS`` windows are candidates; once a block has enough of them, they are verified on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.common import stored

PROJECTIONS, COLLISIONS = 64, 40
FIRST_WIDTH, WIDEN = 0.62, 1.1  # half a window, in spreads of a projection; factor from one radius to the next
APART = 1e3  # more than any two projections of unit vectors differ
CANDIDATES, SHARE = 160, 0.18  # a block verifies at least so many, and at least this share of its vectors
BLOCK_VECTORS, GROUP_QUERIES = 8192, 256
INDEX = "dims int, block int, ids array<long>, vectors array<double>, ranks array<int>, projections array<float>"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector, dims of rows whose vector is not NULL, empty or zero and has only finite components. Vectors whose squares
    leave the range of doubles are divided by their largest component, which changes no cosine."""
    v = F.col("vector")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    largest = F.array_max(F.transform(v, F.abs))
    fair = F.when(norm.between(1e-280, 1e280), v).otherwise(F.transform(v, lambda x: x / largest))
    return rows.filter(good & (largest > 0)).withColumn("vector", fair).withColumn("dims", F.size("vector"))


def directions(dims: int) -> np.ndarray:
    return np.random.default_rng([dims, PROJECTIONS]).standard_normal((dims, PROJECTIONS))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _index_block(key: tuple, rows: pa.Table) -> pa.Table:
    dims = key[0].as_py()
    rows = rows.combine_chunks().sort_by("id")
    vectors = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    projected = (_unit(vectors) @ directions(dims)).T.astype(np.float32)
    places = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
    sorted_values = np.take_along_axis(projected, places, axis=1)
    ranks = np.empty_like(places)
    np.put_along_axis(ranks, places, np.arange(len(vectors), dtype=np.int32)[None, :], axis=1)
    one = lambda v, t: pa.array([v], pa.list_(t))
    return pa.table({"dims": pa.array([dims], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                     "ids": one(rows.column("id").to_numpy(), pa.int64()), "vectors": one(vectors.ravel(), pa.float64()),
                     "ranks": one(ranks.ravel(), pa.int32()), "projections": one(sorted_values.ravel(), pa.float32())})


def build_index(rows: DataFrame, block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """The stored index of all stored ``rows`` (id, vector, dims), a row for each block. Repeated rows spread like others."""
    blocks = max(1, -(-rows.count() // block_vectors))
    block = F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int").alias("block")
    return stored(rows.select("dims", block, "id", "vector").groupBy("dims", "block").applyInArrow(_index_block, INDEX),
                  "neighbours-index")


def candidates(projected: np.ndarray, ranks: np.ndarray, values: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Indexes of the vectors that a query with the projections ``projected`` collides with often enough.

    ``values`` are the sorted arrays one after the other, ``APART`` more for each, so that one search finds the borders of all
    windows; ``ranks`` say where each array holds each vector, so that a window is a range of ranks.
    """
    n = ranks.shape[1]
    wanted = min(n, max(CANDIDATES, int(SHARE * n)))
    middle = projected + APART * np.arange(PROJECTIONS)
    begin, kind = n * np.arange(PROJECTIONS), ranks.dtype
    width = FIRST_WIDTH
    while True:
        low = np.clip(np.searchsorted(values, middle - width * spread) - begin, 0, n)
        size = np.clip(np.searchsorted(values, middle + width * spread, "right") - begin, 0, n) - low
        counts = np.zeros(n, np.uint8)
        for own, a, b in zip(ranks, low.astype(kind), size.astype(kind)):
            counts += (own - a) < b  # unsigned: a rank below the window wraps around
        found = np.flatnonzero(counts >= COLLISIONS)
        if len(found) >= wanted or size.min() >= n:
            return found
        width *= WIDEN


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in
                       ("ids", "vectors", "ranks", "projections", "query_ids", "query_vectors")}
                dims, ids = batch.column("dims")[i].as_py(), row["ids"]
                n = len(ids)
                vectors, queries = row["vectors"].reshape(n, dims), row["query_vectors"].reshape(-1, dims)
                ranks, values = row["ranks"].reshape(-1, n).astype(np.uint16 if n < 1 << 16 else np.uint32), row["projections"].astype(float).reshape(-1, n)
                spread = values.std(axis=1) + 1e-6
                values = (values + APART * np.arange(PROJECTIONS)[:, None]).ravel()
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                projected = (_unit(queries) @ directions(dims)).astype(np.float32).astype(float)
                out: list[tuple] = []
                for q, query in enumerate(queries):
                    own = row["query_ids"][q]
                    found = candidates(projected[q], ranks, values, spread)
                    found = found[ids[found] != own]
                    cosines = (vectors[found] * query).sum(axis=1) / (norms[found] * np.sqrt((query * query).sum()))
                    best = np.lexsort((ids[found], -cosines))[:k]
                    out += [(own, ids[found[b]], cosines[b]) for b in best]
                columns = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                                                 names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest cosines found for each row of which ``is_query`` (of ``id``) holds.

    All rows are indexed; each query meets every block. Ties go to the smaller id. A row is no candidate of queries with its
    own id, so repeated ids never find each other; identical rows are candidates like others. Vectors that are NULL, empty, zero or hold NULL or non-finite components
    take no part, nor do vectors of another length than the query's. Rows without an id are left out.
    """
    rows = stored(usable(vectors, id_column, vector_column).filter("id IS NOT NULL"), "neighbours-vectors")
    index = build_index(rows)
    asked = rows.filter(is_query)
    groups = max(1, -(-asked.count() // GROUP_QUERIES))
    group = F.pmod(F.xxhash64("id", "vector"), F.lit(groups)).cast("int").alias("group")
    asked = (asked.select("dims", group, F.struct("id", "vector").alias("q")).groupBy("dims", "group")
             .agg(F.sort_array(F.collect_list("q")).alias("q"))
             .select("dims", "group", F.col("q.id").alias("query_ids"), F.flatten("q.vector").alias("query_vectors")))
    # the stated queries against all rows, block by block
    pairs = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(asked, ["dims", "group"])
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
