"""Connected components of a stored edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import stored

FOREST_EDGES = 500_000  # that a task holds at once


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge a node, to the smallest node of its component, that join what the edges ``a - b`` join."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, low = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        near = np.minimum(low[left], low[right])
        if (low[left] == low[right]).all():
            break
        np.minimum.at(low, low[left], near)
        np.minimum.at(low, low[right], near)
        while (low[low] != low).any():
            low = low[low]
    up = low != np.arange(len(nodes))
    return nodes[up], nodes[low[up]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return forest(*[np.concatenate(x) for x in zip(*held)])

    for batch in batches:
        held.append((batch.column("a").to_numpy(zero_copy_only=False), batch.column("b").to_numpy(zero_copy_only=False)))
        if sum(len(x) for x, _ in held) > FOREST_EDGES:
            low = joined()
            held = [low]
            if len(low[0]) > FOREST_EDGES // 2:  # little is left to join here: go on with an empty forest
                yield pa.RecordBatch.from_arrays(list(map(pa.array, low)), names=["a", "b"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, joined())), names=["a", "b"])


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (a, b), both longs, with the same components: every task gives out a forest of those it meets, first where
    they are and again with the edges of a node together. A node is left with an edge a task that meets it at most."""
    return edges.select("a", "b").mapInArrow(_forests, "a long, b long").repartition("a").mapInArrow(_forests, "a long, b long")


def components(edges: DataFrame, label: str) -> DataFrame:
    """node, component (the smallest node of its component) for every node of ``edges`` (a, b).

    Each round a node takes the smallest label around it and then that label's own label, so long chains halve. Minima are
    taken before the shuffle, and adaptive execution splits the rows of a node with very many neighbours. Every round is a
    written table.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), f"{label}-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("_m"))
                    .select(F.col("a").alias("node"), F.least("a", "_m").alias("component")), f"{label}-labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("_near"))
                  .withColumnRenamed("a", "node"))
        lower = labels.join(around, "node").select("node", F.least("component", "_near").alias("_low"),
                                                   F.col("component").alias("_old"))
        own = labels.select(F.col("node").alias("_low"), F.col("component").alias("_next"))
        moved = stored(lower.join(own, "_low").select("node", F.least("_low", "_next").alias("component"),
                                                      (F.least("_low", "_next") != F.col("_old")).alias("_moved")),
                       f"{label}-labels")
        labels = moved.select("node", "component")
        if moved.filter("_moved").isEmpty():
            return labels
