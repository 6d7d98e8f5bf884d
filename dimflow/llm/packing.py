"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm on islands.

Pieces are dealt into blocks of about ``BLOCK_PIECES`` by hash. Each block lives on several islands, one row each, whose
populations of packings evolve apart: crossover injects well-filled bins of one parent whole into the other, drops the
bins there that share pieces with them, and best-fits what has lost its bin. Between epochs an island's elite moves on to
the next island of the block. The emptiest bins of all blocks are then packed once more together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import stored
from dimflow.llm.tokens import CHUNK_BYTES, encoder
from dimflow.llm.words import chunks, give_back

CAPACITY = 4096
BLOCK_PIECES = 20_000
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 4, 6
EMPTIEST = 2


def token_pieces(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document, cut only where it is longer than ``capacity``.

    A NULL or empty text is one piece that holds ``end`` alone. Rows with the same doc_id are documents of their own.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            for first, texts in chunks(batch.column("text"), CHUNK_BYTES):
                ids, counts = encoder(tokenizer).encode(texts, end)
                data = memoryview(ids.astype("<u4").tobytes())
                rows, at = [], 0
                for k, n in enumerate(counts.tolist()):
                    for i, s in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - s)
                        rows.append((own[first + k], i, s, size, zlib.crc32(data[4 * (at + s):4 * (at + s + size)])))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            give_back()

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long"))


class Bins:
    """Open bins by their free room; finds the fullest one with room enough."""

    def __init__(self, capacity: int):
        self.capacity, self.used = capacity, 0
        self.rooms = [[] for _ in range(capacity + 1)]
        self.some = 0

    def add(self, name: int, room: int) -> None:
        self.rooms[room].append(name)
        self.some |= 1 << room

    def best_fit(self, size: int) -> int:
        fitting = self.some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            name = self.rooms[room].pop()
            if not self.rooms[room]:
                self.some ^= 1 << room
        else:
            name, room = self.used, self.capacity
            self.used += 1
        self.add(name, room - size)
        return name


def _renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, fuller ones."""
    fill = np.bincount(bins, weights=sizes)
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins, out = Bins(capacity), np.zeros(len(sizes), np.int64)
    out[order] = [bins.best_fit(s) for s in sizes[order].tolist()]
    return out


def crossover(mother: np.ndarray, father: np.ndarray, sizes: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    fill = np.bincount(father, weights=sizes)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    injected = np.isin(father, rng.choice(good, max(1, len(good) // 3), replace=False))
    clash = np.zeros(mother.max() + 1, bool)
    clash[mother[injected]] = True
    free = clash[mother] & ~injected
    child = np.where(injected, father + mother.max() + 1, mother)
    child[free] = -1
    child[~free] = _renumber(child[~free])
    open_bins = Bins(capacity)
    room = capacity - np.bincount(child[~free], weights=sizes[~free]).astype(np.int64)
    open_bins.used = len(room)
    for name, r in enumerate(room.tolist()):
        open_bins.add(name, r)
    loose = np.flatnonzero(free)
    loose = loose[np.argsort(-sizes[loose], kind="stable")]
    child[loose] = [open_bins.best_fit(s) for s in sizes[loose].tolist()]
    return child


def evolve(sizes: np.ndarray, population: list[np.ndarray], seed: int, capacity: int) -> list[np.ndarray]:
    """Fill up the population, let it evolve, and return it with the best first. Stops at the fewest bins possible."""
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // capacity)
    rank = lambda bins: fitness(bins, sizes, capacity)
    population = list(population)
    if not population:
        population.append(best_fit(sizes, np.argsort(-sizes, kind="stable"), capacity))
    if -rank(population[0])[0] > least:
        while len(population) < POPULATION:
            noise = sizes * rng.uniform(0.8, 1.0, len(sizes))
            population.append(best_fit(sizes, np.argsort(-noise, kind="stable"), capacity))
        for _ in range(GENERATIONS):
            population.sort(key=rank, reverse=True)
            if -rank(population[0])[0] <= least:
                break
            a, b = rng.choice(min(3, len(population)), 2, replace=False)
            children = [crossover(population[a], population[b], sizes, capacity, rng),
                        crossover(population[b], population[a], sizes, capacity, rng)]
            population = sorted([*population, *children], key=rank, reverse=True)[:POPULATION]
    return sorted(population, key=rank, reverse=True)


def _pack_blocks(pieces: DataFrame, capacity: int, block_pieces: int, label: str) -> DataFrame:
    """_uid, _block, _bin of rows (_uid, length <= capacity)."""
    count = pieces.count()
    blocks = max(1, -(-count // block_pieces))
    block = F.pmod(F.xxhash64("_uid"), F.lit(blocks)).alias("_block")
    grouped = (pieces.select(block, F.struct("_uid", "length").alias("_p")).groupBy("_block")
               .agg(F.sort_array(F.collect_list("_p")).alias("_p"))
               .select("_block", F.col("_p._uid").alias("_uids"), F.col("_p.length").alias("_sizes")))
    state = grouped.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("_island"),
                           F.array().cast("array<binary>").alias("_packings"))
    schema = ("_block long, _uids array<long>, _sizes array<long>, _island int, _packings array<binary>, bins int")

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    sizes = row.column("_sizes")[0].values.to_numpy()
                    island = row.column("_island")[0].as_py()
                    begin = [np.frombuffer(b.as_py(), np.int32).astype(np.int64) for b in row.column("_packings")[0]]
                    seed = (row.column("_block")[0].as_py() * ISLANDS + island) * EPOCHS + number
                    best = evolve(sizes, begin, seed, capacity)[:2]
                    packings = [_renumber(b).astype(np.int32).tobytes() for b in best]
                    yield pa.RecordBatch.from_arrays(
                        [*(row.column(c) for c in ("_block", "_uids", "_sizes", "_island")),
                         pa.array([packings], pa.list_(pa.binary())), pa.array([int(best[0].max()) + 1], pa.int32())],
                        names=["_block", "_uids", "_sizes", "_island", "_packings", "bins"])
        return run

    for number in range(EPOCHS):
        if number:
            elite = state.select("_block", ((F.col("_island") + 1) % ISLANDS).alias("_island"),
                                 F.slice("_packings", 1, 1).alias("_elite"))
            state = (state.join(elite, ["_block", "_island"])
                     .withColumn("_packings", F.concat("_packings", "_elite")).drop("_elite", "bins")
                     .select("_block", "_uids", "_sizes", "_island", "_packings"))
        state = stored(state.mapInArrow(epoch(number), schema), f"{label}-epoch{number}")
    best = state.groupBy("_block").agg(F.min(F.struct("bins", "_island", "_uids", "_sizes", "_packings")).alias("_b"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins, sizes = np.frombuffer(row["packing"], np.int32).astype(np.int64), np.array(row["sizes"], np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.searchsorted(bins[order], np.arange(bins.max() + 1))
                offset = np.zeros(len(bins), np.int64)
                offset[order] = before - before[first][bins[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["uids"], pa.int64()), pa.array(sizes), pa.array(np.full(len(bins), row["_block"])),
                     pa.array(bins), pa.array(offset)], names=["_uid", "length", "_block", "_bin", "offset"])

    return (best.select("_block", F.col("_b._uids").alias("uids"), F.col("_b._sizes").alias("sizes"),
                        F.col("_b._packings")[0].alias("packing"))
            .mapInArrow(members, "_uid long, length long, _block long, _bin long, offset long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences of at most ``capacity`` as the search finds.

    ``length`` must lie in 1..capacity; other columns are kept as they are, in any number, and repeated rows are pieces of
    their own. An empty table gives an empty result. Sequence ids are unique but not dense.
    """
    shown = pieces.columns
    rows = stored(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    part = rows.filter(F.col("length") < capacity).select("_uid", "length")
    placed = stored(_pack_blocks(part, capacity, block_pieces, "packing"), "packed")
    fill = placed.groupBy("_block", "_bin").agg(F.sum("length").alias("_fill"))
    # a block has few bins to choose from, two of them go on
    emptiest = (fill.groupBy("_block").agg(F.slice(F.sort_array(F.collect_list(F.struct("_fill", "_bin"))), 1, EMPTIEST)
                                           .alias("_e"))
                .select("_block", F.explode("_e._bin").alias("_bin")))
    again = stored(placed.join(emptiest, ["_block", "_bin"]).select("_uid", "length"), "emptiest")
    rest = placed.join(emptiest, ["_block", "_bin"], "left_anti")
    second = _pack_blocks(again, capacity, block_pieces, "repacking")
    name = lambda kind: F.col("_block") * (8 * block_pieces) * 2 + F.col("_bin") * 2 + kind
    whole = rows.filter(F.col("length") >= capacity).select("_uid", (-F.col("_uid") - 1).alias("sequence_id"),
                                                           F.lit(0).cast("long").alias("offset"))
    several = (rest.select("_uid", name(0).alias("sequence_id"), "offset")
               .unionByName(second.select("_uid", name(1).alias("sequence_id"), "offset")))
    return rows.join(whole.unionByName(several), "_uid").select(*[F.col(f"`{c}`") for c in shown], "sequence_id", "offset")
