"""Word-aligned coding of token ids: Simple-8b in segments of independent blocks.

A 64-bit word holds a selector in its top four bits and, below it, as many ids as fit at the selector's width. A segment
holds whole documents. It is cut into blocks of ``BLOCK`` ids with the number of words before each block, so blocks decode
side by side. Ids of more than 60 bits are kept aside, in order, and leave an escape word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimflow.llm.tokens import CHUNK_BYTES, encoder
from dimflow.llm.words import chunks

BLOCK = 1024
SEGMENT_IDS = 1 << 18
# Fixed values of the format: ids and bits an id by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
STRIDE = BLOCK + 64


@dataclass(frozen=True)
class Coded:
    words: np.ndarray
    offsets: np.ndarray
    escapes: np.ndarray


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    high = values >> np.uint64(32)
    if not high.any():
        return np.frexp(values.astype(np.float32 if values.max(initial=0) < 1 << 24 else np.float64))[1].astype(np.uint8)
    low = np.frexp(values.astype(np.float64))[1].astype(np.uint8)  # exact below 2^53
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1].astype(np.uint8) + np.uint8(32), low)


def encode(ids: np.ndarray) -> Coded:
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:len(ids)] = ids
    values = np.zeros((blocks, STRIDE), np.uint64)
    values[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    sizes = np.clip(len(ids) - np.arange(blocks) * BLOCK, 0, BLOCK)
    bits = _bit_lengths(values)
    widest = {1: bits}
    for p in (2, 4, 8, 16, 32):  # the widest of the next p ids
        half = widest[p // 2]
        widest[p] = half.copy()
        np.maximum(half[:, :-(p // 2)], half[:, p // 2:], out=widest[p][:, :-(p // 2)])
    choice = np.zeros((blocks, STRIDE), np.uint8)
    for selector in range(len(COUNTS) - 1, 0, -1):
        n, width = int(COUNTS[selector]), WIDTHS[selector]
        p = 1 << (n.bit_length() - 1)
        most = np.maximum(widest[p][:, :BLOCK], widest[p][:, n - p:n - p + BLOCK])
        choice[:, :BLOCK][most <= width] = selector
    lane = np.arange(blocks)
    at = np.zeros(blocks, np.int64)
    steps = []
    while len(lane):
        chosen = choice[lane, at]
        steps.append((lane, at, chosen))
        at = at + COUNTS[chosen]
        more = at < sizes[lane]
        lane, at = lane[more], at[more]
    lane, at, chosen = (np.concatenate([s[i] for s in steps]) if steps else np.zeros(0, np.int64) for i in range(3))
    order = np.argsort(lane, kind="stable")
    lane, at, chosen = lane[order], at[order], chosen[order].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, begin = values.ravel(), lane * STRIDE + at
    for selector in range(1, len(COUNTS)):
        rows = np.flatnonzero(chosen == selector)
        for j in range(int(COUNTS[selector]) if len(rows) else 0):
            words[rows] |= flat[begin[rows] + j] << np.uint64(j * WIDTHS[selector])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(lane, minlength=blocks))]).astype(np.uint32)
    return Coded(words, offsets, flat[begin[chosen == 0]])


def decode(coded: Coded, n: int) -> np.ndarray:
    words, blocks = coded.words, len(coded.offsets) - 1
    selector = (words >> np.uint64(60)).astype(np.int64)
    per_block = np.diff(coded.offsets.astype(np.int64))
    lane = np.repeat(np.arange(blocks), per_block)
    before = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    first = before[np.minimum(coded.offsets[:-1].astype(np.int64), max(len(before) - 1, 0))] if len(before) else before
    at = lane * STRIDE + before - np.repeat(first, per_block)
    out = np.zeros(blocks * STRIDE, np.uint64)
    out[at[selector == 0]] = coded.escapes
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for j in range(int(COUNTS[s]) if len(rows) else 0):
            out[at[rows] + j] = (words[rows] >> np.uint64(j * WIDTHS[s])) & mask
    return out.reshape(blocks, STRIDE)[:, :BLOCK].ravel()[:n]


FILE_SCHEMA = ("part int, start long, n_ids long, doc_ids array<long>, lengths array<long>, offsets binary, words binary, "
               "escapes binary")
_ARROW = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("offsets", pa.binary()), ("words", pa.binary()),
                    ("escapes", pa.binary())])


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int) -> None:
    """Encode every ``text`` of ``docs`` (doc_id, text; NULL is empty), append ``end``, and write the ids at ``path``.

    Documents are ranged over the files by ascending doc_id (NULL first, equal ids in any but a fixed order); a row of a
    file is one segment with the number of ids before it in its file. Rows travel in Parquet so that any store works.
    """
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal start, ids, names, lengths
            coded, n = encode(np.concatenate(ids)), sum(lengths)
            row = [part, start, n, names, lengths, coded.offsets.tobytes(), coded.words.tobytes(), coded.escapes.tobytes()]
            start, ids, names, lengths = start + n, [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        held = 0
        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            for first, texts in chunks(batch.column("text"), CHUNK_BYTES):
                got, counts = encoder(tokenizer).encode(texts, end)
                at = 0
                for k, n in enumerate(counts.tolist()):
                    ids.append(got[at:at + n])
                    names.append(own[first + k])
                    lengths.append(n)
                    at, held = at + n, held + n
                    if held >= SEGMENT_IDS:
                        yield flush()
                        held = 0
        if names:
            yield flush()

    ranged = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.col("doc_id"))
              .sortWithinPartitions("doc_id", F.xxhash64("text")))
    ranged.mapInArrow(segments, FILE_SCHEMA).write.mode("overwrite").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files at ``path``: doc_id, start (ids of all documents before it), ids (little-endian uint32)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one row for each written file
    parts = files.groupBy("part").agg(F.max(F.col("start") + F.col("n_ids")).alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                coded = Coded(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["offsets"], np.uint32),
                              np.frombuffer(row["escapes"], np.uint64))
                ids = decode(coded, row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["_at"], pa.int64()),
                     pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    placed = (files.join(F.broadcast(parts), "part").withColumn("_at", F.col("start") + F.col("_before"))
              .select("_at", "n_ids", "doc_ids", "lengths", "offsets", "words", "escapes"))
    return placed.mapInArrow(documents, "doc_id long, start long, ids binary")
