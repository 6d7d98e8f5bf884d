"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. Texts become sets of 5-word shingles; rows with equal sets become one node.
2. Bands of the nodes' signatures retrieve candidates. Buckets that share nodes make up a cluster of candidates; no link
   can leave it.
3. Clusters are compared in blocks of bounded size. A pair that shares a band is compared batch by batch of its signatures
   and dropped once the posterior probability of reaching the threshold falls below ``MISS``. Survivors are verified on
   their full sets, most alike first, unless links found before already join them. Linked pairs leave as a forest.
4. The components of these links are the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import attach, stored
from dimflow.llm.components import components, contracted
from dimflow.llm.words import chunks, find_words, give_back, kept, mix

PERCENT = 85
NO_BAND = 1e-6  # bound of the probability that a pair at the threshold shares no band
MOST_HASHES = 288
BATCH = 36
MISS = 1e-7
BLOCK_NODES, BLOCK_SHINGLES = 400, 1_000_000
SHINGLES_AT_ONCE = 512
BROADCAST_KEYS = 4_000_000  # of one or two 64-bit numbers


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows by which a pair at ``percent`` is missed with at most ``NO_BAND``: the most rows that ``MOST_HASHES``
    allow, at least one."""
    def bands(rows: int) -> int:
        band = (percent / 100) ** rows
        return math.ceil(math.log(NO_BAND) / math.log1p(-band)) if band < 1 else 1

    rows = 1
    while (rows + 1) * bands(rows + 1) <= MOST_HASHES:
        rows += 1
    return bands(rows), rows


BANDS, ROWS = banding(PERCENT)
HASHES = BANDS * ROWS


def _seeds(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    def make():
        seeds = (mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
        return seeds[:hashes], seeds[hashes:] | np.uint32(1)

    return kept(f"minhash seeds {hashes}", make)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    low = np.add.reduce(mix(shingles + np.uint64(1)), dtype=np.uint64)
    high = np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    return np.array([high, low], ">u8").tobytes()


def signature(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    xor, odd = _seeds(hashes)
    low = np.full(hashes, 0xFFFFFFFF, np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(folded), SHINGLES_AT_ONCE):
        part = folded[at:at + SHINGLES_AT_ONCE]
        np.minimum(low, ((part[:, None] ^ xor) * odd).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, bands: int = BANDS) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for column in low.reshape(bands, -1).T.astype(np.uint64):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def batch_ends(hashes: int) -> list[int]:
    return [*range(BATCH, hashes, BATCH), hashes]


def least_matches(percent: int, miss: float) -> dict[int, int]:
    """By the number of compared hashes, the matches below which a pair has similarity >= ``percent`` with a posterior
    probability (from a flat prior) of less than ``miss``. That probability is P(Bin(n + 1, threshold) <= matches)."""
    t, out = percent / 100, {}
    for n in batch_ends(math.prod(banding(percent))):
        below, total = 0, 0.0
        while True:
            total += math.exp(math.lgamma(n + 2) - math.lgamma(below + 1) - math.lgamma(n + 2 - below)
                              + below * math.log(t) + (n + 1 - below) * math.log(1 - t))
            if total >= miss:
                break
            below += 1
        out[n] = below
    return out


SIGNED = "doc_id long, n_shingles long, node binary, signature binary, bands array<long>"


def signed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node (NULL without words), signature and band keys of every row."""
    n_bands, n_rows = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in chunks(batch.column("text")):
                words = find_words(texts)
                n, nodes, lows, bands = [], [], [], []
                for i in range(len(texts)):
                    shingles = words.shingles(i)
                    n.append(len(shingles))
                    if len(shingles):
                        low = signature(shingles, n_bands * n_rows)
                        nodes.append(set_key(shingles))
                        # 16 of the 32 bits tell different values apart well enough to count matches
                        lows.append(low.astype("<u2").tobytes())
                        bands.append(band_keys(low, n_bands))
                    else:
                        nodes.append(None), lows.append(None), bands.append(None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()),
                     pa.array(lows, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "node", "signature", "bands"])
            give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNED)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def linked(shingles: list[np.ndarray], signatures: np.ndarray, bands: np.ndarray, side: np.ndarray,
           percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """A forest of verified links between nodes; with two sides (0, 1), only between nodes of different sides."""
    sizes = np.array([len(s) for s in shingles])
    least = least_matches(percent, miss)
    lefts, rights, counts = [], [], []
    for i in range(len(sizes) - 1):
        others = np.arange(i + 1, len(sizes))
        if side.any():
            others = others[side[others] != side[i]]
        ok = np.minimum(sizes[others], sizes[i]) * 100 >= percent * np.maximum(sizes[others], sizes[i])
        others = others[ok]
        others = others[(bands[others] == bands[i]).any(axis=1)]
        matches, before = np.zeros(len(others), np.int64), 0
        for n in least:
            matches += (signatures[others, before:n] == signatures[i, before:n]).sum(axis=1)
            before = n
            alive = matches >= least[n]
            others, matches = others[alive], matches[alive]
        lefts.append(np.full(len(others), i))
        rights.append(others)
        counts.append(matches)
    if not lefts:
        return []
    left, right, count = map(np.concatenate, (lefts, rights, counts))
    forest, links = Forest(len(sizes)), []
    for k in np.argsort(-count, kind="stable"):
        i, j = int(left[k]), int(right[k])
        a, b = forest.root(i), forest.root(j)
        if a != b:
            both = len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                forest.up[a] = b
                links.append((i, j))
    return links


def _compare(percent: int):
    n_bands, n_rows = banding(percent)

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        seen, keep, sets = set(), [], []
        nodes = block.column("node").to_pylist()
        # by bytes: texts are of any length, and the arrays made of them are many times as large
        for at, texts in chunks(block.column("text")):
            words = find_words(texts)
            for i in range(len(texts)):
                node = nodes[at + i]
                shingles = words.shingles(i) if node not in seen else None
                # another row with the same doc_id may have another text
                if shingles is not None and len(shingles) and set_key(shingles) == node:
                    seen.add(node)
                    keep.append(at + i)
                    sets.append(shingles)
        rows = block.select(["signature", "bands", "side"]).take(pa.array(keep, pa.int64()))
        signatures = np.array([np.frombuffer(s, "<u2") for s in rows.column("signature").to_pylist()]).reshape(len(keep), n_bands * n_rows)
        bands = np.array(rows.column("bands").to_pylist(), np.int64).reshape(len(keep), n_bands)
        links = linked(sets, signatures, bands, np.array(rows.column("side").to_pylist(), np.int64), percent)
        give_back()
        return pa.table({"a": pa.array([nodes[keep[i]] for i, _ in links], pa.binary()),
                         "b": pa.array([nodes[keep[j]] for _, j in links], pa.binary())})
    return run


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """``members`` with the block each row is compared in and its side there.

    A cluster within the limits is one block. A larger one is cut by set size into steps of the threshold's factor, outside of
    which, but for the next step, nothing can be similar enough, and each step by hash into parts; every pair of parts that
    may hold a link is a block.
    """
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent)).cast("long")
    members = members.withColumn("_step", step)
    parts = (members.groupBy("_cluster", "_step").agg(F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_s"))
             .withColumn("_parts", F.ceil(F.greatest(F.col("_n") / BLOCK_NODES, F.col("_s") / BLOCK_SHINGLES)).cast("int")))
    whole = parts.groupBy("_cluster").agg(F.sum("_n").alias("_all"), F.sum("_s").alias("_all_s"))
    large = stored(whole.filter((F.col("_all") > BLOCK_NODES) | (F.col("_all_s") > BLOCK_SHINGLES)).join(parts, "_cluster")
                   .select("_cluster", "_step", "_parts", "_n"), "minhash-large")
    small = members.join(large.select("_cluster").distinct(), "_cluster", "left_anti").select(
        "*", F.col("_cluster").cast("string").alias("_block"), F.lit(0).alias("side"))
    near = large.select("_cluster", (F.col("_step") - 1).alias("_step"), F.col("_parts").alias("_above"))
    far = large.select("_cluster", (F.col("_step") + 1).alias("_step"), F.col("_parts").alias("_below"))
    sized = large.join(near, ["_cluster", "_step"], "left").join(far, ["_cluster", "_step"], "left").drop("_n")
    own = F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int")
    block = lambda s, i, j, side: F.struct(F.concat_ws(":", "_cluster", s, i, j).alias("_block"),
                                           side.alias("side"))
    zero, one = F.lit(0), F.lit(1)
    # within a step: (i, i) once, (i, j) for i < j; between a step and the next: (i of the lower, j of the upper)
    inside = F.transform(F.sequence(zero, F.col("_parts") - 1), lambda k: block(
        2 * F.col("_step"), F.least(k, F.col("_own")), F.greatest(k, F.col("_own")),
        F.when(F.col("_own") > k, one).otherwise(zero)))
    upward = F.when(F.col("_above") > 0, F.transform(F.sequence(zero, F.col("_above") - 1), lambda k: block(
        2 * F.col("_step") + 1, F.col("_own"), k, zero)))
    downward = F.when(F.col("_below") > 0, F.transform(F.sequence(zero, F.col("_below") - 1), lambda k: block(
        2 * F.col("_step") - 1, k, F.col("_own"), one)))
    none = F.array().cast(small.select(F.array(F.struct("_block", "side"))).schema[0].dataType)
    spread = (members.join(sized, ["_cluster", "_step"]).withColumn("_own", own)
              .withColumn("_at", F.explode(F.concat(inside, F.coalesce(upward, none), F.coalesce(downward, none))))
              .select(*members.columns, "_at._block", "_at.side"))
    return small.unionByName(spread)


def _few(keys: DataFrame) -> DataFrame:
    """Stored keys, marked for broadcast if there are at most ``BROADCAST_KEYS``."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; more columns do no harm).

    Two texts are linked when their sets of shingles, lower-cased A-Z, have ``100 * intersection >= percent * union``.
    component_id is the smallest doc_id that links reach. NULL, empty and blank texts have no shingles and are linked with
    nothing. Rows with the same set belong together, repeated rows too; a NULL doc_id counts only where a group has no other.
    """
    rows = stored(signed(docs, percent), "minhash-signed")
    full = rows.filter("node IS NOT NULL")
    # clusters of candidates; nodes go by 64 bits here, where a clash only makes a cluster larger
    short = F.xxhash64("node").alias("h")
    banded = full.select(short, F.explode("bands").alias("band"))
    shared = stored(banded.groupBy("band").agg(F.min("h").alias("b"), F.max("h").alias("_b"), F.count(F.lit(1)).alias("n"))
                    .filter("b != _b").drop("_b"), "minhash-buckets")
    # a node has up to an edge a band; only a forest of them goes on
    edges = stored(contracted(attach(banded, shared, "band", "n").filter("h != b").select(F.col("h").alias("a"), "b")),
                   "minhash-candidates")
    reach = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    links = None
    if not edges.isEmpty():
        clusters = components(edges, "minhash-clusters").select(F.col("node").alias("h"), F.col("component").alias("_cluster"))
        # of the rows of a node one is compared; rows of other nodes are not shuffled unless the clusters are very many
        own = full.withColumn("h", F.xxhash64("node")).join(_few(clusters), "h")
        members = stored(own.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "n_shingles",
                                                                "signature", "bands", "_cluster")).alias("_r"))
                         .select("node", "_r.doc_id", "_r.n_shingles", "_r.signature", "_r.bands", "_r._cluster"),
                         "minhash-clustered")
        texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
        wanted = members.select("doc_id").distinct()
        texts = texts.join(_few(wanted), F.col("_id").eqNullSafe(F.col("doc_id")), "left_semi")
        members = stored(members.join(texts, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id", "doc_id"), "minhash-members")
        links = stored(_blocks(members, percent).select("_block", "side", "node", "signature", "bands", "text").groupBy("_block")
                       .applyInArrow(_compare(percent), "a binary, b binary"), "minhash-links")
    if links is not None and not links.isEmpty():
        groups = components(links, "minhash-groups")
        first = groups.join(reach, "node").groupBy("component").agg(F.min("doc_id").alias("_first"))
        reach = (reach.join(groups.join(first, "component").select("node", "_first"), "node", "left")
                 .select("node", F.coalesce("_first", "doc_id").alias("doc_id"), "copies"))
    reach = stored(reach, "minhash-reach")
    grouped = attach(full.select("node", F.col("doc_id").alias("_own"), "n_shingles"), reach,
                     "node", "copies")
    out = grouped.select(F.col("_own").alias("doc_id"), "n_shingles", F.col("doc_id").alias("component_id"))
    alone = rows.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id stays in its group. Rows that share a doc_id stay or go together."""
    found = stored(near_duplicates(docs, percent).groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept")
                   .select(F.col("doc_id").alias("_gone")), "minhash-gone")
    return docs.join(_few(found), F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
