"""Exact duplicates by a minimal perfect hash over the digests seen before.

The history's distinct digests are sharded by their first bytes. Each shard gets a minimal perfect hash: bit arrays in which
a digest that has a place of its own sets its bit, the others trying again in the next array; the number of set bits before a
digest's bit is its slot. Slots hold the full digest and the doc_id that stays. A lookup compares all bytes, so a digest that
is not a member is recognised; non-members are grouped among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import attach, stored
from dimflow.llm.words import mix

SHARD_DIGESTS = 200_000
BITS_PER_DIGEST = 2.0
DIGEST_BYTES = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """A place below ``size`` for each digest (rows of four 64-bit numbers) in the array of ``level``."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(digests[:, 1] ^ salt) ^ mix(digests[:, 2] + salt)) % np.uint64(size)


def build(digests: np.ndarray) -> list[np.ndarray]:
    """The bit arrays (bytes 0 and 1 here) of a minimal perfect hash over distinct digests."""
    levels, left = [], digests
    while len(left):
        size = int(len(left) * BITS_PER_DIGEST) + 64
        place = _places(left, len(levels), size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        left = left[~alone[place]]
    return levels


def slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot of each digest; -1 for some that are not members, a wrong slot for others."""
    out = np.full(len(digests), -1, np.int64)
    left, before = np.arange(len(digests)), 0
    for level, bits in enumerate(levels):
        place = _places(digests[left], level, len(bits))
        hit = bits[place]
        rank = np.cumsum(bits)
        out[left[hit]] = before + rank[place[hit]] - 1
        before += int(rank[-1])
        left = left[~hit]
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, DIGEST_BYTES // 8)


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    digests = _matrix(rows.column("digest"))
    levels = build(digests)
    slot = slots(levels, digests)
    order = np.argsort(slot)  # a permutation: the hash is minimal and perfect
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                     "sizes": pa.array([[len(b) for b in levels]], pa.list_(pa.int64())),
                     "bits": pa.array([np.packbits(np.concatenate(levels)).tobytes()], pa.binary()),
                     "digests": pa.array([digests[order].astype(">u8").tobytes()], pa.binary()),
                     "keepers": pa.array([rows.column("keep_id").take(pa.array(order)).to_pylist()], pa.list_(pa.int64()))})


INDEX = "shard long, sizes array<long>, bits binary, digests binary, keepers array<long>"


def _shard(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(shards)).alias("shard")


def shards_for(digests: int) -> int:
    """Shards of at most about ``SHARD_DIGESTS`` digests, of the index or of those looked up, whichever are more."""
    return max(1, -(-digests // SHARD_DIGESTS))


def build_index(history: DataFrame, shards: int, label: str = "perfect-hash") -> DataFrame:
    """The stored index of ``history`` (digest binary of 32 bytes, distinct; keep_id long): one row for each shard."""
    return stored(history.select("digest", "keep_id", _shard(shards)).groupBy("shard").applyInArrow(_build_shard, INDEX), label)


def _look_up(key: tuple, asked: pa.Table, index: pa.Table) -> pa.Table:
    digests = _matrix(asked.column("digest"))
    found, keepers = np.zeros(len(digests), bool), [None] * len(digests)
    if index.num_rows:
        row = index.to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
        levels = np.split(bits, np.cumsum(row["sizes"]))[:-1]
        slot = slots(levels, digests)
        members = np.frombuffer(row["digests"], ">u8").astype(np.uint64).reshape(-1, DIGEST_BYTES // 8)
        inside = np.flatnonzero(slot >= 0)
        found[inside] = (members[slot[inside]] == digests[inside]).all(axis=1)
        keepers = [row["keepers"][s] if f else None for s, f in zip(slot.tolist(), found.tolist())]
    return pa.table({"digest": asked.column("digest"), "member": pa.array(found), "keep_id": pa.array(keepers, pa.int64())})


def look_up(digests: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """digest, member, keep_id of the member's slot, for every row of ``digests`` (digest, distinct)."""
    asked = digests.select("digest", _shard(shards))
    return (asked.groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInArrow(_look_up, "digest binary, member boolean, keep_id long"))


def exact_duplicates(docs: DataFrame, historical: Column) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    Rows for which ``historical`` holds came before and are indexed; the others are looked up: members are repeats of
    history, non-members are grouped separately. Texts are equal when they are after each run of ``[\\x20\\x09-\\x0D]`` has
    become one space; NULL counts as empty. Of a group the smallest doc_id stays. A NULL doc_id stays only where a group has
    no other; rows repeated with the doc_id that stays are all marked kept, as nothing tells them apart.
    """
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    rows = stored(docs.select(F.col("doc_id").cast("long"), digest.alias("digest"),
                              F.coalesce(historical, F.lit(False)).alias("old")), "exact-rows")
    # a row for each digest on either side, however often it is there
    sums = rows.groupBy("old", "digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    sums = stored(sums, "exact-digests")
    old, new = sums.filter("old").drop("old"), sums.filter("NOT old").drop("old")
    # the larger side decides: a small history must not send all new digests to few tasks, nor a large one be few indexes
    larger = sums.groupBy("old").count().agg(F.max("count")).first()[0] or 0
    shards = shards_for(larger)
    index = build_index(old, shards)
    looked = stored(look_up(new, index, shards).withColumnRenamed("keep_id", "old_id"), "exact-looked-up")
    checked = new.join(looked, "digest")
    members = checked.filter("member").select("digest", F.least("keep_id", "old_id").alias("keep_id"), "n")
    nonmembers = checked.filter("NOT member").select("digest", "keep_id", "n")
    repeated = old.join(members.withColumnsRenamed({"keep_id": "new_id", "n": "m"}), "digest", "left").select(
        "digest", F.least("keep_id", "new_id").alias("keep_id"), (F.col("n") + F.coalesce("m", F.lit(0))).alias("group_size"))
    groups = stored(repeated.unionByName(nonmembers.withColumnRenamed("n", "group_size")), "exact-groups")
    return attach(rows.select("doc_id", "digest"), groups, "digest", "group_size").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
