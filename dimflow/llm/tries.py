"""The trie of all beginnings of conversations, built by halving depths.

Sequences are cut at half depth: what lies above the cut is the upper trie, and each distinct beginning that reaches the cut
names a forest below it; both are cut in half again. All tries and forests of one size are handled together, so there are as
many steps as the greatest depth has binary digits, however many conversations there are. The digits of a depth are the way
to it: a 1 leads into the forest below a cut, whose name is that of the turns from the cut above to this one. A beginning is
therefore named by at most one block of turns a digit, and blocks are named by their halves.

Totals are grafted upward in as many steps: a node that knows the total of all that is less than h below it takes over the
totals of those exactly h below, and then knows what is less than 2h below.

No step needs the turns of a conversation, the children of a node or the members of a node in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import attach, stored
from dimflow.operators.skew import HOT_ROWS, OrderedGroups, join_skewed

PIECE_IDS = 500  # ids in a piece of a node's list
WORD = r"[^\x20\x09-\x0D]+"


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def steps(turns: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """conv_id, pos (from 1), key, words for the turns (conv_id, turn, role, text) of conversations.

    Turns are ordered by ``turn``, NULL first, and where that is equal by ``key``, a digest of role and text; repeated rows
    are turns of their own. NULL role and text count as empty. Rows without a conv_id belong to no conversation and are left
    out. A conversation with more than ``limit`` turns is numbered in pieces.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", _name(F.length(role).cast("string"), F.lit(":"), role, text).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = stored(rows, "trie-turns")
    return OrderedGroups.of(rows, ["conv_id"], ["turn", "key"], limit, unique=False).row_number("pos").result().select(
        "conv_id", "pos", "key", "words")


def _blocks(rows: DataFrame, levels: int) -> list[DataFrame]:
    """By level l, the names of the blocks of 2^l turns: conv_id, at (the block's number), block."""
    found = [rows.select("conv_id", (F.col("pos") - 1).alias("at"), F.col("key").alias("block"))]
    for level in range(1, levels):
        half = lambda odd: F.max(F.when(F.col("at") % 2 == odd, F.col("block")))
        pairs = found[-1].groupBy("conv_id", F.shiftright("at", 1).alias("at")).agg(half(0).alias("_a"), half(1).alias("_b"))
        found.append(stored(pairs.filter("_a IS NOT NULL AND _b IS NOT NULL").select("conv_id", "at", _name("_a", "_b").alias("block")),
                            f"trie-blocks-{level}"))
    return found


def _beginnings(rows: DataFrame, deepest: int, limit: int) -> DataFrame:
    """conv_id, depth, name, words of the beginnings of all lengths from 1."""
    levels = deepest.bit_length()
    blocks, ways = _blocks(rows, levels), []
    for level in range(levels):
        digit = F.shiftright("pos", level) % 2 == 1
        # the forest that this digit leads into lies below the block before the cut
        through = rows.filter(digit).select("conv_id", F.col("pos").alias("depth"),
                                            (F.shiftright(F.col("pos") - (1 << level), level)).alias("at"))
        ways.append(join_skewed(through, blocks[level], ["conv_id", "at"], "inner", limit)
                    .select("conv_id", "depth", F.lit(level).alias("level"), "block", F.lit(None).cast("long").alias("words"))
                    if level else
                    rows.filter(digit).select("conv_id", F.col("pos").alias("depth"), F.lit(0).alias("level"),
                                              F.col("key").alias("block"), F.lit(None).cast("long").alias("words")))
    own = rows.select("conv_id", F.col("pos").alias("depth"), F.lit(None).cast("int").alias("level"),
                      F.lit(None).cast("binary").alias("block"), "words")
    by_level = F.sort_array(F.collect_list(F.when(F.col("level").isNotNull(), F.struct("level", "block"))), asc=False)
    joined = reduce(DataFrame.unionByName, ways, own).groupBy("conv_id", "depth").agg(by_level.alias("_way"), F.max("words").alias("words"))
    way = F.array_join(F.transform("_way", lambda w: F.hex(w["block"])), "")
    return joined.select("conv_id", "depth", _name(F.col("depth").cast("string"), F.lit(":"), way).alias("name"), "words")


def _digests(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, joined by commas."""
    node, state = None, None
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    for batch in pieces:
        done = []
        for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (conv, depth) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], f.type) for i, f in enumerate(schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, state.hexdigest()), schema)], schema=schema)


def _ends(members: DataFrame, last: DataFrame, limit: int) -> DataFrame:
    """conv_id, depth of nodes at which conversations end, with the digest of their ids. A node's ids are joined in pieces;
    only the hash runs over all of them in one task, piece after piece, as it must."""
    ends = last.join(members, ["conv_id", "depth"]).select(F.col("node").alias("_node"), "depth", F.col("conv_id").alias("_id"))
    placed = OrderedGroups.of(stored(ends, "trie-ends"), ["_node", "depth"], ["_id"], limit).row_number("_nr").result()
    pieces = (placed.groupBy("_node", "depth", F.floor((F.col("_nr") - 1) / PIECE_IDS).alias("_piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("_id")), lambda i: i.cast("string")), ",").alias("ids")))
    return (pieces.select(F.col("_node").alias("conv_id"), "depth", "_piece", "ids").repartition("conv_id", "depth")
            .sortWithinPartitions("conv_id", "depth", "_piece").drop("_piece")
            .mapInArrow(_digests, "conv_id long, depth long, ends_sha256 string"))


def prefix_trie(rows: DataFrame, conversations: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """One row per node of the trie of the sequences ``rows`` (conv_id, pos, key, words; pos from 1 without gaps, as
    :func:`steps` gives them) of ``conversations`` (conv_id; those without rows have no turns).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a node is a distinct beginning of
    ``depth`` keys and goes by the smallest conv_id that has it. n_convs conversations begin with it; n_leaves childless nodes
    lie in its subtree (itself included); saved_tokens sums (n_convs - 1) * words of the last key over the subtree;
    ends_sha256 is of the ids, ascending and joined by commas, of the conversations that end there. The root, of depth 0, has
    all conversations as members, NULL as parent and no words. Repeated conv_ids count once, NULL ones not at all; without
    conversations there is no node. Both inputs are read more than once: pass stored tables.
    """
    conversations = stored(conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct(),
                           "trie-conversations")
    first = conversations.agg(F.min("conv_id")).first()[0]
    deepest = rows.agg(F.max("pos")).first()[0] or 0
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("conv_id IS NOT NULL")
    named = stored(_beginnings(rows, deepest, limit), "trie-beginnings")
    nodes = stored(named.groupBy("name").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"),
                                             F.max("words").alias("words"), F.max("depth").alias("_depth")), "trie-names")
    members = stored(attach(named.select("conv_id", "depth", "name"), nodes.select("name", "node", "n_convs"), "name", "n_convs")
                     .select("conv_id", "depth", "node"), "trie-members")

    def above(below: DataFrame, distance: int) -> DataFrame:
        """The node ``distance`` above each row (conv_id, depth): its ``_conv`` and ``_depth``."""
        at = below.withColumn("_depth", F.col("depth") - distance)
        near = at.filter("_depth = 0").withColumn("_conv", F.lit(first).cast("long"))
        key = members.select("conv_id", F.col("depth").alias("_depth"), F.col("node").alias("_conv"))
        return near.unionByName(at.filter("_depth > 0").join(key, ["conv_id", "_depth"]), allowMissingColumns=True)

    own = nodes.select(F.col("node").alias("conv_id"), F.col("_depth").alias("depth"), "n_convs", "words")
    own = stored(above(own, 1).select("conv_id", "depth", F.col("_conv").alias("parent_conv_id"), "n_convs", "words").unionByName(
        root.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                    F.lit(0).cast("long").alias("words"))), "trie-nodes")
    children = own.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    totals = stored(own.join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "trie-totals")
    distance = 1
    while distance <= deepest:
        grafted = (above(totals.filter(F.col("depth") >= distance).select("conv_id", "depth", "n_leaves", "saved_tokens"), distance)
                   .groupBy(F.col("_conv").alias("conv_id"), F.col("_depth").alias("depth"))
                   .agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")))
        totals = stored(totals.join(grafted, ["conv_id", "depth"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens")), "trie-totals")
        distance *= 2
    lengths = rows.groupBy("conv_id").agg(F.max("pos").alias("depth"))
    turnless = conversations.join(lengths.select("conv_id"), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("long").alias("depth"))
    at_root = turnless.withColumn("node", F.lit(first).cast("long"))
    ends = _ends(members.unionByName(at_root.select("conv_id", "depth", "node")), lengths.unionByName(turnless), limit)
    none = hashlib.sha256(b"").hexdigest()
    return totals.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
