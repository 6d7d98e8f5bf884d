"""Where two tables differ, found by hash trees over ranges of their keys.

Rows fall into ranges by the hash of their key. A leaf of the tree is a range with the number of its rows and the sum of their
hashes; a node above sums those below. Two trees are compared from the root down, and only the ranges in which they differ
are read again, shuffled and joined. Sums do not depend on the order of rows, and a tree is one aggregation with partial sums,
so a hot key is one small row a task.

A table stored with its ranges as partitions is then read in those partitions only, and with its tree kept beside it, two such
tables are compared without reading the ranges that agree at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.operators.skew import BROADCAST_BYTES, byte_size
from dimflow.sources.storage import checkpointed
from dimflow.sources.tables import ensure_database, overwrite_table, quoted, table_path

RANGE = "_range"
RANGE_BITS = 6  # of the partitions of a table
LEAF_BITS, STEP_BITS = 16, 4
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def _range(keys: Sequence[str], bits: int) -> Column:
    """The range of a key, from its hash's first bits."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _levels(bits: int, step: int) -> list[int]:
    return [*range(bits, 0, -step), 0]


def _content(df: DataFrame) -> list[Column]:
    row = F.xxhash64(*[F.col(quoted(c)) for c in sorted(df.columns) if c != RANGE]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.sum(row).cast("decimal(38,0)").alias("content")]


def hash_tree(df: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """``bits, node, rows, content``: the ranges of the leaves' ``bits`` and of every ``step`` bits less, up to the root.

    Ranges without rows have no node. Columns count by name, whatever their order; repeated rows count as often as they are
    there. Choose the bits so that a range is some MB of rows.
    """
    levels, below = [checkpointed(df.groupBy(_range(keys, bits).alias("node")).agg(*_content(df)).withColumn("bits", F.lit(bits)))], bits
    for own in _levels(bits, step)[1:]:
        sums = levels[-1].groupBy(F.shiftright("node", below - own).alias("node")).agg(
            F.sum("rows").alias("rows"), F.sum("content").cast("decimal(38,0)").alias("content"))
        levels.append(checkpointed(sums.withColumn("bits", F.lit(own))))
        below = own
    return reduce(DataFrame.unionByName, levels).select("bits", "node", "rows", "content")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if byte_size(df) <= BROADCAST_BYTES else df


def differing_ranges(left: DataFrame, right: DataFrame, bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """``node`` of the leaves in which two trees of the same bits differ. Each level is read below differing nodes only."""
    found, above = None, 0
    for own in reversed(_levels(bits, step)):
        sides = []
        for tree in (left, right):
            level = tree.filter(F.col("bits") == own)
            if found is not None:
                parents = _small(found.withColumnRenamed("node", "_above"))
                level = level.join(parents, F.shiftright("node", own - above) == F.col("_above"), "left_semi")
            sides.append(level)
        a, b = (side.select("node", F.struct("rows", "content").alias(name)) for side, name in zip(sides, ("_a", "_b")))
        found = checkpointed(a.join(b, "node", "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("node"))
        above = own
    return found


def _within(df: DataFrame, keys: Sequence[str], ranges: DataFrame, bits: int) -> DataFrame:
    """The rows in some ranges. Of a table that has ranges as partitions only those partitions are read."""
    if RANGE in df.columns:
        parts = [r[0] for r in ranges.select(F.shiftright("node", bits - RANGE_BITS)).distinct().collect()]  # 2^RANGE_BITS at most
        df = df.filter(F.col(RANGE).isin(parts))
    return df.withColumn("node", _range(keys, bits)).join(_small(ranges), "node", "left_semi").drop("node")


def differences(df: DataFrame, other: DataFrame, keys: Sequence[str], trees: tuple[DataFrame, DataFrame] | None = None,
                bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """``keys, difference``: keys of ``df`` that ``other`` lacks (missing), that only it has (extra), or whose rows differ
    (changed), also in how often they are there. NULL is a key like others. ``trees`` saves reading both for their trees.
    """
    left, right = trees or (hash_tree(df, keys, bits, step), hash_tree(other, keys, bits, step))
    ranges = differing_ranges(left, right, bits, step)

    def rows(side: DataFrame, name: str) -> DataFrame:
        own = _within(side, keys, ranges, bits)
        return own.groupBy(*keys).agg(*_content(own)).select(*[F.col(k).alias(f"{name}{i}") for i, k in enumerate(keys)],
                                                             F.struct("rows", "content").alias(name))

    same = reduce(lambda x, y: x & y, [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(keys))])
    both = rows(df, "_a").join(rows(other, "_b"), same, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    kind = F.when(F.col("_b").isNull(), MISSING).when(F.col("_a").isNull(), EXTRA).otherwise(CHANGED)
    return both.select(*[F.when(F.col("_a").isNull(), F.col(f"_b{i}")).otherwise(F.col(f"_a{i}")).alias(k) for i, k in enumerate(keys)],
                       kind.alias("difference"))


def overwrite_ranged(df: DataFrame, table: str, keys: Sequence[str], bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """Replace a table by one with its ranges as partitions (``_range``), and its tree in ``<table>__tree``."""
    spark = df.sparkSession
    ensure_database(spark, table)
    (df.withColumn(RANGE, _range(keys, RANGE_BITS)).write.mode("overwrite").format("parquet").partitionBy(RANGE)
     .option("path", table_path(spark, table)).saveAsTable(table))
    overwrite_table(hash_tree(spark.table(table), keys, bits, step), f"{table}__tree")
    return spark.table(table)


def tree_of(spark: SparkSession, table: str) -> DataFrame:
    """The tree kept beside a table by :func:`overwrite_ranged`: of what was written, not of what is there now."""
    return spark.table(f"{table}__tree")
