"""Joins and ordered windows that hold when one key owns a large share of the rows.

Keys are counted first (partial aggregation, so a hot key shuffles as one small row per task). Without hot keys the
plain Spark join or window runs. There are at most rows / limit hot keys; they are kept as a stored table, measured, and
broadcast only when that is small enough.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.storage import checkpointed

HOT_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
LINES_PER_PART = 100_000


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS, weight: Column | None = None) -> DataFrame | None:
    """The keys with more than ``limit`` rows and their ``_rows``, stored, or None. ``weight`` sums up what counts instead."""
    return heaviest(df.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else weight).alias("_rows")), limit)


def heaviest(counts: DataFrame, limit: int = HOT_ROWS) -> DataFrame | None:
    """:func:`hot_keys` from keys already counted in ``_rows``."""
    found = checkpointed(counts.filter(F.col("_rows") > limit))
    return None if found.isEmpty() else found


def _when_small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it measures at most ``BROADCAST_BYTES``."""
    return F.broadcast(df) if byte_size(df) <= BROADCAST_BYTES else df


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys); NULL counts as a key."""
    names = [f"_hot{i}" for i in range(len(keys))]
    small = _when_small(hot.select([F.col(k).alias(n) for k, n in zip(keys, names)]))
    condition = _same(keys, names)
    return df.join(small, condition, "left_anti"), df.join(small, condition, "left_semi")


def byte_size(df: DataFrame) -> int:
    """An estimate of the rows' size from one aggregation: text by its bytes, other plain values as 16 bytes."""
    def width(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(F.struct(c))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.lit(16)
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))

    total = reduce(lambda a, b: a + b, map(width, df.schema.fields))
    return df.agg(F.sum(total.cast("long"))).first()[0] or 0


def join_skewed(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", limit: int = HOT_ROWS,
                broadcast_bytes: int = BROADCAST_BYTES, counts: DataFrame | None = None) -> DataFrame:
    """Join to a side that is unique by ``on``, whatever the distribution of the keys on the other side.

    A dimension measured to be at most ``broadcast_bytes`` is broadcast. A larger one is shuffled, except for the hot
    keys: their rows stay where they are and meet a broadcast of the matching, hence few, dimension rows, or copies of
    these under salted keys if they are too wide to broadcast. ``counts`` saves counting the keys of ``fact`` when
    that is done already. The columns of ``fact`` come first, in their order.
    """
    on = list(on)
    shown = list(fact.columns)
    if how in ("inner", "left"):
        shown += [c for c in dim.columns if c not in on]
    return _join_by_size(fact, dim, on, how, limit, broadcast_bytes, counts).select(*[F.col(f"`{c}`") for c in shown])


def _join_by_size(fact: DataFrame, dim: DataFrame, on: list[str], how: str, limit: int, broadcast_bytes: int,
                  counts: DataFrame | None) -> DataFrame:
    if byte_size(dim) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), on, how)
    hot = hot_keys(fact, on, limit) if counts is None else heaviest(counts, limit)
    if hot is None:
        return fact.join(dim, on, how)
    cold_rows, hot_rows = split_hot(fact, on, hot)
    hot_dim = dim.join(_when_small(hot.select(*on)), on, "left_semi")
    if byte_size(hot_dim) <= broadcast_bytes:
        joined = hot_rows.join(F.broadcast(hot_dim), on, how)
    else:
        joined = _join_salted(hot_rows, hot_dim, on, how, hot, limit)
    return cold_rows.join(dim, on, how).unionByName(joined)


def _join_salted(hot_rows: DataFrame, hot_dim: DataFrame, on: list[str], how: str, hot: DataFrame,
                 limit: int) -> DataFrame:
    """A shuffled join in which a key is spread over as many salts as it has multiples of ``limit`` rows."""
    names = [f"_hot{i}" for i in range(len(on))]
    salts = hot.select(*[F.col(k).alias(n) for k, n in zip(on, names)],
                       F.ceil(F.col("_rows") / limit).cast("long").alias("_salts"))
    # from stored rows: a salt must not change when a lost task is repeated
    salts = _when_small(salts)
    salted = (checkpointed(hot_rows).join(salts, _same(on, names))
              .withColumn("_salt", F.monotonically_increasing_id() % F.col("_salts")).drop(*names, "_salts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
    copies = (hot_dim.join(salts, _same(on, names))
              .withColumn("_salt", F.explode(every)).drop(*names, "_salts"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


@dataclass(frozen=True)
class OrderedGroups:
    """Ordered windows per key over groups of any size.

    The rows of hot keys are range-partitioned by (key, order), so that a hot key spans many partitions, and each
    partition becomes one piece of its key. Windows run per (key, piece); what crosses a border between pieces is
    carried over from one summary row per piece, of which there are about two for each ``limit`` rows of hot keys.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    pieced: bool

    @staticmethod
    def of(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = HOT_ROWS,
           unique: bool = True) -> "OrderedGroups":
        """``limit`` None says that no key is hot. ``unique`` says that the order columns decide between any two rows
        of a key. Without it copies, which would all fall into one range, get a running number once they are stored."""
        keys, order = tuple(keys), tuple(order)
        hot = None if limit is None else hot_keys(df, keys, limit)
        if hot is None:
            return OrderedGroups(df, keys, order, False)
        cold_rows, hot_rows = split_hot(df, keys, hot)
        rows = hot.agg(F.sum("_rows")).first()[0]
        pieces = 2 * math.ceil(rows / limit)
        if not unique:
            hot_rows = checkpointed(hot_rows).withColumn("_tie", F.monotonically_increasing_id())
            cold_rows = cold_rows.withColumn("_tie", F.lit(0).cast("long"))
            order = (*order, "_tie")
        ranged = hot_rows.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id())
        # read more than once below: all readings must see the same pieces
        ranged = checkpointed(ranged)
        cold_rows = cold_rows.withColumn("_piece", F.lit(-1))
        return OrderedGroups(cold_rows.unionByName(ranged), keys, order, True)

    def with_df(self, df: DataFrame) -> "OrderedGroups":
        return OrderedGroups(df, self.keys, self.order, self.pieced)

    def filter(self, condition: Column) -> "OrderedGroups":
        return self.with_df(self.df.filter(condition))

    def _window(self):
        if not self.pieced:
            return Window.partitionBy(*self.keys).orderBy(*self.order)
        return Window.partitionBy(*self.keys, "_piece").orderBy(*self.order)

    def _carry(self, name: str, summary: Column, across: Column) -> DataFrame:
        """Attach ``name``: ``across`` over the pieces of a key, of each piece's ``summary``."""
        pieces = (self.df.filter(F.col("_piece") >= 0).groupBy(*self.keys, "_piece").agg(summary.alias("_sum"))
                  .select(*self.keys, "_piece", across.alias(name)))
        names = {k: f"_key{i}" for i, k in enumerate((*self.keys, "_piece"))}
        small = _when_small(checkpointed(pieces.withColumnsRenamed(names)))
        return self.df.join(small, _same(list(names), list(names.values())), "left").drop(*names.values())

    def _between_pieces(self):
        return Window.partitionBy(*self.keys).orderBy("_piece")

    def _position(self) -> Column:
        return F.struct(*self.order)

    def lag(self, name: str, value: Column) -> "OrderedGroups":
        """``value`` (never NULL, e.g. a struct) of the row before."""
        if not self.pieced:
            return self.with_df(self.df.withColumn(name, F.lag(value).over(self._window())))
        df = self._carry("_carry", F.max_by(value, self._position()), F.lag("_sum").over(self._between_pieces()))
        return self.with_df(df.withColumn(name, F.coalesce(F.lag(value).over(self._window()), F.col("_carry")))
                            .drop("_carry"))

    def lead(self, name: str, value: Column) -> "OrderedGroups":
        """``value`` (never NULL) of the row after."""
        if not self.pieced:
            return self.with_df(self.df.withColumn(name, F.lead(value).over(self._window())))
        df = self._carry("_carry", F.min_by(value, self._position()), F.lead("_sum").over(self._between_pieces()))
        return self.with_df(df.withColumn(name, F.coalesce(F.lead(value).over(self._window()), F.col("_carry")))
                            .drop("_carry"))

    def last_before(self, name: str, value: Column) -> "OrderedGroups":
        """The last ``value`` that is not NULL among all earlier rows."""
        earlier = (Window.unboundedPreceding, -1)
        running = F.last(value, ignorenulls=True).over(self._window().rowsBetween(*earlier))
        if not self.pieced:
            return self.with_df(self.df.withColumn(name, running))
        df = self._carry("_carry", F.max_by(value, F.when(value.isNotNull(), self._position())),
                         F.last("_sum", ignorenulls=True).over(self._between_pieces().rowsBetween(*earlier)))
        return self.with_df(df.withColumn(name, F.coalesce(running, F.col("_carry"))).drop("_carry"))

    def sum_before(self, name: str, value: Column) -> "OrderedGroups":
        """The sum of a whole-number ``value`` over all earlier rows, 0 for the first."""
        earlier = (Window.unboundedPreceding, -1)
        running = F.coalesce(F.sum(value).over(self._window().rowsBetween(*earlier)), F.lit(0)).cast("long")
        if not self.pieced:
            return self.with_df(self.df.withColumn(name, running))
        df = self._carry("_carry", F.sum(value), F.sum("_sum").over(self._between_pieces().rowsBetween(*earlier)))
        total = running + F.coalesce(F.col("_carry"), F.lit(0)).cast("long")
        return self.with_df(df.withColumn(name, total).drop("_carry"))

    def row_number(self, name: str) -> "OrderedGroups":
        """1-based position in the group."""
        if not self.pieced:
            return self.with_df(self.df.withColumn(name, F.row_number().over(self._window()).cast("long")))
        numbered = self.sum_before(name, F.lit(1))
        return numbered.with_df(numbered.df.withColumn(name, F.col(name) + 1))

    def result(self) -> DataFrame:
        return self.df.drop("_tie", "_piece")


def join_lines(lines: DataFrame, keys: Sequence[str], order: Sequence[str], line: str, name: str,
               separator: str = "\n", lines_per_part: int = LINES_PER_PART, limit: int = HOT_ROWS,
               unique: bool = False) -> DataFrame:
    """The lines of each group as text: ``keys, part, <name>, lines``, the last being the number of lines in it.

    A group of at most ``lines_per_part`` lines is one row with part 1. A larger one continues in parts 2, 3, ...,
    which joined by the separator are the whole text, so no row and no task holds an unbounded group. Copies of a line
    travel as one row with a count, unless ``unique`` says that the order columns leave no copies.
    """
    columns = list(dict.fromkeys([*keys, *order, line]))
    rows = lines.filter(F.col(line).isNotNull())
    if unique:
        counted = rows.select(*columns, F.lit(1).cast("long").alias("_copies"))
    else:
        counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
        order = list(dict.fromkeys([*order, line]))
        # all copies together are no fewer than the counted rows, and cheaper to count
        if hot_keys(rows.select(*keys), keys, limit) is None:
            limit = None
    placed = OrderedGroups.of(counted, keys, order, limit).sum_before("_start", F.col("_copies")).result()
    return _in_parts(placed, keys, line, name, separator, lines_per_part, limit is not None and not unique)


def join_numbered(numbered: DataFrame, keys: Sequence[str], number: str, line: str, name: str, separator: str = "\n",
                  lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """:func:`join_lines` for lines that are numbered from 1 within their group already."""
    placed = numbered.select(*keys, line, (F.col(number) - 1).alias("_start"), F.lit(1).cast("long").alias("_copies"))
    return _in_parts(placed, keys, line, name, separator, lines_per_part)


def _in_parts(placed: DataFrame, keys: Sequence[str], line: str, name: str, separator: str, lines_per_part: int,
              scatter: bool = False) -> DataFrame:
    """Text of lines with the number of lines before them in ``_start`` and their number of ``_copies``.

    ``scatter`` says that few rows may stand for very many copies, whose parts should not be written by one task.
    """
    first = F.expr(f"_start div {lines_per_part}")
    last = F.expr(f"(_start + _copies - 1) div {lines_per_part}")
    # a line may go on in later parts: one row for each, with as many copies as fall into it
    spread = placed.withColumn("_at", F.explode(F.sequence(first, last)))
    begin, end = F.col("_at") * lines_per_part, (F.col("_at") + 1) * lines_per_part
    inside = (F.least(end, F.col("_start") + F.col("_copies")) - F.greatest(begin, F.col("_start"))).cast("int")
    spread = spread.select(*keys, "_at", "_start", line, inside.alias("_n"))
    if scatter:
        spread = spread.repartition(*keys, "_at")
    # otherwise numbering has put the rows of a key into one task, and this grouping moves no data
    grouped = spread.groupBy(*keys, (F.col("_at") + 1).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("_start", "_n", line))).alias("_lines"), F.sum("_n").cast("int").alias("lines"))
    texts = F.transform("_lines", lambda x: F.when(x["_n"] == 1, x[line]).otherwise(
        F.array_join(F.array_repeat(x[line], x["_n"]), separator)))
    # mostly every line is there once
    texts = F.when(F.size("_lines") == F.col("lines"), F.col(f"_lines.{line}")).otherwise(texts)
    return grouped.select(*keys, "part", F.array_join(texts, separator).alias(name), "lines")
