"""Putting a late batch between the versions of a type 2 or type 6 history.

A batch says what its keys were on its date. What is known of a later day stays as it is: the batch's version ends where the
key was next seen, whether that sighting began a version or confirmed one. Sightings, one (key, date) row per key and load,
are what makes the order of loads immaterial; without them a version counts as seen again only where the next one begins.

Per key a batch touches at most the version valid on its date and one neighbour to either side. These are found by
aggregation, so a key may have any number of versions; the rest of the history is neither moved nor rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.operators.skew import BROADCAST_BYTES, byte_size

SEEN = "seen_date"


def sightings(stage: DataFrame, keys: Sequence[str], date: Column) -> DataFrame:
    """``keys, seen_date``: that a batch of that date had these keys."""
    return stage.select(*keys, date.alias(SEEN)).distinct()


def is_late(dim: DataFrame, date: Column, seen: DataFrame | None = None) -> bool:
    """Whether anything is known of the batch's day or a later one."""
    return not (dim.filter(F.col("start_date") >= date).isEmpty() and (seen is None or seen.filter(F.col(SEEN) >= date).isEmpty()))


def _neighbours(dim: DataFrame, stage: DataFrame, keys: Sequence[str], date: Column, small: bool) -> DataFrame:
    """``keys`` with the version valid on the date, one that ends then, and the first that begins later."""
    ids = stage.select(*keys)
    near = dim.filter(F.col("end_date").isNull() | (F.col("end_date") >= date))
    near = near.join(F.broadcast(ids) if small else ids, list(keys), "left_semi")
    row, start = F.struct(*dim.columns), F.col("start_date")
    return near.groupBy(*keys).agg(F.max_by(row, F.when((start <= date) & ~F.col("end_date").eqNullSafe(date), start)).alias("_at"),
                                   F.max_by(row, F.when(F.col("end_date") == date, start)).alias("_before"),
                                   F.min_by(row, F.when(start > date, start)).alias("_after"))


def _next_seen(seen: DataFrame, stage: DataFrame, keys: Sequence[str], date: Column, small: bool) -> DataFrame:
    ids = stage.select(*keys)
    later = seen.filter(F.col(SEEN) > date).join(F.broadcast(ids) if small else ids, list(keys), "left_semi")
    return later.groupBy(*keys).agg(F.min(SEEN).alias("_seen"))


def splice(dim: DataFrame, staged: DataFrame, keys: Sequence[str], tracked: Sequence[str], date: Column,
           seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new versions, ``keys, start_date`` of the versions they replace) for a batch with one hashed row per key.

    ``dim`` is the whole history. A batch of a day that is known already replaces what was known of that day. Columns of
    ``dim`` named ``current_<c>`` and ``prev_<c>`` are kept as in type 6; ``current_<c>`` only on the versions given out.
    Columns that are not tracked keep what the first sighting of a version says.
    """
    small = byte_size(staged) <= BROADCAST_BYTES
    new = staged.select(*keys, F.struct(*staged.columns).alias("_new"))
    both = new.join(_neighbours(dim, staged, keys, date, small), list(keys), "left")
    both = (both.withColumn("_seen", F.lit(None).cast("date")) if seen is None
            else both.join(_next_seen(seen, staged, keys, date, small), list(keys), "left"))

    def same(a: Column, b: Column) -> Column:
        return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in tracked])

    at, before, after, fresh = (F.col(c) for c in ("_at", "_before", "_after", "_new"))
    both = both.filter(at.isNull() | ~same(at, fresh))  # what is known anyway needs no splice
    kind = dim.schema.simpleString()  # every field may be NULL
    newest = {f"current_{c}": c for c in tracked} if f"current_{tracked[0]}" in dim.columns else {}
    previous = {f"prev_{c}": c for c in tracked} if newest else {}

    # a day that a version ended on or began after was a day of sighting, too
    until = F.least("_seen", F.coalesce(at["end_date"], after["start_date"]))  # NULL is passed over
    goes_on = at.isNotNull() & until.isNotNull() & (at["end_date"].isNull() | (until < at["end_date"]))
    starts = at["start_date"] < date
    inserted = F.struct(*[(fresh[c] if c in staged.columns else F.lit(None).cast(dim.schema[c].dataType)).alias(c)
                          for c in dim.columns]).cast(kind)

    def point(row: Column, start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), end.cast("date").alias("end"), row.cast(kind).alias("row"))

    points = F.filter(F.array(
        F.when(at.isNull() | ~starts, F.when(before.isNotNull(), point(before, before["start_date"], before["end_date"]))),
        F.when(starts, point(at, at["start_date"], date)),
        point(inserted, date, until),
        F.when(goes_on, point(at, until, at["end_date"])),
        F.when(~F.coalesce(goes_on, F.lit(False)) & after.isNotNull(), point(after, after["start_date"], after["end_date"]))),
        lambda p: p.isNotNull())
    both = both.withColumn("_points", points).withColumn("_known", F.coalesce("_after", "_at", "_before"))

    def joined(done: Column, p: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        more = F.struct(last["start"].alias("start"), p["end"].alias("end"), last["row"].alias("row"))
        goes_with = (F.size(done) > 0) & same(last["row"], p["row"]) & last["end"].eqNullSafe(p["start"])
        return F.when(goes_with, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(more))).otherwise(
            F.concat(done, F.array(p)))

    none = F.filter("_points", lambda p: F.lit(False))
    both = both.withColumn("_merged", F.aggregate("_points", none, joined))
    last = F.try_element_at("_merged", F.lit(-1))

    def version(p: Column, i: Column) -> Column:
        earlier = F.try_element_at(F.col("_merged"), F.greatest(i, F.lit(1)))["row"]

        def value(c: str) -> Column:
            if c in newest:
                return F.when(last["end"].isNull(), last["row"][newest[c]]).otherwise(F.col("_known")[c])
            if c in previous:
                return F.when(i > 0, earlier[previous[c]]).otherwise(p["row"][c])
            return {"start_date": p["start"], "end_date": p["end"], "is_current": p["end"].isNull()}.get(c, p["row"][c])

        return F.struct(*[value(c).alias(c) for c in dim.columns])

    rows = both.select(F.inline(F.transform("_merged", version))).select(*[F.col(c).cast(dim.schema[c].dataType) for c in dim.columns])
    gone = F.filter(F.array(at["start_date"], F.when(at.isNull() | ~starts, before["start_date"]),
                            F.when(~F.coalesce(goes_on, F.lit(False)), after["start_date"])), lambda d: d.isNotNull())
    return rows, both.select(*keys, F.explode(gone).alias("start_date"))


def spliced(dim: DataFrame, rows: DataFrame, replaced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The history with the versions of a splice in place of those they replace."""
    small = byte_size(replaced) <= BROADCAST_BYTES
    left = dim.join(F.broadcast(replaced) if small else replaced, [*keys, "start_date"], "left_anti")
    return left.select(*dim.columns).unionByName(rows)
