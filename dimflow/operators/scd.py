"""Slowly changing dimensions of types 0, 1, 2, 3, 4 and 6.

``dim`` is the dimension so far and ``stage`` a cleaned batch with one row per business key. Keys absent from the batch
keep their rows. Both sides of every merge hold a key once, so its shuffle is even; closed versions, which may be many
per key, are never shuffled by key except through the skew-proof helpers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.protect import row_hash
from dimflow.operators.skew import BROADCAST_BYTES, HOT_ROWS, OrderedGroups, byte_size, join_skewed
from dimflow.operators.splice import is_late, splice, spliced
from dimflow.sources.storage import checkpointed

VALIDITY = ("start_date", "end_date", "is_current")


def load_date(as_of: str | None) -> Column:
    """The given date, or today."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def with_hash(stage: DataFrame, tracked: Sequence[str]) -> DataFrame:
    return stage.withColumn("hash", row_hash(tracked))


def _unknown(stage: DataFrame, dim: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """The batch rows whose key the dimension lacks. A small batch is sent to the dimension, not the other way."""
    known = dim.select(*keys)
    if small:
        known = F.broadcast(known.join(F.broadcast(stage.select(*keys)), list(keys), "left_semi"))
    return stage.join(known, list(keys), "left_anti")


def _same(tracked: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in tracked])


def _paired(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Both sides by key as ``_old`` and ``_new`` structs, with the ``change`` between them.

    A batch measured to be small is broadcast, so the dimension, however large, is scanned but not shuffled. Otherwise
    both sides are shuffled once.
    """
    old = dim.select(*keys, F.struct(*dim.columns).alias("_old"))
    new = stage.select(*keys, F.struct(*stage.columns).alias("_new"))
    if byte_size(stage) <= BROADCAST_BYTES:
        fresh = _unknown(new, dim, keys, True)
        both = old.join(F.broadcast(new), list(keys), "left").unionByName(
            fresh.withColumn("_old", F.lit(None).cast(old.schema["_old"].dataType)))
    else:
        both = old.join(new, list(keys), "full_outer")
    change = (F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "absent")
              .when(_same(tracked), "unchanged").otherwise("changed"))
    return both.withColumn("change", change)


def classify_changes(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """``keys, change``: new, changed, unchanged or absent. Columns are compared null-safely, not by hash."""
    return _paired(dim, stage, keys, tracked).select(*keys, "change")


def scd0(dim: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows never change; new keys are added."""
    small = byte_size(stage.select(*keys)) <= BROADCAST_BYTES
    return dim.unionByName(_unknown(stage, dim, keys, small).select(*dim.columns))


def scd1_reload(stage: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """The batch replaces the dimension."""
    return with_hash(stage, tracked)


def scd1_upsert(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Batch rows overwrite, new keys are added, absent keys stay."""
    staged = with_hash(stage, tracked).select(*dim.columns)
    both = _paired(dim, staged, keys, tracked)
    return both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def scd2_initial(stage: DataFrame, tracked: Sequence[str], as_of: str | None = None) -> DataFrame:
    """Every batch row as a first, current version."""
    return stage.select(*stage.columns, load_date(as_of).alias("start_date"),
                        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"),
                        row_hash(tracked).alias("hash"))


def _versions(both: DataFrame, columns: Sequence[str], closing: dict[str, Column], opening: dict[str, Column],
              keeping: dict[str, Column] | None = None) -> DataFrame:
    """One to two versions per key: kept, opened, or closed and opened. The dicts override columns of each."""
    def version(side: str, over: dict[str, Column]) -> Column:
        return F.struct(*[over.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])

    kept, closed = version("_old", keeping or {}), version("_old", closing)
    opened = version("_new", opening)
    rows = (F.when(F.col("change") == "new", F.array(opened))
            .when(F.col("change") == "changed", F.array(closed, opened)).otherwise(F.array(kept)))
    return both.select(F.inline(rows))


def scd2_changes(current: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 as_of: str | None = None) -> DataFrame:
    """The current versions after the batch, and those it closes. Versions closed earlier are not needed."""
    date = load_date(as_of)
    staged = with_hash(stage, tracked)
    closing = {"end_date": date, "is_current": F.lit(False)}
    opening = {"start_date": date, "end_date": F.lit(None).cast("date"), "is_current": F.lit(True)}
    return _versions(_paired(current, staged, keys, tracked), current.columns, closing, opening)


def _with_late(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str | None,
               seen: DataFrame | None) -> DataFrame | None:
    """The history with a batch put between its versions, or None if nothing is known of the batch's day or later."""
    date = load_date(as_of)
    if not is_late(dim, date, seen):
        return None
    rows, replaced = splice(dim, with_hash(stage, tracked), keys, tracked, date, seen)
    return spliced(dim, checkpointed(rows), checkpointed(replaced), keys)


def scd2_merge(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               as_of: str | None = None, seen: DataFrame | None = None) -> DataFrame:
    """Full history: changed keys get a closed old and a new current version. The same batch again changes nothing.

    A batch of a day already known is put between the versions around it; with ``seen``, the sightings (``keys, seen_date``)
    of all batches so far, every order of batches of different days gives the same history.
    """
    late = _with_late(dim, stage, keys, tracked, as_of, seen)
    if late is not None:
        return late
    changes = scd2_changes(dim.filter("is_current"), stage, keys, tracked, as_of)
    return dim.filter("NOT is_current").unionByName(changes)


def scd2_from_log(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], order: Sequence[str],
                  limit: int = HOT_ROWS) -> DataFrame:
    """History from a change log: ``keys, tracked, start_at, end_at, is_current``.

    Equal neighbours collapse; a version ends where the next starts. The first order column is the time, and the
    order columns together must be unique within a key.
    """
    state = F.struct(*tracked)
    rows = log.select(*dict.fromkeys([*keys, *tracked, *order]))
    history = OrderedGroups.of(rows, keys, order, limit).lag("_before", state)
    # the first row of a key has no row before it
    history = history.filter(~F.col("_before").eqNullSafe(state)).lead("_after", F.struct(order[0]))
    end = F.col(f"_after.{order[0]}")
    return history.df.select(*keys, *tracked, F.col(order[0]).alias("start_at"), end.alias("end_at"),
                             F.col("_after").isNull().alias("is_current"))


def scd3_initial(stage: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The batch with empty ``prev_`` columns."""
    return stage.select(*stage.columns, *[F.lit(None).cast(stage.schema[c].dataType).alias(f"prev_{c}")
                                          for c in columns])


def scd3(dim: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``prev_<c>`` takes the old value of a column when it changes: one step of history per column."""
    both = _paired(dim, scd3_initial(stage, columns), keys, columns)
    absent, new = F.col("change") == "absent", F.col("change") == "new"

    def value(name: str) -> Column:
        old, fresh = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        if not (name.startswith("prev_") and name[len("prev_"):] in columns):
            return F.when(absent, old).otherwise(fresh)
        before, after = F.col(f"_old.{name[len('prev_'):]}"), F.col(f"_new.{name[len('prev_'):]}")
        return F.when(new, fresh).when(absent | before.eqNullSafe(after), old).otherwise(before)

    return both.select(*[value(c).alias(c) for c in dim.columns])


def scd4(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str],
         as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(current rows, rows replaced by this batch with ``valid_to``); the second go to a history table.

    With a small batch both are a scan of the dimension; a large one is paired with it once, and the pairs stored for both.
    """
    staged = with_hash(stage, tracked).select(*dim.columns)
    if byte_size(staged) <= BROADCAST_BYTES:
        new = staged.select(*keys, F.struct(*staged.columns).alias("_new"))
        both = dim.select(*keys, F.struct(*dim.columns).alias("_old")).join(F.broadcast(new), list(keys)).filter(~_same(tracked))
        current = scd1_upsert(dim, stage, keys, tracked)
    else:
        both = checkpointed(_paired(dim, staged, keys, tracked))
        current = both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")
        both = both.filter(F.col("change") == "changed")
    return current, both.select("_old.*", load_date(as_of).alias("valid_to"))


def scd6_initial(stage: DataFrame, tracked: Sequence[str], as_of: str | None = None) -> DataFrame:
    """Type 2 rows with ``current_<c>`` equal to the value and ``prev_<c>`` empty."""
    return as_type6(scd2_initial(stage, tracked, as_of), tracked)


def as_type6(first: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """First versions with the extra columns of type 6."""
    return first.select(*first.columns, *[F.col(c).alias(f"current_{c}") for c in tracked],
                        *[F.lit(None).cast(first.schema[c].dataType).alias(f"prev_{c}") for c in tracked])


def scd6_changes(current: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 as_of: str | None = None) -> DataFrame:
    """As :func:`scd2_changes`: ``current_<c>`` is set on the versions returned, ``prev_<c>`` on the new ones."""
    date = load_date(as_of)
    staged = with_hash(stage, tracked)
    newest = {f"current_{c}": F.col(f"_new.{c}") for c in tracked}
    # NULL unless there was an older version
    previous = {f"prev_{c}": F.col(f"_old.{c}") for c in tracked}
    closing = {"end_date": date, "is_current": F.lit(False), **newest}
    opening = {"start_date": date, "end_date": F.lit(None).cast("date"), "is_current": F.lit(True),
               **newest, **previous}
    return _versions(_paired(current, staged, keys, tracked), current.columns, closing, opening)


def refresh_type6(closed: DataFrame, current: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                  limit: int = HOT_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Closed versions with ``current_<c>`` taken from their key's current version. Keys may have many versions."""
    newest = current.select(*keys, F.struct(*tracked).alias("_newest"))
    joined = join_skewed(closed, newest, keys, "left", limit, broadcast_bytes)
    names = {f"current_{c}": F.col(f"_newest.{c}") for c in tracked}
    return joined.select(*[names.get(c, F.col(c)).alias(c) for c in closed.columns])


def scd6(dim: DataFrame, stage: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str | None = None,
         limit: int = HOT_ROWS, broadcast_bytes: int = BROADCAST_BYTES, seen: DataFrame | None = None) -> DataFrame:
    """Full history in which all versions of a key also show its newest values, and each its predecessor's. Late batches
    are taken as by :func:`scd2_merge`."""
    late = _with_late(dim, stage, keys, tracked, as_of, seen)
    if late is not None:
        late = checkpointed(late)
        current = late.filter("is_current")
        return refresh_type6(late.filter("NOT is_current"), current, keys, tracked, limit, broadcast_bytes).unionByName(current)
    changes = scd6_changes(dim.filter("is_current"), stage, keys, tracked, as_of)
    closed = refresh_type6(dim.filter("NOT is_current"), changes.filter("is_current"), keys, tracked, limit,
                           broadcast_bytes)
    return closed.unionByName(changes)


def as_of(dim: DataFrame, date: str) -> DataFrame:
    """The versions valid on a date."""
    day = F.lit(date).cast("date")
    return dim.filter((F.col("start_date") <= day) & (F.col("end_date").isNull() | (day < F.col("end_date"))))
