"""History kept from a stream of changes: the streaming form of ``operators.scd.scd2_from_log``."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.streaming.ordered import AT, GROUPS, KEY, OrderedProcessor, by_key, in_order, timed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class HistoryProcessor(OrderedProcessor):
    """Keeps the open version of each key. A version is given out when it opens, and again with its end when it closes.

    Values come and go as text in the columns ``shown``, of which ``start`` is the time, so none is changed on the way.
    """

    def __init__(self, shown: Sequence[str], start: str, order: Sequence[str], bucket_ms: int):
        super().__init__(order, bucket_ms)
        self.shown, self.start = list(shown), start

    def take(self, kept: pd.DataFrame | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        rows, others = rows[[KEY, *self.shown, "_state"]].assign(_new=True), []
        if kept is not None:
            met = kept[KEY].isin(rows[KEY])
            others = [kept[~met]]
            # before a key's rows comes the version that was open
            rows = pd.concat([kept[met].assign(_new=False), rows], ignore_index=True)
        rows, first = by_key(rows)
        starting = first | (rows["_state"] != rows["_state"].shift()).to_numpy()
        starts, first = rows[starting], first[starting]
        last = np.append(first[1:], True)
        closed = starts.assign(_end=starts[self.start].shift(-1))[~last]
        opened = starts[starts["_new"].astype(bool)].assign(_end=None)
        kept = pd.concat([*others, starts[last].drop(columns="_new")], ignore_index=True)
        return pd.concat([closed, opened])[[*self.shown, "_end"]].assign(late=False), kept

    def late(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows[self.shown].assign(_end=None, late=True)


def history_stream(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], order: Sequence[str], delay: str,
                   clock: Column | None = None, bucket_ms: int = 3_600_000, groups: int = GROUPS) -> DataFrame:
    """``keys, tracked, order, end_at, late`` from a stream of changes: every version when it opens and when it closes.

    ``order`` is as in ``scd2_from_log``: a timestamp first, all together unique within a key and never NULL. Changes may come
    in any order within ``delay`` of the newest one; what comes later still is given out as it is, marked ``late``, for a
    splice. Versions are compared by all tracked columns, NULL being a value of its own. Columns are plain values, no structs.
    The keys share state by ``groups``.
    """
    columns = list(dict.fromkeys([*keys, *tracked, *order]))
    shown, ranks = [f"_c{i}" for i in range(len(columns))], [f"_o{i}" for i in range(len(order))]
    text = lambda c: F.hex(c) if log.schema[c].dataType.typeName() == "binary" else F.col(c).cast("string")
    state = F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)
    rows = timed(log, F.col(order[0]), delay, clock).select(
        *keys, *[text(c).alias(n) for c, n in zip(columns, shown)], *[F.col(c).alias(n) for c, n in zip(order, ranks) if c not in keys],
        state.alias("_state"), AT)
    ranks = [n for c, n in zip(order, ranks) if c not in keys]
    output = ", ".join([*[f"{n} STRING" for n in shown], "_end STRING", "late BOOLEAN"])
    told = in_order(rows, keys, HistoryProcessor(shown, shown[columns.index(order[0])], ranks, bucket_ms), output, groups)

    def value(c: str, name: str) -> Column:
        kind = log.schema[c].dataType
        return F.unhex(name) if kind.typeName() == "binary" else F.col(name).cast(kind)

    return told.select(*[value(c, n).alias(c) for c, n in zip(columns, shown)], value(order[0], "_end").alias("end_at"), "late")


def write_history(versions: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there into ``path``, in folders ``late=false`` and ``late=true``, each change once over all runs."""
    from dimflow.streaming.sessions import rocksdb_state

    with rocksdb_state(versions.sparkSession):
        query = (versions.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
                 .partitionBy("late").trigger(availableNow=True).start())
    query.awaitTermination()


def history_of(written: DataFrame, keys: Sequence[str], tracked: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keys, tracked, start_at, end_at, is_current`` from what :func:`write_history` wrote: one row per version.

    A version has at most two rows, so the grouping is even however many versions a key has.
    """
    own = written.filter(~F.col("late").cast("boolean"))  # a folder name, read as text
    one = own.groupBy(*dict.fromkeys([*keys, *order])).agg(*[F.first(c).alias(c) for c in tracked if c not in (*keys, *order)],
                                                            F.max("end_at").alias("end_at"))
    return one.select(*keys, *tracked, F.col(order[0]).alias("start_at"), "end_at", F.col("end_at").isNull().alias("is_current"))
