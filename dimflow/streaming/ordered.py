"""Rows of a stream in the order of their event time, whatever micro-batch brings them.

Rows wait in state until the watermark has passed them; a timer then hands them on in order. A row that the watermark had
passed before it came can no longer be put in order: it is given out as late, never dropped. Keys are dealt into a fixed number
of groups, which share their state and timers: what a call to a state handler costs is paid by group, not by key.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the handlers travel to the workers by value, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT = "_at"  # event time in milliseconds, the unit of watermarks
BUCKET_MS = 60_000
GROUP, KEY = "_group", "_key"  # the group of a row's key, and the key as text that is never missing
GROUPS = 1024


def timed(rows: DataFrame, event_time: Column, delay: str, clock: Column | None = None) -> DataFrame:
    """``rows`` with their event time in ``_at`` under a watermark. Rows for which ``clock`` holds only move the watermark.

    The column that carries the watermark goes no further, so Spark does not drop late rows by it.
    """
    stamped = rows.withColumn("_event_time", event_time.cast("timestamp")).withWatermark("_event_time", delay)
    if clock is not None:
        # one expression with the event time, which keeps the filter above the watermark
        stamped = stamped.filter(F.when(F.col("_event_time").isNotNull(), ~F.coalesce(clock, F.lit(False))).otherwise(True))
    return stamped.withColumn(AT, F.unix_millis("_event_time")).drop("_event_time")


def packed(frame: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    table = pa.Table.from_pandas(frame, preserve_index=False)
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def unpacked(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas(integer_object_nulls=True)


def by_key(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The rows with those of a key together, otherwise in the order they are in, and whether a row is the first of its key."""
    codes = pd.factorize(rows[KEY])[0]
    places = np.argsort(codes, kind="stable")
    codes = codes[places]
    return rows.iloc[places].reset_index(drop=True), np.append(True, codes[1:] != codes[:-1])[:len(codes)]


def dealt(rows: DataFrame, keys: Sequence[str], groups: int = GROUPS) -> DataFrame:
    """``rows`` with their key as text and its group. The number of groups must stay the same over a checkpoint's life."""
    plain = [F.hex(c) if rows.schema[c].dataType.typeName() == "binary" else F.col(c).cast("string") for c in keys]
    return (rows.withColumn(KEY, F.to_json(F.array(*plain), {"ignoreNullFields": "false"}))
            .withColumn(GROUP, F.pmod(F.xxhash64(KEY), F.lit(groups)).cast("int")))


class GroupProcessor(StatefulProcessor):
    """Keeps one small row per key, ``kept`` being those of all keys of a group: a frame, packed into one value."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getValueState("kept", "rows BINARY")

    def _kept(self) -> pd.DataFrame | None:
        return unpacked(bytes(self._rows.get()[0])) if self._rows.exists() else None

    def _store(self, kept: pd.DataFrame) -> None:
        self._rows.update((packed(kept),))

    def close(self) -> None:
        pass


class OrderedProcessor(GroupProcessor):
    """Keeps rows by buckets of event time and hands them to :meth:`take` in the order of ``order``.

    A group's rows are held in memory one bucket at a time. What one micro-batch brings is stored as it comes, in Arrow
    batches; so neither a key with very many rows nor a long delay needs a large task. Rows without an event time come first.
    """

    def __init__(self, order: Sequence[str], bucket_ms: int = BUCKET_MS):
        self.order, self.bucket_ms, self.input = list(order), bucket_ms, []

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._chunks = handle.getMapState("chunks", "bucket BIGINT, nr BIGINT", "rows BINARY")
        self._next = handle.getValueState("next", "nr BIGINT")

    def take(self, kept: pd.DataFrame | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The output for the next rows of a group's keys, which are in order, and what is kept after them."""
        raise NotImplementedError

    def late(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The output for rows that came too late."""
        raise NotImplementedError

    def _keep(self, chunks: list[tuple[int, pd.DataFrame]]) -> None:
        if not chunks:
            return
        nr = self._next.get()[0] if self._next.exists() else 0
        for i, (bucket, rows) in enumerate(chunks):
            self._chunks.updateValue((bucket, nr + i), (packed(rows),))
        self._next.update((nr + len(chunks),))
        self._handle.registerTimer(max(1, min(int(rows[AT].min()) for _, rows in chunks)))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            if frame.empty:  # given for a group of which only a timer has expired
                continue
            frame.columns = self.input  # names with a leading underscore do not come through
            frame[AT] = frame[AT].fillna(0).astype("int64")
            late = (frame[AT] <= passed) & (passed > 0)
            if late.any():
                yield self.late(frame[late])
            self._keep([(int(b), own) for b, own in frame[~late].groupby(frame[AT] // self.bucket_ms)])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        keys = sorted(self._chunks.keys())
        ready = [k for k in keys if k[0] * self.bucket_ms <= passed]
        kept, taken = self._kept() if ready else None, False
        for bucket, own in groupby(ready, lambda k: k[0]):
            own = list(own)
            rows = pd.concat([unpacked(bytes(self._chunks.getValue(k)[0])) for k in own], ignore_index=True)
            for k in own:
                self._chunks.removeKey(k)
            due = rows[AT] <= passed
            if due.any():
                told, kept = self.take(kept, rows[due].sort_values([AT, *self.order], ignore_index=True, na_position="first"))
                taken = True
                yield told
            if not due.all():
                self._keep([(bucket, rows[~due])])
        if taken:
            self._store(kept)
        if len(ready) < len(keys):
            self._handle.registerTimer(keys[len(ready)][0] * self.bucket_ms)


def in_order(rows: DataFrame, keys: Sequence[str], processor: OrderedProcessor, output: str, groups: int = GROUPS) -> DataFrame:
    """The output of ``processor`` for the rows of :func:`timed`."""
    rows = dealt(rows, keys, groups)
    processor.input = rows.columns
    return rows.groupBy(GROUP).transformWithStateInPandas(statefulProcessor=processor, outputStructType=output, outputMode="Append",
                                                          timeMode="EventTime")
