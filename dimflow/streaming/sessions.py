"""Session state over a message stream, kept per sender and restored from the checkpoint after a restart."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession

from dimflow.operators.messages import PLAN, PLAN_WORD, choice, families, readable, with_children
from dimflow.sources.storage import checkpointed
from dimflow.streaming.ordered import (AT, BUCKET_MS, GROUP, GROUPS, KEY, GroupProcessor, OrderedProcessor, by_key, dealt,
                                       in_order, timed)

# the state handler travels to the workers by value, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "from_number STRING, seq BIGINT, turn STRING, child BIGINT, after_summary BOOLEAN, intent STRING"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _earlier(values: pd.Series, first: np.ndarray, at_start: pd.Series) -> pd.Series:
    """The last value before each row of its sender that is not missing, beginning with what was there before the first row."""
    return values.shift(1).where(~first, at_start).groupby(np.cumsum(first)).ffill()


def _turns(kept: pd.DataFrame | None, talk: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The turns of some senders' next messages, which are in order, and (chosen child, last mark) of all senders after them."""
    talk, first = by_key(talk)
    known = pd.DataFrame({KEY: [], "child": [], "mark": []}, dtype=object) if kept is None else kept
    before = known.set_index(KEY).reindex(talk[KEY]).reset_index(drop=True)
    child, mark = before["child"].astype("Int64"), before["mark"].astype(object).where(before["mark"].notna(), None)
    picks = talk["pick"].astype("Int64")
    valid = picks.where(picks > 0)
    selected = _earlier(valid, first, child)
    several = talk["children"] > 1
    turn = pd.Series(np.select(
        [talk["children"] == 0, valid.notna(), picks.eq(0).fillna(False), several & selected.isna()],
        ["unregistered", "select", "menu", "menu"], "ask"))
    asks = turn == "ask"
    marks = pd.Series(np.select([turn == "select", asks & (talk["intent"] == "summary")],
                                ["selection", "summary"], None), dtype=object)
    earlier = _earlier(marks, first, mark)
    after = earlier.eq("summary")
    plan = asks & after & talk["text"].str.contains(PLAN_WORD, regex=False).fillna(False).astype(bool)
    children = valid.where(turn == "select", selected.fillna(1).where(asks))
    turns = pd.DataFrame({"from_number": talk["from_number"], "seq": talk["seq"], "turn": turn, "child": children,
                          "after_summary": after,
                          "intent": talk["intent"].where(~plan, PLAN).where(asks, None)})
    newest = pd.DataFrame({KEY: talk[KEY], "child": valid.fillna(selected), "mark": marks.where(marks.notna(), earlier)})
    newest = newest[np.append(first[1:], True)]
    others = [] if kept is None else [kept[~kept[KEY].isin(newest[KEY])]]
    return turns, pd.concat([*others, newest], ignore_index=True)


class SessionProcessor(GroupProcessor):
    """Keeps (chosen child, last mark) per sender; the rows of a sender in a micro-batch are taken in seq order.

    One task holds what a group's senders bring in one micro-batch, so the source must bound micro-batches, as
    :func:`message_stream` does. Large backlogs belong to the batch operator, which cuts hot senders.
    """

    def __init__(self, input: list[str]):
        self.input = input

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        talk = pd.concat(list(rows))
        talk.columns = self.input  # names with a leading underscore do not come through
        turns, kept = _turns(self._kept(), talk.sort_values("seq", ignore_index=True))
        self._store(kept)
        yield turns


class OrderedSessionProcessor(OrderedProcessor):
    """As :class:`SessionProcessor`, with the messages of all micro-batches in order."""

    def take(self, kept: pd.DataFrame | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        turns, kept = _turns(kept, rows)
        return turns.assign(late=False), kept

    def late(self, rows: pd.DataFrame) -> pd.DataFrame:
        unknown = {"turn": None, "child": None, "after_summary": None, "intent": rows["intent"], "late": True}
        return rows[["from_number", "seq"]].assign(**unknown)


def message_stream(spark: SparkSession, path: str, schema: Any, max_bytes: int = 1 << 30, **options: Any) -> DataFrame:
    """Parquet message files as a stream of micro-batches of at most ``max_bytes`` (or one file, if that is larger)."""
    return spark.readStream.schema(schema).options(maxBytesPerTrigger=max_bytes, **options).parquet(path)


def session_state_stream(messages: DataFrame, contacts: DataFrame, groups: int = GROUPS) -> DataFrame:
    """The streaming form of ``operators.messages.session_state``; contacts are a static table, counted once.

    Messages are taken in the order of ``seq`` within a micro-batch and of arrival across micro-batches: one that comes
    after a later one of its sender in another micro-batch meets the state that one left. The senders share state by ``groups``.
    """
    rows = dealt(_prepared(readable(messages), contacts), ["from_number"], groups)
    return rows.groupBy(GROUP).transformWithStateInPandas(
        statefulProcessor=SessionProcessor(rows.columns), outputStructType=OUTPUT, outputMode="Append", timeMode="None")


def _prepared(rows: DataFrame, contacts: DataFrame, *more: str) -> DataFrame:
    joined = rows.join(checkpointed(families(contacts)), "_phone", "left")
    return with_children(joined, *more).withColumn("pick", choice())


def session_state_ordered(messages: DataFrame, contacts: DataFrame, event_time: Column, delay: str, clock: Column | None = None,
                          bucket_ms: int = BUCKET_MS, groups: int = GROUPS) -> DataFrame:
    """:func:`session_state_stream` over messages in any order: the columns of that, and ``late``.

    Messages are taken by event time and ``seq`` once the watermark, ``delay`` behind the newest message, has passed them; what
    is still within the delay when the stream ends is taken by the next run. A message that the watermark had passed before it
    came changes no state: it is given out with ``late`` true and without a turn. Rows for which ``clock`` holds are no
    messages and only move the watermark, e.g. to close a day.
    """
    rows = timed(messages, event_time, delay, clock)
    rows = _prepared(readable(rows, AT), contacts, AT)
    return in_order(rows, ["from_number"], OrderedSessionProcessor(["seq"], bucket_ms), f"{OUTPUT}, late BOOLEAN", groups)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own setting comes back afterwards."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def write_sessions(states: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there into Parquet files, each message once over all runs with the same checkpoint. Late messages, where
    the states have them, go to a folder of their own, ``late=true``."""
    with rocksdb_state(states.sparkSession):
        writer = states.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
        if "late" in states.columns:
            writer = writer.partitionBy("late")
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
