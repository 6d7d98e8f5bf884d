"""Newest rows over loads, against one deduplication of all of them."""

import random
import threading

import pytest

from dimflow.operators.cleaning import dedup_latest
from dimflow.plans import commits, key_index
from dimflow.plans.dimension_table import loads_table, settle
from dimflow.plans.key_index import merge_latest, rows_near, unseen
from tests.conftest import rows

SCHEMA = "id BIGINT, part STRING, at INT, value STRING"
KEYS, ORDER = ["id", "part"], ["at", "value"]


def batches(seed, n=4):
    rand = random.Random(seed)
    return [[(rand.choice([*range(40), None]), rand.choice(["a", "b", None]), rand.randrange(9), f"{day} {i}") for i in range(60)]
            for day in range(n)]


@pytest.mark.parametrize("ranges", [1, 16])
def test_the_index_is_the_deduplicated_union(spark, ranges):
    table, seen = f"target.index_{ranges}", []
    for n, day in enumerate([*batches(1), [], batches(1)[0]]):
        batch = spark.createDataFrame(day, SCHEMA).coalesce(1)
        known = {r[:2] for r in seen}
        new = unseen(batch, table, KEYS)
        assert rows(new) == rows(spark.createDataFrame([r for r in day if r[:2] not in known], SCHEMA))
        seen += day
        found = merge_latest(batch, table, KEYS, ORDER, ranges)
        assert found.columns == ["id", "part", "at", "value"]
        assert rows(found) == rows(dedup_latest(spark.createDataFrame(seen, SCHEMA), KEYS, ORDER))


def test_only_touched_ranges_are_read_and_written(spark):
    table = "target.index_ranges"
    merge_latest(spark.range(2000).selectExpr("id", "'a' AS part", "1 AS at", "'x' AS value"), table, KEYS, ORDER, 64)
    before = settle(spark, table)
    found = merge_latest(spark.createDataFrame([(5, "a", 2, "y")], SCHEMA), table, KEYS, ORDER, 8)  # the first load's count holds
    held = key_index._held(settle(spark, table))
    assert len(held) == 64 and sorted(held.values()) == [1] * 63 + [2]
    (touched,) = [r for r, load in held.items() if load == 2]
    near = rows_near(spark, table, before, [touched])
    assert {f.split("_range=")[1].split("/")[0] for f in near.inputFiles()} == {str(touched)}
    assert found.count() == 2000 and rows(found.filter("at = 2")) == [(5, "a", 2, "y")]


def test_replaced_ranges_are_cleared_a_load_later(spark):
    table = "target.index_cleared"
    for at in range(4):
        found = merge_latest(spark.createDataFrame([(1, "a", at, "v")], SCHEMA), table, KEYS, ORDER, 4)
    parts = {r[0].split("/")[0] for r in spark.sql(f"SHOW PARTITIONS {loads_table(table)}").collect()}
    assert parts == {"load=3", "load=4"} and rows(found) == [(1, "a", 3, "v")]


def test_two_writers(spark, monkeypatch):
    table, barrier, real, errors = "target.index_two", threading.Barrier(2), commits.claim, []
    merge_latest(spark.createDataFrame([(0, "a", 0, "old")], SCHEMA), table, KEYS, ORDER, 4)
    once = threading.local()

    def claim(*args):
        number = real(*args)
        if not getattr(once, "done", False):
            once.done = True
            barrier.wait(60)
        return number

    monkeypatch.setattr(commits, "claim", claim)

    def run(i):
        try:
            merge_latest(spark.createDataFrame([(0, "a", i, "new"), (i, "b", 1, "own")], SCHEMA).coalesce(1), table, KEYS, ORDER, 4)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=run, args=(i,)) for i in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert rows(spark.table(table)) == [(0, "a", 2, "new"), (1, "b", 1, "own"), (2, "b", 1, "own")]
