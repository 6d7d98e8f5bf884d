"""Merges with a broadcast batch and with two shuffled sides, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from dimflow.operators import scd
from tests.conftest import rows

SCHEMA = "id INT, a STRING, b INT"
DAYS = [f"2024-02-0{i}" for i in range(1, 6)]


def batches(seed):
    rand = random.Random(seed)
    return [[(i, rand.choice(["x", "y", None]), rand.choice([1, 2, None])) for i in range(30) if rand.random() < 0.6]
            for _ in DAYS]


def expected_history(days):
    versions = {}
    for day, batch in zip(DAYS, days):
        for i, a, b in batch:
            known = versions.setdefault(i, [])
            if known and known[-1][:2] == [a, b]:
                continue
            if known:
                known[-1][3] = day
            known.append([a, b, day, None])
    return sorted((str((i, a, b, s, e, e is None)) for i, v in versions.items() for a, b, s, e in v))


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(scd, "BROADCAST_BYTES", -1)
    return request.param


@pytest.mark.parametrize("seed", [1, 2])
def test_type2(spark, strategy, seed):
    days = batches(seed)
    dim = scd.scd2_initial(spark.createDataFrame(days[0], SCHEMA), ["a", "b"], DAYS[0])
    for day, batch in zip(DAYS[1:], days[1:]):
        stage = spark.createDataFrame(batch, SCHEMA)
        dim = spark.createDataFrame(scd.scd2_merge(dim, stage, ["id"], ["a", "b"], day).collect(), dim.schema)
    shown = dim.select("id", "a", "b", F.col("start_date").cast("string"), F.col("end_date").cast("string"), "is_current")
    assert sorted(str(r) for r in rows(shown)) == expected_history(days)
    # one current row per key, no overlap, and the last batch again changes nothing
    assert dim.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0
    again = scd.scd2_merge(dim, stage, ["id"], ["a", "b"], "2024-03-01")
    assert rows(again) == rows(dim)
    # any day's state is the newest value each key had by then
    for n, day in enumerate(DAYS):
        known = {}
        for batch in days[:n + 1]:
            known.update({i: (i, a, b) for i, a, b in batch})
        assert sorted(map(str, rows(scd.as_of(dim, day).select("id", "a", "b")))) == sorted(map(str, known.values()))


def test_changes_and_other_types(spark, strategy):
    old, new = batches(5)[:2]
    dim, stage = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    was, now = {r[0]: r for r in old}, {r[0]: r for r in new}
    kinds = {i: "new" if i not in was else "absent" if i not in now else "unchanged" if was[i] == now[i] else "changed"
             for i in was.keys() | now.keys()}
    assert dict(rows(scd.classify_changes(dim, stage, ["id"], ["a", "b"]))) == kinds
    assert sorted(map(str, rows(scd.scd0(dim, stage, ["id"])))) == sorted(map(str, {**now, **was}.values()))
    first = scd.scd1_reload(dim, ["a", "b"])
    upserted = scd.scd1_upsert(first, stage, ["id"], ["a", "b"]).drop("hash")
    assert sorted(map(str, rows(upserted))) == sorted(map(str, {**was, **now}.values()))
    current, replaced = scd.scd4(first, stage, ["id"], ["a", "b"], "2024-02-02")
    assert sorted(map(str, rows(current.drop("hash")))) == sorted(map(str, {**was, **now}.values()))
    assert sorted(map(str, rows(replaced.drop("hash", "valid_to")))) == sorted(
        str(was[i]) for i, k in kinds.items() if k == "changed")
    third = scd.scd3(scd.scd3_initial(dim, ["a", "b"]), stage, ["id"], ["a", "b"])
    for i, a, b, prev_a, prev_b in rows(third):
        assert (i, a, b) == now.get(i, was.get(i))
        changed_a, changed_b = (i in was and i in now and was[i][n] != now[i][n] for n in (1, 2))
        assert prev_a == (was[i][1] if changed_a else None) and prev_b == (was[i][2] if changed_b else None)


def test_type6_under_skew(spark, strategy):
    days = batches(7)
    dim = plain = scd.scd6_initial(spark.createDataFrame(days[0], SCHEMA), ["a", "b"], DAYS[0])
    for day, batch in zip(DAYS[1:], days[1:]):
        stage = spark.createDataFrame(batch, SCHEMA)
        plain = spark.createDataFrame(scd.scd6(plain, stage, ["id"], ["a", "b"], day).collect(), plain.schema)
        dim = spark.createDataFrame(scd.scd6(dim, stage, ["id"], ["a", "b"], day, 1, 0).collect(), dim.schema)
    assert rows(dim) == rows(plain)
    newest = {r.id: (r.a, r.b) for r in dim.filter("is_current").collect()}
    last = {}
    for r in sorted(dim.collect(), key=lambda r: (r.id, r.start_date)):
        assert (r.current_a, r.current_b) == newest[r.id]
        assert (r.prev_a, r.prev_b) == last.get(r.id, (None, None))
        last[r.id] = (r.a, r.b)


def test_null_in_other_column_is_a_change_though_hashes_agree(spark):
    dim = scd.scd2_initial(spark.createDataFrame([(1, None, "A")], "id INT, a STRING, b STRING"), ["a", "b"], "2024-01-01")
    stage = spark.createDataFrame([(1, "A", None)], "id INT, a STRING, b STRING")
    merged = scd.scd2_merge(dim, stage, ["id"], ["a", "b"], "2024-01-02")
    assert merged.count() == 2 and merged.select("hash").distinct().count() == 1
