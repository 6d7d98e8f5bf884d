"""Batches that come after later ones: any order of days must give the history of all days in order."""

import random

import pytest
from pyspark.sql import functions as F

from dimflow.operators import scd, splice
from dimflow.operators.splice import sightings
from dimflow.plans.dimension_table import current_rows, newest_day
from dimflow.plans.pipeline import apply_scd
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, SourceSpec
from tests.conftest import rows

SCHEMA = "id INT, a STRING, b INT"
DAYS = [f"2024-02-0{i}" for i in range(1, 8)]
DATES = ("start_date", "end_date")


def batches(seed, keys=25):
    rand = random.Random(seed)
    return [[(i, rand.choice(["x", "y", None]), rand.choice([1, None])) for i in range(keys) if rand.random() < 0.6] for _ in DAYS]


def history(days):
    """(id, a, b, start, end, prev_a, prev_b) of days in order."""
    versions = {}
    for day, batch in sorted(days):
        for i, a, b in batch:
            known = versions.setdefault(i, [])
            if not known or known[-1][:2] != [a, b]:
                if known:
                    known[-1][3] = day
                known.append([a, b, day, None, *(known[-1][:2] if known else (None, None))])
    return sorted(str((i, *v)) for i, own in versions.items() for v in own)


def shown(dim):
    dates = [F.col(c).cast("string") for c in DATES]
    more = ["prev_a", "prev_b"] if "prev_a" in dim.columns else [F.lag(c).over(_by_start()) for c in ("a", "b")]
    return sorted(str(tuple(r)) for r in dim.select("id", "a", "b", *dates, *more).collect())


def _by_start():
    from pyspark.sql import Window

    return Window.partitionBy("id").orderBy("start_date")


def fixed(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("seed,type6,small", [(1, False, True), (2, False, False), (3, True, True), (4, True, False)])
def test_any_order_gives_the_same_history(spark, monkeypatch, seed, type6, small):
    if not small:
        monkeypatch.setattr(scd, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(splice, "BROADCAST_BYTES", -1)
    days = list(zip(DAYS, batches(seed)))
    random.Random(seed).shuffle(days)
    first, merge = (scd.scd6_initial, scd.scd6) if type6 else (scd.scd2_initial, scd.scd2_merge)
    dim = seen = None
    for n, (day, batch) in enumerate(days):
        stage = spark.createDataFrame(batch, SCHEMA)
        dim = fixed(spark, first(stage, ["a", "b"], day) if dim is None else merge(dim, stage, ["id"], ["a", "b"], day, seen=seen))
        own = sightings(stage, ["id"], scd.load_date(day))
        seen = fixed(spark, own if seen is None else seen.union(own))
        assert shown(dim) == history(days[:n + 1])
        assert dim.filter("is_current <> (end_date IS NULL)").isEmpty()
    if type6:
        newest = {r.id: (r.a, r.b) for r in dim.filter("is_current").collect()}
        assert all((r.current_a, r.current_b) == newest[r.id] for r in dim.collect())


def test_columns_of_the_new_versions_are_the_batch_s(spark):
    stage = lambda v, note: spark.createDataFrame([(1, v, note)], "id INT, a STRING, note STRING")
    dim = fixed(spark, scd.scd2_initial(stage("x", "first"), ["a"], "2024-02-05"))
    dim = fixed(spark, scd.scd2_merge(dim, stage("y", "second"), ["id"], ["a"], "2024-02-02"))
    assert rows(dim.select("a", "note", *[F.col(c).cast("string") for c in DATES])) == [
        ("x", "first", "2024-02-05", None), ("y", "second", "2024-02-02", "2024-02-05")]
    assert dim.select("hash").distinct().count() == 2


def test_without_sightings_a_version_lasts_until_the_next(spark):
    stage = lambda v: spark.createDataFrame([(1, v, 1)], SCHEMA)
    dim = scd.scd2_initial(stage("x"), ["a", "b"], "2024-02-01")
    for value, day in (("y", "2024-02-06"), ("z", "2024-02-03"), ("x", "2024-02-02"), ("y", "2024-02-05")):
        dim = fixed(spark, scd.scd2_merge(fixed(spark, dim), stage(value), ["id"], ["a", "b"], day))
    found = [(r.a, str(r.start_date), str(r.end_date)) for r in dim.orderBy("start_date").collect()]
    assert found == [("x", "2024-02-01", "2024-02-03"), ("z", "2024-02-03", "2024-02-05"), ("y", "2024-02-05", "None")]


def test_a_day_loaded_again_is_replaced_without_empty_versions(spark):
    stage = lambda *r: spark.createDataFrame(r, SCHEMA)
    dim = scd.scd2_initial(stage((1, "x", 1), (2, "x", 1)), ["a", "b"], "2024-02-01")
    dim = fixed(spark, scd.scd2_merge(dim, stage((1, "y", 1), (2, "x", 2)), ["id"], ["a", "b"], "2024-02-03"))
    dim = fixed(spark, scd.scd2_merge(dim, stage((1, "z", 1), (2, "x", 1)), ["id"], ["a", "b"], "2024-02-03"))
    assert rows(dim.select("id", "a", "b", *[F.col(c).cast("string") for c in DATES])) == [
        (1, "x", 1, "2024-02-01", "2024-02-03"), (1, "z", 1, "2024-02-03", None), (2, "x", 1, "2024-02-01", None)]
    again = scd.scd2_merge(dim, stage((1, "z", 1), (2, "x", 1)), ["id"], ["a", "b"], "2024-02-03")
    assert rows(again) == rows(dim)


@pytest.mark.parametrize("scd_type", [2, 6])
def test_tables_in_any_order(spark, scd_type):
    days = list(zip(DAYS, batches(4, 12)))[:5]
    random.Random(scd_type).shuffle(days)
    name = f"late_{scd_type}"
    spec = PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}", scd_type, tracked=("a", "b"),
                        late_batches=True)
    for n, (day, batch) in enumerate(days):
        for _ in range(2 if n == 3 else 1):  # a load repeated
            dim = apply_scd(overwrite_table(spark.createDataFrame(batch, SCHEMA).coalesce(1), spec.staging_table), spec, day)
        if n >= 3:
            assert shown(dim) == history(days[:n + 1])
    assert current_rows(spark, spec.target_table).count() == dim.select("id").distinct().count()
    assert newest_day(spark, spec.target_table) == DAYS[4]
    if scd_type == 6:
        newest = {r.id: (r.a, r.b) for r in dim.filter("is_current").collect()}
        assert all((r.current_a, r.current_b) == newest[r.id] for r in dim.collect())


def test_a_failed_late_load_shows_nothing(spark, monkeypatch):
    spec = PipelineSpec("late_fail", SourceSpec("csv", "unused"), "staging.late_fail", "target.late_fail", tracked=("a", "b"),
                        late_batches=True)
    stage = lambda *r: overwrite_table(spark.createDataFrame(r, SCHEMA), spec.staging_table)
    apply_scd(stage((1, "x", 1)), spec, "2024-02-01")
    before = rows(apply_scd(stage((1, "y", 1)), spec, "2024-02-05"))
    from dimflow.plans import dimension_table

    monkeypatch.setattr(dimension_table, "_select", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        apply_scd(stage((1, "z", 1)), spec, "2024-02-03")
    monkeypatch.undo()
    assert rows(spark.table(spec.target_table)) == before
    dim = apply_scd(stage((1, "q", 1)), spec, "2024-02-04")
    assert [(r.a, str(r.start_date)) for r in dim.orderBy("start_date").collect()] == [
        ("x", "2024-02-01"), ("q", "2024-02-04"), ("y", "2024-02-05")]


def test_history_is_read_once_and_not_shuffled_for_a_small_batch(spark):
    dim = overwrite_table(scd.scd2_initial(spark.createDataFrame(batches(1)[0], SCHEMA), ["a", "b"], DAYS[3]), "target.late_plan")
    staged = scd.with_hash(spark.createDataFrame(batches(2)[0], SCHEMA), ["a", "b"])
    near = splice._neighbours(dim, staged, ["id"], scd.load_date(DAYS[1]), True)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "partial_max_by" in plan
