"""Several loads of one dimension at once, and writers lost in the middle of a load."""

import threading

import pytest

from dimflow.plans import commits, dimension_table
from dimflow.plans.commits import ConcurrentLoad
from dimflow.plans.dimension_table import load_number
from dimflow.plans.pipeline import apply_scd, history_table
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, SourceSpec
from tests.conftest import rows

SCHEMA = "id INT, name STRING, department STRING, salary INT"


def spec_of(name, scd_type=2, **options):
    return PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}", scd_type, **options)


def batch(spark, name, *ids):
    data = [(i, name, "IT", 1) for i in ids]
    return overwrite_table(spark.createDataFrame(data, SCHEMA).coalesce(1), f"staging.w_{name.lower()}_{ids[0]}")


def at_once(monkeypatch, works):
    """Run works that all claim a number before any commits; what each raised."""
    barrier, first, real = threading.Barrier(len(works)), threading.local(), commits.claim

    def claim(*args):
        number = real(*args)
        if not getattr(first, "done", False):
            first.done = True
            barrier.wait(60)
        return number

    monkeypatch.setattr(commits, "claim", claim)
    errors = [None] * len(works)

    def run(i):
        try:
            works[i]()
        except Exception as error:  # noqa: BLE001
            errors[i] = error

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(works))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    monkeypatch.setattr(commits, "claim", real)
    return errors


@pytest.mark.parametrize("scd_type", [2, 4])
def test_both_loads_come_in_when_the_second_tries_again(spark, monkeypatch, scd_type):
    spec = spec_of(f"both{scd_type}", scd_type)
    apply_scd(batch(spark, "Old", 1, 2, 3), spec, "2024-01-01")
    new, other = batch(spark, "New", 1, 4), batch(spark, "Other", 2, 5)
    errors = at_once(monkeypatch, [lambda: apply_scd(new, spec, "2024-01-02"), lambda: apply_scd(other, spec, "2024-01-02")])
    assert errors == [None, None]
    dim = spark.table(spec.target_table)
    now = dim.filter("is_current") if scd_type == 2 else dim
    assert rows(now.select("id", "name")) == [(1, "New"), (2, "Other"), (3, "Old"), (4, "New"), (5, "Other")]
    old = dim.filter("NOT is_current") if scd_type == 2 else spark.table(history_table(spec))
    assert rows(old.select("id", "name")) == [(1, "Old"), (2, "Old")]


def test_one_of_two_loads_fails_cleanly(spark, monkeypatch):
    spec = spec_of("one")
    before = rows(apply_scd(batch(spark, "Old", 1, 2, 3), spec, "2024-01-01"))
    new, other = batch(spark, "New", 1, 4), batch(spark, "Other", 2, 5)
    errors = at_once(monkeypatch, [lambda: apply_scd(new, spec, "2024-01-02", 1), lambda: apply_scd(other, spec, "2024-01-02", 1)])
    assert sorted(type(e).__name__ for e in errors) == ["ConcurrentLoad", "NoneType"]
    lost = new if errors[0] else other
    won = {"New", "Old"} if errors[1] else {"Other", "Old"}
    dim = spark.table(spec.target_table)
    assert {r.name for r in dim.collect()} == won and dim.count() == len(before) + 2
    apply_scd(lost, spec, "2024-01-03")
    assert spark.table(spec.target_table).filter("is_current").count() == 5


def test_two_first_loads(spark, monkeypatch):
    spec = spec_of("firsts")
    new, other = batch(spark, "New", 1), batch(spark, "Other", 2)
    assert at_once(monkeypatch, [lambda: apply_scd(new, spec, "2024-01-01"), lambda: apply_scd(other, spec, "2024-01-01")]) == [None, None]
    assert rows(spark.table(spec.target_table).select("id", "name", "is_current")) == [(1, "New", True), (2, "Other", True)]


def test_a_load_committed_but_not_shown_is_shown_by_the_next(spark, monkeypatch):
    spec = spec_of("unshown", 4)
    apply_scd(batch(spark, "Old", 1, 2), spec, "2024-01-01")
    real = dimension_table.show
    monkeypatch.setattr(dimension_table, "show", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        apply_scd(batch(spark, "New", 1), spec, "2024-01-02")
    monkeypatch.setattr(dimension_table, "show", real)
    assert load_number(spark, spec.target_table) == 1
    apply_scd(batch(spark, "Newer", 2), spec, "2024-01-03")
    assert rows(spark.table(spec.target_table).select("id", "name")) == [(1, "New"), (2, "Newer")]
    assert rows(spark.table(history_table(spec)).select("id", "name")) == [(1, "Old"), (2, "Old")]


@pytest.mark.parametrize("scd_type", [2, 4])
def test_a_writer_lost_before_its_commit_leaves_no_rows(spark, monkeypatch, scd_type):
    spec = spec_of(f"lost_writer{scd_type}", scd_type)
    apply_scd(batch(spark, "Old", 1, 2), spec, "2024-01-01")
    monkeypatch.setattr(commits, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        apply_scd(batch(spark, "Gone", 1), spec, "2024-01-02")
    monkeypatch.undo()
    for day, name in (("2024-01-03", "New"), ("2024-01-04", "Newer")):
        apply_scd(batch(spark, name, 1), spec, day)
    dim = spark.table(spec.target_table)
    old = dim.filter("NOT is_current") if scd_type == 2 else spark.table(history_table(spec))
    assert rows(old.select("name")) == [("New",), ("Old",)]


def test_a_load_made_from_an_old_state_is_refused(spark):
    table = "target.stale"
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id INT")
    base = {}
    for i in range(3):
        dimension_table.publish(frame(i), table)
        base = base or dimension_table.settle(spark, table)
    with pytest.raises(ConcurrentLoad):
        dimension_table.publish(frame(9), table, base=base)
    assert rows(spark.table(table)) == [(2,)]
