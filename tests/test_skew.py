"""The split paths, forced by tiny limits, against plain Python."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from dimflow.operators import cleaning, quality, scd, skew
from dimflow.operators.skew import OrderedGroups, hot_keys, join_lines, join_skewed
from tests.conftest import rows

SEEDS = (1, 2)


def hot_log(seed, n=400):
    """(key, at, id, value): key 0 and NULL hold most rows, values repeat and may be NULL."""
    rand = random.Random(seed)
    return [(rand.choice([*[0] * 8, *[None] * 5, *range(1, 12)]), rand.randrange(60), i, rand.choice(["a", "b", None]))
            for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "k INT, at INT, id INT, v STRING").repartition(5, "id")


def by_key(data):
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    return [list(g) for _, g in groupby(order, key=lambda r: r[0])]


def test_hot_keys(spark):
    df = frame(spark, hot_log(1))
    counted = {r[0]: r[1] for r in df.groupBy("k").count().collect()}
    hot = {r[0]: r[1] for r in hot_keys(df, ["k"], 60).collect()}
    assert hot == {k: n for k, n in counted.items() if n > 60} and 0 in hot and None in hot
    assert hot_keys(df, ["k"], 400) is None


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("limit", [7, 30, 1000])
def test_ordered_groups(spark, seed, limit):
    data = hot_log(seed)
    groups = OrderedGroups.of(frame(spark, data), ["k"], ["at", "id"], limit)
    assert groups.pieced == (limit < 1000)
    if groups.pieced:
        # the heaviest key must really be cut
        assert groups.df.filter("k = 0").select("_piece").distinct().count() > 3
    groups = (groups.lag("lag", F.struct("id")).lead("lead", F.struct("id")).last_before("last", F.col("v"))
              .row_number("nr"))
    found = groups.result().select("k", "id", F.col("lag.id").alias("a"), F.col("lead.id").alias("b"), "last", "nr")
    expected = []
    for group in by_key(data):
        seen = None
        for i, (k, _, ident, v) in enumerate(group):
            expected.append((k, ident, group[i - 1][2] if i else None,
                             group[i + 1][2] if i + 1 < len(group) else None, seen, i + 1))
            seen = v if v is not None else seen
    assert sorted(map(str, rows(found))) == sorted(map(str, expected))


@pytest.mark.parametrize("seed", SEEDS)
def test_history_from_log(spark, seed):
    data, expected = hot_log(seed), []
    for group in by_key(data):
        kept = [r for i, r in enumerate(group) if i == 0 or r[3] != group[i - 1][3]]
        expected += [(r[0], r[3], r[1], kept[i + 1][1] if i + 1 < len(kept) else None, i + 1 == len(kept))
                     for i, r in enumerate(kept)]
    for limit in (7, 1000):
        found = scd.scd2_from_log(frame(spark, data), ["k"], ["v"], ["at", "id"], limit)
        assert sorted(map(str, rows(found))) == sorted(map(str, expected))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_skewed(spark, how, monkeypatch):
    df = frame(spark, hot_log(3))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 20, 2)], "k INT, name STRING")
    expected = rows(df.join(dim, ["k"], how))
    assert rows(join_skewed(df, dim, ["k"], how)) == expected
    assert rows(join_skewed(df, dim, ["k"], how, 20, broadcast_bytes=0)) == expected  # salted copies
    assert rows(join_skewed(df, dim, ["k"], how, 1000, broadcast_bytes=0)) == expected
    sizes = iter([10**9])
    monkeypatch.setattr(skew, "byte_size", lambda df: next(sizes, 10))  # large dimension, few hot rows of it
    assert rows(join_skewed(df, dim, ["k"], how, 20)) == expected


def test_copies_are_spread(spark):
    df = spark.createDataFrame([(1, "same")] * 200, "k INT, v STRING").repartition(3)
    groups = OrderedGroups.of(df, ["k"], ["v"], 20, unique=False).row_number("nr")
    assert max(r[1] for r in groups.df.groupBy("_piece").count().collect()) < 60
    assert rows(groups.result().select("nr")) == sorted([(i,) for i in range(1, 201)], key=str)
    assert groups.result().columns == ["k", "v", "nr"]


def test_join_lines_in_parts(spark):
    # one key with many copies of few lines
    data = [(1, "x") for _ in range(50)] + [(1, f"y{i:02}") for i in range(30)] + [(2, "z"), (3, None)]
    df = spark.createDataFrame(data, "k INT, line STRING")
    whole = {r[0]: r[2] for r in join_lines(df, ["k"], ["line"], "line", "text").collect()}
    assert whole[1] == "\n".join(sorted(x for k, x in data if k == 1)) and whole[2] == "z"
    alone = join_lines(df, ["k"], ["line"], "line", "text", lines_per_part=16, limit=10, unique=True).collect()
    assert "\n".join(r.text for r in sorted(alone, key=lambda r: r.part) if r.k == 1) == whole[1]
    parts = join_lines(df, ["k"], ["line"], "line", "text", lines_per_part=16, limit=10).collect()
    first = sorted((r.part, r.text, r.lines) for r in parts if r.k == 1)
    assert [p for p, _, _ in first] == [1, 2, 3, 4, 5] and max(n for _, _, n in first) == 16
    assert "\n".join(t for _, t, _ in first) == whole[1]


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark, capsys):
    df = frame(spark, hot_log(4))
    latest = cleaning.dedup_latest(df, ["k"], ["at", "id"])
    assert sorted(map(str, rows(latest))) == sorted(str(g[-1]) for g in by_key(hot_log(4)))
    latest.explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("limit,size", [(skew.HOT_ROWS, skew.BROADCAST_BYTES), (20, 0)])
def test_set_rules_under_skew(spark, limit, size):
    df = frame(spark, hot_log(5))
    parent = spark.createDataFrame([(i,) for i in (0, 1, 1, 2, 3)], "p INT")
    rules = [quality.unique("k"), quality.foreign_key("k", parent, "p"), quality.unique("id")]
    found = {r.id: r.violations for r in quality.validate(df, rules, limit, size).collect()}
    data = hot_log(5)
    counts = {k: sum(r[0] == k for r in data) for k in {r[0] for r in data}}
    for k, _, ident, _ in data:
        expected = [] if k is None else (["k_unique"] if counts[k] > 1 else []) + (
            ["k_foreign_key"] if k not in (0, 1, 2, 3) else [])
        assert found[ident] == expected
    report = rows(quality.quality_report(df, rules, limit, size))
    assert report == sorted((n, 400, sum(n in v for v in found.values()))
                            for n in ("k_unique", "k_foreign_key", "id_unique"))
    valid, rejects = quality.split_valid(df, rules, limit, size)
    assert valid.count() + rejects.count() == 400 and rejects.filter("size(violations) = 0").count() == 0
