"""Differences of tables against plain Python, and what is read for them."""

import random
from collections import Counter

import pytest

from dimflow.sources import compare
from dimflow.sources.compare import differences, differing_ranges, hash_tree, overwrite_ranged, tree_of
from tests.conftest import rows

SCHEMA = "a INT, b STRING, c DOUBLE"


def table(seed, n=400):
    rand = random.Random(seed)
    return [(rand.choice([*range(60), None]), rand.choice(["x", "y", None]), rand.choice([0.5, None])) for _ in range(n)]


def altered(data, seed, times):
    rand, out = random.Random(seed), list(data)
    for _ in range(times):
        i = rand.randrange(len(out))
        match rand.randrange(4):
            case 0:
                out.pop(i)
            case 1:
                out.append(out[i])
            case 2:
                out[i] = (out[i][0], out[i][1], 7.0)
            case 3:
                out.append((1000 + i, None, None))
    return out


def expected(left, right, keys):
    def grouped(data):
        found = {}
        for r in data:
            found.setdefault(r[:keys], Counter())[r] += 1
        return found

    a, b = grouped(left), grouped(right)
    return sorted(str((*k, "missing" if k not in b else "extra" if k not in a else "changed")) for k in a.keys() | b.keys() if a.get(k) != b.get(k))


@pytest.mark.parametrize("keys,bits,step,times", [(1, 16, 4, 5), (2, 6, 4, 40), (1, 3, 1, 1), (2, 10, 3, 0)])
def test_differences_as_by_brute_force(spark, keys, bits, step, times):
    left = table(times)
    right = altered(left, times, times)
    frame = lambda data: spark.createDataFrame(data, SCHEMA).repartition(3)
    other = frame(right).select("c", "a", "b")  # columns count by name
    found = differences(frame(left), other, ["a", "b"][:keys], bits=bits, step=step)
    assert sorted(str(tuple(r)) for r in found.collect()) == expected(left, right, keys)


def test_trees_add_up_and_empty_tables(spark):
    df, none = spark.createDataFrame(table(3), SCHEMA), spark.createDataFrame([], SCHEMA)
    tree = hash_tree(df, ["a"], 8, 3)
    assert {r.bits: r.n for r in tree.groupBy("bits").agg({"rows": "sum"}).withColumnRenamed("sum(rows)", "n").collect()} == {
        b: 400 for b in (8, 5, 2, 0)}
    assert differences(none, none, ["a"]).count() == 0
    assert {r.difference for r in differences(df, none, ["a"]).collect()} == {"missing"}
    assert {r.difference for r in differences(none, df, ["a"]).collect()} == {"extra"}


def test_only_differing_ranges_are_read(spark):
    left = [(i, "x", 0.5) for i in range(5000)]
    right = [(i, "y" if i == 77 else "x", 0.5) for i in range(5000)]
    one = overwrite_ranged(spark.createDataFrame(left, SCHEMA), "staging.ranged_one", ["a"], 10)
    two = overwrite_ranged(spark.createDataFrame(right, SCHEMA), "staging.ranged_two", ["a"], 10)
    trees = tree_of(spark, "staging.ranged_one"), tree_of(spark, "staging.ranged_two")
    ranges = differing_ranges(*trees, 10)
    assert ranges.count() == 1
    near = compare._within(one, ["a"], ranges, 10)
    assert len({f.split("_range=")[1].split("/")[0] for f in near.inputFiles()}) == 1  # of 64
    assert near.count() < 50
    found = differences(one, two, ["a"], trees, 10)
    assert rows(found) == [(77, "changed")]
