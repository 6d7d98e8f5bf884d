import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import mixing
from dimflow.llm.sketch import sketch
from tests.llm.data import empty, frame


def corpus(n=900):
    rows = []
    for i in range(n):
        kind = "ab"[i % 3 == 0]
        size = 20 + i % 40
        rows.append((i, " ".join(f"{kind}{(i * 13 + k * 7) // 2 % 50}" if k % 2 else f"own{i}x{k}" for k in range(size)), kind))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id LONG, text STRING, domain STRING").repartition(4)


def test_posteriors_tell_held_out_rows_apart(docs):
    model = mixing.learn(docs.filter("doc_id % 2 = 0"), ("a", "b"))
    mix = mixing.fit(docs, model, (1, 1))
    rows = mixing.rated(docs.filter("doc_id % 2 = 1"), mix).collect()
    assert np.mean([(r.posteriors[0] > 0.5) == (r.domain == "a") for r in rows]) > 0.97
    assert all(abs(sum(r.posteriors) - 1) < 1e-9 and r.tokens == len(r.text.split()) for r in rows)


@pytest.mark.parametrize("weights,keep", [((1, 1), None), ((9, 1), "a"), ((1, 9), None), ((1, 0), None)])
def test_expected_totals_meet_targets(docs, weights, keep):
    mix = mixing.fit(docs, mixing.learn(docs, ("a", "b")), weights, keep)
    rows = mixing.rated(docs, mix).collect()
    totals = sum(r.rate * r.tokens * np.array(r.posteriors) for r in rows)
    assert all(r.rate >= 0 for r in rows)
    assert np.allclose(totals, mix.expected) and np.abs(totals - mix.targets).sum() < 0.02 * mix.targets.sum()
    if keep:
        assert abs(mix.targets[0] - mix.before[0]) < 1e-6 * mix.before[0]
    assert abs(sum(r.copies for r in rows) - sum(r.rate for r in rows)) < 0.1 * len(rows) + 20


def test_mixed_rows(docs):
    mix = mixing.fit(docs, mixing.learn(docs, ("a", "b")), (1, 3))
    copies = {r.doc_id: r.copies for r in mixing.rated(docs, mix).collect()}
    found = mixing.mixed(docs, mix)
    assert found.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in copies.items() if v}


def test_awkward_rows_and_empty_tables(spark, docs):
    model = mixing.learn(docs.filter("false"), ("a", "b"))
    mix = mixing.fit(frame(spark), model, (1, 1))
    rows = mixing.rated(frame(spark), mix)
    assert rows.count() == frame(spark).count() and rows.columns[-4:] == ["tokens", "posteriors", "rate", "copies"]
    assert mixing.mixed(empty(spark), mixing.fit(empty(spark), model, (1, 1))).count() == 0


@pytest.mark.parametrize("weights", [(8, 92), (2.16, 1), (1.86, 1)])
def test_tokens_of_the_copies_meet_targets_at_any_rate(spark, weights):
    """Rates of about 0.04, 1.08 and 0.93 for the domain that is not kept."""
    docs = spark.createDataFrame(corpus(6000), "doc_id LONG, text STRING, domain STRING").repartition(4)
    mix = mixing.fit(docs, mixing.learn(docs, ("a", "b")), weights, "b")
    rows = mixing.rated(docs, mix).collect()
    found, spread = np.zeros(2), np.zeros(2)
    for r in rows:
        tokens = r.tokens * np.array(r.posteriors)
        found += r.copies * tokens
        spread += (r.rate % 1) * (1 - r.rate % 1) * tokens ** 2
    assert (np.abs(found - mix.targets) < 4 * np.sqrt(spread) + 1e-3 * mix.targets).all()


def features_of(text):
    """Distinct words, word ends of three bytes, and whether words repeat the word before, as plain strings."""
    own = (text or "").lower().split()
    repeats = sum(a == b for a, b in zip(own, own[1:])) >= mixing.REPEATS
    return {("word", w) for w in own} | {("end", w.encode()[-3:]) for w in own} | ({"repeats"} if repeats else set())


def test_posteriors_and_rates_by_brute_force(spark):
    """The classifier and the rates worked out in plain Python, without hashed features; NULL, very long and repeated texts,
    clashing columns included."""
    rand, rows = random.Random(6), []
    for i in range(300):
        kind = "ab"[i % 4 == 0]
        words = [(f"{kind}{rand.randrange(30)}st" if rand.random() < 0.6 else f"c{rand.randrange(40)}") for _ in range(rand.randrange(8, 40))]
        if kind == "b" and i % 3 == 0:
            words += ["again"] * 5
        rows.append((i, " ".join(words), kind))
    rows += [(1000, " ".join(f"a{rand.randrange(30)}st" for _ in range(50_000)), "a"), (1001, None, "a"), (1002, "", "b"),
             (1003, "c1 c2", None), (1004, "c1 c2", "else")]
    rows += rows[:30] * 2
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, domain STRING").withColumn("n", F.lit(1)).repartition(3)
    domains = ("a", "b")
    model = mixing.learn(docs, domains)

    taken = {}
    for r in docs.filter("domain IN ('a', 'b')").select("text", "domain", sketch("text").alias("s"), F.xxhash64("text").alias("o")).collect():
        taken[r.domain, r.s] = min(taken.get((r.domain, r.s), (r.o, r.text)), (r.o, r.text), key=lambda x: x[0])
    counts, n = {d: Counter() for d in domains}, Counter(d for d, _ in taken)
    for (d, _), (_, text) in taken.items():
        counts[d].update(features_of(text))
    priors = {d: (n[d] + 1) / (sum(n.values()) + 2) for d in domains}
    weights = {}
    for f in counts["a"] | counts["b"]:
        total = sum(counts[d][f] for d in domains)
        expected = {d: total * n[d] / sum(n.values()) for d in domains}
        if max(abs(counts[d][f] - expected[d]) / math.sqrt(expected[d] + 1) for d in domains) >= mixing.MIN_DEVIATIONS:
            logs = {d: math.log((counts[d][f] + 0.5) / (n[d] + 1)) for d in domains}
            weights[f] = {d: logs[d] - sum(logs.values()) / 2 for d in domains}
    assert "repeats" in weights and len(weights) > 20

    def posterior(text, sharpness):
        own = features_of(text)
        z = [math.log(priors[d]) + sharpness * sum(weights[f][d] for f in own if f in weights) for d in domains]
        p = [math.exp(v - max(z)) for v in z]
        return [v / sum(p) for v in p]

    loss = {s: -sum(math.log(posterior(text, s)[domains.index(d)] + 1e-12) for (d, _), (_, text) in taken.items())
            for s in (2.0 ** (k / 2) for k in range(-10, 9))}
    assert loss[model.sharpness] <= min(loss.values()) + 1e-6
    mix = mixing.fit(docs, model, (3, 2))
    totals, before = [0.0, 0.0], [0.0, 0.0]
    for r in mixing.rated(docs, mix).collect():
        p, rate = posterior(r.text, model.sharpness), 1.0
        assert max(abs(x - y) for x, y in zip(p, r.posteriors)) < 1e-9
        for step in mix.steps:
            rate = max(0.0, rate - sum(x * float(s) for x, s in zip(p, step)))
        assert abs(rate - r.rate) < 1e-9 and r.tokens == len((r.text or "").split())
        assert r.copies in (math.floor(rate), math.floor(rate) + 1)
        totals = [t + rate * r.tokens * x for t, x in zip(totals, p)]
        before = [t + r.tokens * x for t, x in zip(before, p)]
    # nonnegative rates reach these targets, so the least squares are zero
    assert np.allclose(before, mix.before) and np.allclose(mix.targets, [0.6 * sum(before), 0.4 * sum(before)])
    assert np.abs(np.array(totals) - mix.targets).sum() <= 2 * mixing.TOLERANCE * sum(before)
