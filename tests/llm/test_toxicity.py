import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import toxicity
from dimflow.llm.sketch import sketch
from dimflow.llm.toxicity import Lexicon, fold
from tests.llm.data import empty, frame


def test_folding():
    assert fold("1D10T!") == " idiot " and fold("іdіоt, ＳＣＵＭ\n$cum") == " idiot scum scum " and fold(" \t") == " "


def test_hits_and_exceptions():
    lexicon = Lexicon({"trash": 2.0, "clown": 1.0}, ("trash can", "the clown fish"))
    assert lexicon.hits(fold("Trash, trash! TR4SH clowns clown.")) == ["trash", "trash", "trash", "clown"]
    assert lexicon.hits(fold("a trash can and the clown fish, trash")) == ["trash"]
    assert Lexicon({}).hits(fold("trash")) == []
    long, short = lexicon.features("trash " + "word " * 400)[0], lexicon.features("trash word")[0]
    assert short > 5 * long and lexicon.features(None) == (0.0, 0.0)


def labelled(n=60):
    rows = []
    for i in range(n):
        filler = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(25))
        rows.append((f"{filler} you zorg and blat{i % 2}", 1) if i % 4 == 0 else (f"{filler} zorg park" if i % 8 == 1 else filler, 0))
    return rows + [(None, 0), ("", 0), ("zorg", None), ("zorg", 7)]


def test_learned_lexicon_scores_held_out_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_DEVIATIONS", 2.0)
    monkeypatch.setattr(toxicity, "MIN_WEIGHT", 1.0)
    rows = spark.createDataFrame(labelled() * 2, "text STRING, toxic INT").repartition(3)
    lexicon = toxicity.learn(rows)
    assert "zorg" in lexicon.weights and "blat0" in lexicon.weights or "blato" in lexicon.weights
    assert "zorg park" in lexicon.exceptions
    asked = spark.createDataFrame([(1, "w1 w2 you z0rg and blat1 w3", "x"), (2, "w1 w2 zorg park", "x"), (3, None, "x"), (4, "w1", "x")],
                                  "doc_id LONG, text STRING, score STRING")
    found = {r.doc_id: r for r in toxicity.scored(asked, lexicon).collect()}
    assert found[1].predicted == 1 and [found[i].predicted for i in (2, 3, 4)] == [0, 0, 0]
    assert found[2].score == found[3].score == found[4].score and all(0 <= r.score <= 1 for r in found.values())


def test_without_labels_and_empty_tables(spark):
    none = toxicity.learn(spark.createDataFrame([("a", 0)], "text STRING, toxic INT"))
    assert none.weights == {} and toxicity.scored(empty(spark), none).count() == 0
    assert toxicity.learn(spark.createDataFrame([], "text STRING, toxic INT")).weights == {}
    assert {r.predicted for r in toxicity.scored(frame(spark), none).collect()} == {0}


def test_no_term_is_left_out(spark, monkeypatch):
    """Six thousand toxic words, each in three rows, are all taken; too many for a worker are an error."""
    monkeypatch.setattr(toxicity, "MIN_DEVIATIONS", 1.0)
    monkeypatch.setattr(toxicity, "MIN_WEIGHT", 0.5)
    name = lambda i: "zz" + "".join(chr(97 + int(d)) for d in f"{i:05}")
    toxic = [(" ".join(name(i) for i in range(a * 200, a * 200 + 200)) + f" r{chr(97 + a % 26)}{chr(97 + k)}", 1)
             for a in range(30) for k in range(3)]
    clean = [(" ".join("cc" + "".join(chr(97 + int(d)) for d in f"{a * 20 + i:05}") for i in range(20)), 0) for a in range(200)]
    # near copies are taken once, so each of three rows has words of its own
    toxic = [(text + " " + " ".join(f"own{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(400)), t)
             for n, (text, t) in enumerate(toxic)]
    rows = spark.createDataFrame(toxic + clean, "text STRING, toxic INT").repartition(4)
    monkeypatch.setattr(toxicity, "MIN_TOXIC", 1)
    lexicon = toxicity.learn(rows)
    assert {name(i) for i in range(6000)} <= lexicon.weights.keys()
    assert toxicity.learn(rows.repartition(7)) == lexicon  # whatever the partitions are
    monkeypatch.setattr(toxicity, "MOST_TERMS", 100)
    with pytest.raises(ValueError, match="none may be left out"):
        toxicity.learn(rows)


def naive_hits(weights, exceptions, folded):
    """Words of the lexicon that stand outside every exception phrase, word by word."""
    words = folded.split()
    safe = {k for i in range(len(words) - 1) if f"{words[i]} {words[i + 1]}" in exceptions for k in (i, i + 1)}
    return [w for k, w in enumerate(words) if w in weights and k not in safe]


def test_weights_exceptions_curve_and_scores_by_brute_force(spark):
    """Counts, weights and scores worked out in plain Python; repeated rows, very long texts and clashing columns included."""
    rand, rows = random.Random(4), []
    name = lambda n: "".join(chr(97 + n // 26 ** k % 26) for k in range(3)) + "q"
    for i in range(240):
        words = [name(rand.randrange(3000)) for _ in range(rand.randrange(20, 60))]
        toxic = int(i % 5 == 0)
        if toxic:
            words[rand.randrange(len(words))] = rand.choice(["ZORG", "z0rg", "blat", "bl\u0430t"])
            words[rand.randrange(len(words))] = "grum"
        elif i % 30 == 1:
            at = rand.randrange(len(words) - 2)
            words[at:at + 2] = ["grum", "valley"]
        rows.append((" ".join(words), toxic))
    rows += [(" ".join(name(rand.randrange(3000)) for _ in range(60_000)), 0), (None, 0), ("", 1), ("zorg", None)]
    rows += rows[:40] * 3  # copies count once
    frame_ = spark.createDataFrame(rows, "text STRING, toxic INT").withColumn("term", F.lit("x")).withColumn("weight", F.lit("y"))
    lexicon = toxicity.learn(frame_.repartition(3))

    keyed = frame_.filter("toxic IN (0, 1)").select("text", "toxic", sketch("text"), F.xxhash64("text")).collect()
    taken = {}
    for text, toxic, key, order in keyed:
        taken[toxic, key] = min(taken.get((toxic, key), (order, text)), (order, text), key=lambda x: x[0])
    labelled_rows = [(text, toxic) for (toxic, _), (_, text) in taken.items()]
    n = Counter(toxic for _, toxic in labelled_rows)
    rate = n[1] / (n[0] + n[1])
    held = {label: Counter(w for text, toxic in labelled_rows if toxic == label for w in set(fold(text or "").split())) for label in (0, 1)}
    weights = {}
    for word, a in held[1].items():
        c = held[0][word]
        expected, weight = (a + c) * rate, math.log((a + 0.5) / (n[1] + 1)) - math.log((c + 0.5) / (n[0] + 1))
        if a >= toxicity.MIN_TOXIC and (a - expected) / math.sqrt(expected + 1) >= toxicity.MIN_DEVIATIONS and weight >= toxicity.MIN_WEIGHT:
            weights[word] = weight
    assert lexicon.weights.keys() == weights.keys() and {"zorg", "blat"} <= weights.keys()
    assert all(abs(lexicon.weights[w] - weights[w]) < 1e-9 for w in weights)
    pairs = {0: Counter(), 1: Counter()}
    for text, toxic in labelled_rows:
        own = fold(text or "").split()
        pairs[toxic].update({f"{a} {b}" for a, b in zip(own, own[1:]) if a in weights or b in weights})
    exceptions = {p for p, c in pairs[0].items() if c >= toxicity.MIN_TOXIC and pairs[1][p] <= rate * c}
    assert set(lexicon.exceptions) == exceptions and "grum valley" in exceptions

    def features(text):
        folded = fold(text or "")
        hits = naive_hits(weights, exceptions, folded)
        return ((sum(weights[w] for w in hits) / math.sqrt(len(folded.split()) + 1), math.log1p(sum(weights[w] for w in set(hits))))
                if hits else (0.0, 0.0))

    x, y = np.array([features(t) for t, _ in labelled_rows]), np.array([toxic for _, toxic in labelled_rows])
    # the curve is where the penalised likelihood has no slope
    a, b, c = lexicon.curve
    p = 1 / (1 + np.exp(-(a + x @ [b, c])))
    assert np.abs([(p - y).sum(), x[:, 0] @ (p - y) + 0.1 * b, x[:, 1] @ (p - y) + 0.1 * c]).max() < 1e-4
    for r in toxicity.scored(frame_, lexicon).select("text", "score", "predicted").collect():
        dense, wide = features(r.text)
        want = 1 / (1 + math.exp(-(a + b * dense + c * wide)))
        assert abs(r.score - want) < 1e-9 and r.predicted == (want >= toxicity.THRESHOLD)
