"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding undoes look-alike letters and digit substitutions. The lexicon's words and weights, the phrases in which a word is
harmless, and the curve from weights to scores are all learned from labelled rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import sampled, stored
from dimflow.llm.sketch import sketch
from dimflow.llm.words import give_back, kept

MOST_TERMS = 200_000  # words or exceptions that a worker can hold; more are an error, none is left out
FIT_ROWS = 20_000  # bound of the sample on which the curve is fitted
MIN_TOXIC, MIN_DEVIATIONS, MIN_WEIGHT = 3, 4.0, 3.0
THRESHOLD = 0.7

# Letters that look like Latin ones, and digits or signs written for letters.
LOOK_ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
              "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ι": "i", "ν": "v",
              "ρ": "p", "τ": "t", "υ": "u", "κ": "k", "ε": "e", "ɑ": "a", "ɡ": "g", "ı": "i", "ſ": "s"}
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _folding() -> dict[int, str]:
    def make():
        wide = {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)}
        table = wide | {ord(k): v for k, v in (LOOK_ALIKE | WRITTEN_FOR).items()}
        table |= {c: " " for c in range(128) if not chr(c).isalpha() and c not in table}
        return table | {0xFF01 + i: table.get(0x21 + i, chr(0x21 + i)).lower() for i in range(94)}

    return kept("folding", make)


def fold(text: str) -> str:
    """Lower case, look-alikes and substitutions undone, one space around each word."""
    words = text.lower().translate(_folding()).split()
    return f" {' '.join(words)} " if words else " "


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def _automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for word in self.weights:
            found.add_word(f" {word} ", (False, len(word) + 2, word))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (True, len(phrase) + 2, phrase))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, folded: str, automaton=None) -> list[str]:
        """The lexicon's words in a folded text, without those inside an exception phrase."""
        found = automaton if automaton is not None else self._automaton()
        if not len(found):
            return []
        words, safe = [], []
        for end, (exception, size, word) in found.iter(folded):
            (safe if exception else words).append((end - size + 1, end, word))
        if not safe:
            return [w for _, _, w in words]
        return [w for s, e, w in words if not any(a <= s and e <= b for a, b, _ in safe)]

    def features(self, text: str | None, automaton=None) -> tuple[float, float]:
        """Weight of all hits by the root of the number of words, and weight of the different words hit."""
        folded = fold(text or "")
        hits = self.hits(folded, automaton)
        if not hits:
            return 0.0, 0.0
        total = sum(self.weights[w] for w in hits)
        return total / math.sqrt(folded.count(" ")), math.log1p(sum(self.weights[w] for w in set(hits)))

    def column(self):
        """A function of a text column: struct of both features and the score."""
        def features(texts: pd.Series) -> pd.DataFrame:
            own = kept(f"lexicon {hash((tuple(self.weights.items()), self.exceptions))}", self._automaton)
            rows = np.array([self.features(t, own) for t in texts], float).reshape(-1, 2)
            give_back()
            a, b, c = self.curve
            z = np.clip(a + b * rows[:, 0] + c * rows[:, 1], -500, 500)
            return pd.DataFrame({"dense": rows[:, 0], "wide": rows[:, 1], "score": 1 / (1 + np.exp(-z))})

        return F.pandas_udf(features, "dense double, wide double, score double")


def _counts(labelled: DataFrame, terms) -> DataFrame:
    """term, toxic, clean: rows of either label that hold a term of ``terms`` (a function of a folded text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_label = Counter(), Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                by_label[toxic].update(terms(fold(text or "")))
            names = list(by_label[0].keys() | by_label[1].keys())
            give_back()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([by_label[1][n] for n in names], pa.int64()),
                 pa.array([by_label[0][n] for n in names], pa.int64())], names=["term", "toxic", "clean"])

    parts = labelled.mapInArrow(run, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _all_of(terms: DataFrame, what: str) -> list:
    found = terms.limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} {what}: a worker cannot hold them all, and none may be left out")
    return found


def learn(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Lexicon:
    """A lexicon from rows (text, toxic 0 or 1; other labels are left out).

    A word is taken if clearly more toxic rows hold it than its frequency leads to expect. Copies would make any word of
    theirs look telling, so of rows with the same label and sketch one is taken, the same whenever it runs. Counts cover all
    such rows; only the curve is fitted on a sample of at most ``fit_rows`` rows, chosen by hash. Without both labels the
    lexicon is empty and every score low. All terms that pass the tests are taken.
    """
    labelled = labelled.filter(F.col("toxic").isin(0, 1)).select("text", F.col("toxic").cast("int").alias("toxic"))
    labelled = stored(labelled.groupBy("toxic", sketch("text").alias("_sketch")).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
                      .select("text", "toxic"), "toxicity-labelled")
    toxic, clean = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not toxic or not clean:
        return Lexicon({})
    rate = toxic / (toxic + clean)
    weight = (F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))).alias("weight")
    expected = (F.col("toxic") + F.col("clean")) * rate
    words = _counts(labelled, lambda folded: set(folded.split())).select("term", weight, "toxic", (
        (F.col("toxic") - expected) / F.sqrt(expected + 1)).alias("deviations"))
    chosen = words.filter((F.col("toxic") >= MIN_TOXIC) & (F.col("deviations") >= MIN_DEVIATIONS) & (F.col("weight") >= MIN_WEIGHT))
    weights = {r.term: r.weight for r in sorted(_all_of(chosen, "words"), key=lambda r: r.term)}

    def around(folded: str) -> set[str]:
        own = folded.split()
        return {f"{a} {b}" for a, b in zip(own, own[1:]) if a in weights or b in weights}

    # a phrase that clean rows hold far more often than the word in it would lead to expect
    harmless = (F.col("clean") >= MIN_TOXIC) & (F.col("toxic") <= rate * F.col("clean"))
    safe = _all_of(_counts(labelled, around).filter(harmless), "exceptions") if weights else []
    lexicon = Lexicon(weights, tuple(sorted(r.term for r in safe)))
    sample = labelled.filter(sampled(fit_rows, toxic + clean))
    rows = sample.select("toxic", lexicon.column()("text").alias("f")).select("toxic", "f.dense", "f.wide").toPandas()
    return Lexicon(lexicon.weights, lexicon.exceptions, _curve(rows[["dense", "wide"]].to_numpy(), rows["toxic"].to_numpy()))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> tuple[float, float, float]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w * [0, 1, 1]
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.diag([1e-3, 1, 1]), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def scored(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on); columns of these names are replaced.

    Only ``text`` counts. NULL, empty and blank texts have no hits and get the lowest score.
    """
    return (docs.drop("score", "predicted").withColumn("_f", lexicon.column()("text"))
            .withColumn("score", F.col("_f.score")).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("_f"))
