"""Document rates that give soft domains their target shares of tokens.

A naive Bayes classifier over hashed words, word ends and repeated words is learned from labelled rows and gives every
document a posterior over domains.
The expected tokens of a domain are the sum over documents of rate x tokens x posterior. Nonnegative rates are fitted to the
targets by projected gradient steps from 1, each scaled by the domains' second moments over the documents still in use. A step
is one pass over stored posteriors that returns a few sums; rates are made again from the steps so far, never stored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import sampled, stored
from dimflow.llm.sketch import sketch
from dimflow.llm.words import chunks, find_words, give_back, mix

FEATURES = 1 << 17
MIN_DEVIATIONS = 4.0  # a feature speaks for or against a domain if its rows there are so far from the expected
REPEATS = 3  # a text with so many words that repeat the word before has the first feature
FIT_ROWS = 20_000  # bound of the sample on which the classifier's sharpness is fitted
STEPS, TOLERANCE = 30, 1e-5


def _features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, int]]:
    """The distinct features of each text, and its number of words."""
    words = find_words(texts)
    data = np.frombuffer(words.data, np.uint8)
    ends = np.zeros(len(words.hashes), np.uint64)
    for k in range(1, 4):
        inside = words.ends - k >= words.starts
        ends = ends * np.uint64(256) + np.where(inside, data[np.maximum(words.ends - k, 0)], 0).astype(np.uint64)
    own = 1 + (words.hashes % np.uint64(FEATURES - 1)).astype(np.int64)
    tail = 1 + (mix(ends + np.uint64(1)) % np.uint64(FEATURES - 1)).astype(np.int64)
    for a, b in zip(words.first[:-1], words.first[1:]):
        repeated = int((words.hashes[a + 1:b] == words.hashes[a:max(b - 1, a)]).sum()) >= REPEATS
        yield np.unique(np.concatenate([own[a:b], tail[a:b], np.zeros(int(repeated), np.int64)])), int(b - a)


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    priors: np.ndarray
    weights: np.ndarray  # features x domains: how far the log share of rows is from the mean over the domains
    sharpness: float = 1.0

    def evidence(self, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text and its evidence for each domain."""
        tokens, evidence = [], []
        for _, part in chunks(pa.array(texts, pa.string())):
            for features, n in _features(part):
                tokens.append(n)
                evidence.append(self.weights[features].sum(axis=0))
        give_back()
        return np.array(tokens, np.int64), np.array(evidence).reshape(-1, len(self.domains))

    def posteriors(self, evidence: np.ndarray, sharpness: float | None = None) -> np.ndarray:
        z = np.log(self.priors) + (self.sharpness if sharpness is None else sharpness) * evidence
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def learn(labelled: DataFrame, domains: Sequence[str], fit_rows: int = FIT_ROWS) -> Classifier:
    """A classifier from rows (text, domain); domains not asked for are left out. Copies would make any word of theirs look
    telling, so of rows with the same domain and sketch one is taken, the same whenever it runs. Counts cover all such rows;
    NULL texts have no words. Only the sharpness is fitted on a sample of at most ``fit_rows`` rows, chosen by hash. Without rows posteriors are even."""
    domains = tuple(domains)
    labelled = stored(labelled.filter(F.col("domain").isin(*domains)).groupBy("domain", sketch("text").alias("_sketch"))
                      .agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "domain"), "mixing-labelled")
    number = {d: i for i, d in enumerate(domains)}
    width = FEATURES + 1  # the last place counts rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [number[d] for d in batch.column("domain").to_pylist()]
            counts = np.zeros((len(domains), width))
            for first, texts in chunks(batch.column("text")):
                for i, (features, _) in enumerate(_features(texts)):
                    counts[own[first + i]][features] += 1
                    counts[own[first + i], -1] += 1
            places = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(counts.ravel()[places])], names=["place", "n"])

    sums = labelled.mapInArrow(run, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(domains) * width)
    counts[sums["place"].to_numpy(int)] = sums["n"].to_numpy()
    counts = counts.reshape(len(domains), width)
    rows, counts = counts[:, -1], counts[:, :-1]
    priors = (rows + 1) / (rows + 1).sum()
    logs = np.log((counts + 0.5) / (rows[:, None] + 1))
    expected = counts.sum(axis=0) * (rows / max(rows.sum(), 1))[:, None]
    telling = (np.abs(counts - expected) / np.sqrt(expected + 1)).max(axis=0) >= MIN_DEVIATIONS
    model = Classifier(domains, priors, np.where(telling, logs - logs.mean(axis=0), 0.0).T.copy())
    sample = labelled.filter(sampled(fit_rows, int(rows.sum())))

    def evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"domain": frame["domain"], "e": list(model.evidence(frame["text"])[1])})

    rows = sample.mapInPandas(evidence, "domain string, e array<double>").toPandas()
    if not len(rows):
        return model
    x, y = np.array(rows["e"].tolist()), rows["domain"].map(number).to_numpy()
    loss = lambda s: -np.log(model.posteriors(x, s)[np.arange(len(y)), y] + 1e-12).mean()
    return Classifier(domains, priors, model.weights, min((2.0 ** (k / 2) for k in range(-10, 9)), key=loss))


def _rates(posteriors: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    x = np.ones(len(posteriors))
    for step in steps:
        x = np.maximum(0.0, x - posteriors @ step)
    return x


@dataclass(frozen=True)
class Mix:
    classifier: Classifier
    steps: list[np.ndarray]
    targets: np.ndarray
    expected: np.ndarray
    before: np.ndarray

    def column(self):
        """A function of a text column: struct of tokens, posteriors and rate."""
        def run(texts: pd.Series) -> pd.DataFrame:
            tokens, evidence = self.classifier.evidence(texts)
            p = self.classifier.posteriors(evidence) if len(tokens) else evidence
            return pd.DataFrame({"tokens": tokens, "posteriors": list(p), "rate": _rates(p, self.steps)})

        return F.pandas_udf(run, "tokens long, posteriors array<double>, rate double")


def fit(docs: DataFrame, classifier: Classifier, weights: Sequence[float], keep: str | None = None,
        total: float | None = None) -> Mix:
    """Rates for ``docs`` (text) so that domain i has the share ``weights[i]`` of ``total`` expected tokens.

    Without ``total`` it is what the documents hold, or, with ``keep``, what leaves the expected tokens of that domain as
    they are. Targets that no nonnegative rates reach are met as closely as the steps come.
    """
    share = np.array(weights, float) / sum(weights)
    even = Mix(classifier, [], share, share, share)
    facts = stored(docs.select(even.column()("text").alias("f")).select("f.tokens", "f.posteriors"), "mixing-posteriors")
    d = len(share)

    def sums(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(d + d * d)
            for batch in batches:
                p = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                w = batch.column("tokens").to_numpy(zero_copy_only=False).astype(float)
                x = _rates(p, steps)
                held[:d] += p.T @ (w * x)
                held[d:] += ((p * (w * (x > 0))[:, None]).T @ p).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], names=["place", "value"])

        rows = facts.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("v")).collect()
        out = np.zeros(d + d * d)
        for r in rows:
            out[r.place] = r.v
        return out[:d], out[d:].reshape(d, d)

    before, moments = sums([])
    if total is None:
        total = before.sum() if keep is None else before[classifier.domains.index(keep)] / share[classifier.domains.index(keep)]
    targets, expected, steps, best = share * total, before, [], None
    for _ in range(STEPS):
        gap = np.abs(expected - targets).sum()
        if best is None or gap < best[0]:
            best = (gap, list(steps), expected)
        if gap <= TOLERANCE * max(total, 1):
            break
        scale = moments + 1e-9 * max(np.trace(moments), 1e-9) * np.eye(d)
        steps.append(np.linalg.solve(scale, expected - targets))
        expected, moments = sums(steps)
    gap = np.abs(expected - targets).sum()
    if gap < best[0]:
        best = (gap, list(steps), expected)
    return Mix(classifier, best[1], targets, best[2], before)


def rated(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with tokens, posteriors, rate and copies; columns of these names are replaced.

    A document is there ``copies`` times in the mix: one of the two whole numbers around its rate, by a hash of doc_id and
    text, so that the mean over documents is the rate. NULL and empty texts have no tokens and the priors as posteriors; rows
    alike fare alike.
    """
    docs = docs.drop("tokens", "posteriors", "rate", "copies").withColumn("_f", mix.column()("text"))
    rate = F.col("_f.rate")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(rate + draw)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "_f"], F.col("_f.tokens").alias("tokens"),
                       F.col("_f.posteriors").alias("posteriors"), rate.alias("rate"), copies.cast("long").alias("copies"))


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents of the mix, each as often as it has copies, with the columns of ``docs``."""
    return (rated(docs, mix).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
