"""Runs of words that repeat with a period, found by seeds on diagonals.

A run with period q is a stretch of equal words on the diagonal of lag q (word i against word i + q). Lags are taken in
classes. For each, the guaranteed overlap of a run with itself gives a k such that every run of the class holds two equal
k-grams one period apart, and k is no shorter than the period, so that no equal k-gram lies between them. It is therefore
enough to look at each k-gram and its next occurrence: pairs grow with the words, not with the square of a frequent k-gram.
A pair is extended along its diagonal to both sides; a table per lag of how far diagonals are covered stops further pairs of
the same stretch from being extended again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.words import chunks, find_words, give_back, mix

MIN_WORDS, MIN_PERIODS = 6, 4
_LEFT, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
FOUND = "doc_id long, n_words long, text string, runs array<struct<start:long,length:long,period:long>>"


def lag_classes(longest: int, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> Iterator[tuple[int, int, int]]:
    """(k, first lag, last lag) up to the lag ``longest``: k is the least overlap of the class and at least its last lag."""
    if periods < 2 or least < 2:
        raise ValueError("a run has two words and two periods at least")
    overlap = lambda q: max(least, periods * q) - q
    first = 1
    while first <= longest:
        last, k = first, overlap(first)
        if periods * first >= least:  # overlaps grow from here on
            last = k
        while min(k, overlap(last + 1)) > last:
            last += 1
            k = min(k, overlap(last))
        yield k, first, last
        first = last + 1


def gram_names(words: np.ndarray, k: int) -> np.ndarray:
    """A number for each k-gram, by its start: names of lengths doubled, and two that overlap for the rest."""
    names, size = mix(words), 1
    while 2 * size <= k:
        names = mix(names[:-size] * _LEFT + names[size:])
        size *= 2
    rest = k - size
    return mix(names[:len(names) - rest] * _LAST + names[rest:])


def _next_equal(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of ascending ``at``) and the next position with the same name, where there is one."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    return at[order[:-1][same]], at[order[1:][same]]


def _equal_steps(words: np.ndarray, left: int, right: int, step: int) -> int:
    """How many words in a row, from ``left`` and ``right`` on in direction ``step``, are equal."""
    total, size = 0, 64
    while True:
        if step > 0:
            n = min(size, len(words) - right)
            same = words[left:left + n] == words[right:right + n]
        else:
            n = min(size, left + 1)
            same = words[left - n + 1:left + 1][::-1] == words[right - n + 1:right + 1][::-1]
        if n <= 0:
            return total
        if not same.all():
            return total + int(np.argmin(same))
        total, left, right, size = total + n, left + step * n, right + step * n, 2 * size


def periodic_runs(words: np.ndarray, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs of ``least`` words and ``periods`` periods, by start and period."""
    found, at = [], np.arange(len(words))
    for k, first, last in lag_classes(len(words) // periods, least, periods):
        at = at[at + k <= len(words)]
        if not len(at):
            break
        left, right = _next_equal(gram_names(words, k)[at], at)
        at = np.unique(np.concatenate([left, right]))  # a longer gram is repeated only where a shorter one is
        lag = right - left
        seeds = (lag >= first) & (lag <= last)
        left, lag = left[seeds], lag[seeds]
        order = np.lexsort((left, lag))
        left, lag = left[order], lag[order]
        borders = np.flatnonzero(np.diff(lag, prepend=0, append=0))
        for a, b in zip(borders[:-1], borders[1:]):
            q, own, i = int(lag[a]), left[a:b], 0
            while i < len(own):
                p = int(own[i])
                end = p + _equal_steps(words, p, p + q, 1)  # the diagonal is covered up to here
                start = p - _equal_steps(words, p - 1, p - 1 + q, -1) if p else 0
                if end - start + q >= max(least, periods * q):
                    found.append((start, end - start + q, q))
                i += int(np.searchsorted(own[i:], max(end, p + 1)))
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


def _with_repeats(words: np.ndarray, first: np.ndarray, k: int) -> set[int]:
    """The texts that hold a k-gram twice."""
    ends = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(words))
    at = at[at + k <= ends]
    if len(at) < 2:
        return set()
    left, right = _next_equal(gram_names(words, k)[at], at)
    left, right = (np.searchsorted(first, x, side="right") for x in (left, right))
    return set((left[left == right] - 1).tolist())


def without_periods(docs: DataFrame, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, text, runs for every row of ``docs`` (doc_id, text; other columns are not read).

    ``runs`` are the maximal runs of words ``[^\\x20\\x09-\\x0D]+``, by start and period: stretches of at least ``least`` words
    and ``periods`` periods, under their smallest period. ``text`` has the words that no run holds after its first period,
    joined by single spaces. One pass, no shuffle; a text of any length is searched as a whole. A NULL, empty or blank text
    has no words, no runs and an empty text. Rows are searched one by one: repeated rows and NULL ids stay as they are.
    """
    k = next(lag_classes(1, least, periods))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, texts in chunks(batch.column("text")):
                found = find_words(texts, lower=False)
                repeats = _with_repeats(found.hashes, found.first, k)
                left, runs = [], []
                for i, text in enumerate(texts):
                    own = text.split()  # bytes: at the characters 20 and 09 to 0D only
                    rows = np.zeros((0, 3), np.int64)
                    if i in repeats:
                        rows = periodic_runs(found.hashes[found.first[i]:found.first[i + 1]], least, periods)
                        if len(rows):
                            own = compress(own, kept_words(len(own), rows).tolist())
                    left.append(b" ".join(own))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in rows.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, len(texts)), pa.array(np.diff(found.first), pa.int64()),
                     pa.array(left, pa.binary()).cast(pa.string()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))],
                    names=["doc_id", "n_words", "text", "runs"])
            give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)
