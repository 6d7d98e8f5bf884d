import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimflow.llm import periodic
from dimflow.llm.queries import op12_periodic_runs
from dimflow.llm.words import mix
from tests.llm.data import documents, empty, frame

WORD = "[^\x20\x09-\x0d]+"


def brute(words, least=6, periods=4):
    """All maximal runs by comparing every word with every later one up to the longest period."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i:j + q]
            smaller = any(all(run[x] == run[x + d] for x in range(len(run) - d)) for d in range(1, q) if q % d == 0)
            if len(run) >= max(least, periods * q) and not smaller:
                out.append((i, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words, *limits):
    hashes = mix(np.array(words, np.uint64))
    return [tuple(r) for r in periodic.periodic_runs(hashes, *limits).tolist()]


def test_classes_cover_all_lags_once():
    classes = list(periodic.lag_classes(5000))
    assert classes[:4] == [(5, 1, 5), (18, 6, 18), (57, 19, 57), (174, 58, 174)]
    for least in range(2, 30):
        for periods in range(2, 7):
            after = 1
            for k, first, last in periodic.lag_classes(300, least, periods):
                assert first == after and k >= last >= first
                assert all(max(least, periods * q) - q >= k for q in range(first, last + 1))
                after = last + 1


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(1, 9), st.integers(1, 9))
def test_runs_of_small_alphabets(words, times, more):
    text = words[:10] * times + words + words[5:9] * more
    assert found(text) == brute(text)


def test_periods_made_of_blocks_that_repeat_inside():
    rand = random.Random(4)
    for _ in range(60):
        x, y = ([rand.randrange(6) for _ in range(rand.randrange(1, 12))] for _ in range(2))
        unit = sum((rand.choice((x, y)) for _ in range(rand.randrange(1, 9))), [])
        text = [9] * rand.randrange(3) + unit * rand.randrange(2, 7) + unit[:rand.randrange(len(unit) + 1)] + x * 5 + y
        assert found(text) == brute(text)


@pytest.mark.parametrize("least,periods", [(2, 2), (10, 3), (3, 4), (25, 2)])
def test_other_limits(least, periods):
    rand = random.Random(least)
    for _ in range(60):
        text = [rand.randrange(2) for _ in range(rand.randrange(60))]
        text += text[:7] * rand.randrange(5)
        assert found(text, least, periods) == brute(text, least, periods)


def test_one_word_very_often_and_long_texts():
    assert found([1] * 200_000) == [(0, 200_000, 1)]
    unit = list(range(3000))
    assert found([7, *unit * 5, 8]) == [(1, 15_000, 3000)]
    assert found(list(range(100_000))) == []


def test_documents_as_by_brute_force(spark):
    rows = documents()
    rows += [(900, "a b a b a b a b  \tA x x x x x x x", *[None] * 6), (901, ("é z " * 9).strip(), *[None] * 6),
             (902, "x " * 30_000, *[None] * 6), (None, "k k k k k k k", *[None] * 6)]
    want = []
    for r in rows:
        words = re.findall(WORD, r[1] or "")
        runs = brute(words) if len(words) < 5000 else None
        if runs is None:
            runs = [(0, 30_000, 1)] if words[0] == "x" else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append(str((r[0], len(words), " ".join(w for i, w in enumerate(words) if i not in gone), runs)))
    got = periodic.without_periods(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_words, r.text, [tuple(x) for x in r.runs])) for r in got) == sorted(want)


def test_empty_table(spark):
    assert periodic.without_periods(empty(spark)).count() == 0


def test_query_as_by_brute_force(spark, tmp_path):
    """The whole query over a table with the awkward cases, the words changed as the query asks."""
    rows = [r[:2] for r in documents(seed=5, n=160)] + [(10_000 + i, "one two three four five six seven"[:i]) for i in range(30)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, changed = [], 0
    for doc_id, text in rows:
        words = re.findall(WORD, text or "")
        n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, changed = g % n, changed + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = [tuple(r) for r in found([zlib.crc32(w.encode()) for w in words])] if n > 3000 else brute(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append(str((doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                         sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
                         sha(" ".join(w for i, w in enumerate(words) if i not in gone)))))
    result = op12_periodic_runs(spark, path)
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in result.dtypes} == {"bigint", "string"}
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(want) and changed > 10
