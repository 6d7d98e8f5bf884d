import math
import random

import pytest

from dimflow.llm import licenses
from tests.llm.data import documents, empty, frame


def shingles(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def letters(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "")).lower().split()


def best_window(words, template, steps):
    """Brute force: the largest share of the template's shingles in any of its windows."""
    t = letters(template)
    n = min(5, len(t))
    wanted, step = shingles(t, n), 1
    while step < len(t) - n + 1:
        step *= 2
    own = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    return max([len(wanted & set(own[b:b + 2 * step])) / len(wanted) for b in range(0, len(own), step)] + [0])


def test_matches_as_by_brute_force(spark):
    rand, rows = random.Random(1), []
    names = list(licenses.TEMPLATES)
    for i in range(60):
        words = [f"w{rand.randrange(50)}" for _ in range(rand.randrange(0, 400))]
        for name in rand.sample(names, 2):
            text = licenses.TEMPLATES[name].split()
            if i % 3 == 1:
                text[rand.randrange(len(text))] = "changed"
            if i % 7 == 2:
                text = text[:len(text) // 2]
            at = rand.randrange(len(words) + 1)
            words[at:at] = [w.upper() if i % 2 else w for w in text]
        rows.append((i, " ".join(words), *[None] * 6))
    rows += [(1000 + i, r[1], *[None] * 6) for i, r in enumerate(documents())]
    want = set()
    for doc_id, text, *_ in rows:
        for name, template in licenses.TEMPLATES.items():
            share = best_window(letters(text), template, None)
            if share >= licenses.CONTAINED:
                want.add((doc_id, name, round(share, 9)))
    found = licenses.scan(frame(spark, rows))
    assert found.columns == ["doc_id", "license", "containment", "first_word", "windows"]
    assert {(r.doc_id, r.license, round(r.containment, 9)) for r in found.collect()} == want and len(want) > 60


def test_first_word(spark):
    found = licenses.scan(frame(spark, [(1, "a b, c. Released under the MIT License", *[None] * 6)])).collect()
    assert [(r.license, r.first_word) for r in found] == [("MIT short", 3)]


def test_own_templates_and_empty_tables(spark):
    assert licenses.scan(empty(spark)).count() == 0
    rows = frame(spark, [(1, "x my own notice y", *[None] * 6), (2, None, *[None] * 6), (3, "", *[None] * 6)])
    assert [r.doc_id for r in licenses.scan(rows, {"own": "My own NOTICE!", "none": " ... "}).collect()] == [1]
    assert licenses.scan(rows, {}).count() == 0


def test_bands_alone_retrieve():
    """Bands suffice for the stated miss probability, and with other minima in them nothing is found."""
    own = licenses.prepared(licenses.TEMPLATES)
    for t in own:
        n, inside = len(t.shingles), math.ceil(licenses.CONTAINED * len(t.shingles))
        assert inside / (2 * t.step + n - inside) >= 0.18
        assert (1 - inside / (2 * t.step + n - inside)) ** t.bands <= licenses.MISS
    text = " ".join(["some words before"] * 40 + [licenses.TEMPLATES["MIT grant"]] + ["and after"] * 40).encode()
    words = licenses.find_words([licenses._letters(t) for t in (b"", b"one", text, b"two words", b"")])
    bands = licenses.index(own)
    found = licenses.retrieved(words.hashes, words.first, bands)
    assert (2, [t.name for t in own].index("MIT grant")) in found
    none = [licenses.Bands(b.words, b.step, [m ^ m for m in b.minima], b.owners) for b in bands]
    assert licenses.retrieved(words.hashes, words.first, none) == set()


def test_several_hundred_templates_from_a_table(spark):
    rand = random.Random(3)
    own = {f"t{i}": " ".join(f"v{rand.randrange(4000)}" for _ in range(rand.randrange(1, 90))) for i in range(400)}
    table = spark.createDataFrame([*own.items(), ("none", None), (None, "x")], "name STRING, text STRING")
    rows = []
    for i in range(80):
        words = [f"w{rand.randrange(90)}" for _ in range(rand.randrange(0, 300))]
        for name in rand.sample(sorted(own), 3):
            at = rand.randrange(len(words) + 1)
            words[at:at] = own[name].split()
        rows.append((i, " ".join(words), *[None] * 6))
    want = {(i, name, round(share, 9)) for i, text, *_ in rows for name, t in own.items() if set(t.split()) & set(text.split())
            for share in [best_window(letters(text), t, None)] if share >= licenses.CONTAINED}
    found = licenses.scan(frame(spark, rows), table)
    assert {(r.doc_id, r.license, round(r.containment, 9)) for r in found.collect()} == want and len(want) > 150
    with pytest.raises(ValueError):
        licenses.templates_of(table, 100)
