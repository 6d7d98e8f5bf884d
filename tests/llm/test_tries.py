import hashlib
import random
import re
from collections import defaultdict

import pytest

from dimflow.llm import tries
from dimflow.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string, pos long, node long, name string"


def brute(turns, members=()):
    """The trie by its definition: every beginning of every conversation."""
    talks = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            talks[conv].append((turn is not None, turn or 0, key, (role, text)))
    talks = {c: tuple(x[3] for x in sorted(v)) for c, v in talks.items()} | {c: () for c in members if c is not None and c not in talks}
    convs = defaultdict(list)
    for c, talk in talks.items():
        for d in range(len(talk) + 1):
            convs[talk[:d]].append(c)
    children = defaultdict(list)
    for b in convs:
        if b:
            children[b[:-1]].append(b)
    words = lambda b: len(re.findall("[^\x20\x09-\x0d]+", b[-1][1])) if b else 0

    leaves, saved = defaultdict(int), defaultdict(int)
    for b in convs:
        for d in range(len(b) + 1):
            leaves[b[:d]] += not children[b]
            saved[b[:d]] += (len(convs[b]) - 1) * words(b)
    ends = lambda b: ",".join(str(c) for c in sorted(convs[b]) if len(talks[c]) == len(b))
    return sorted((min(convs[b]), len(b), min(convs[b[:-1]]) if b else None, len(convs[b]), len(children[b]), leaves[b], saved[b],
                   hashlib.sha256(ends(b).encode()).hexdigest()) for b in convs)


def trie(spark, turns, members=(), limit=2_000_000):
    rows = spark.createDataFrame([(*t, 1, 2, "n") for t in turns], SCHEMA).repartition(4)
    found = stored(tries.steps(rows, limit), "test-steps")
    extra = spark.createDataFrame([(c,) for c in members], "conv_id long")
    result = tries.prefix_trie(found, found.select("conv_id").union(extra), limit)
    assert result.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in result.collect()))


def some(seed, n=40):
    rand = random.Random(seed)
    turns = []
    for c in range(n):
        size = rand.choice((1, 2, 3, 3, 7, 8, 9, 17))
        pick = rand.choice((1, 1, 3))
        turns += [(c * 3, t, "user" if t % 2 else "bot", f"w {rand.randrange(pick)} " * rand.randrange(1, 3)) for t in range(size)]
    turns += [(500, None, None, None), (500, None, None, None), (500, 4, "", "x"), (501, 1, None, ""), (None, 1, "user", "lost"),
              (502, 1, "a", "b\n\tc"), (502, 1, "a", "b\n\tc"), (502, 1, "ab", ""), (503, -4, "a" * 50_000, "long " * 20_000)]
    rand.shuffle(turns)
    return turns


@pytest.mark.parametrize("limit", [2_000_000, 6])
def test_as_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(tries, "PIECE_IDS", 3)
    turns = some(limit)
    members = [1000, 1001, None, 3]
    assert trie(spark, turns, members, limit) == brute(turns, members)


def test_one_long_conversation_among_copies(spark):
    talk = [(t, "user", f"turn {t}") for t in range(300)]
    turns = [(c, *t) for c in (5, 9, 2) for t in talk] + [(7, *t) for t in talk[:256]] + [(8, 0, "user", "other")]
    assert trie(spark, turns) == brute(turns)


def test_only_turnless_conversations_and_none_at_all(spark):
    assert trie(spark, [], [4, 2, 11]) == brute([], [4, 2, 11])
    assert trie(spark, []) == []
