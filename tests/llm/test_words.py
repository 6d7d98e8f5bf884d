import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from dimflow.llm.tokens import WordEncoder
from dimflow.llm.words import chunks, find_words
from tests.llm.data import documents


def test_words_are_those_of_the_texts():
    texts = [(r[1] or "").encode() for r in documents()] + [b"\x1c \x85 a\x0bb\x0c", b""]
    found = find_words(texts)
    assert [found.data[s:e] for s, e in zip(found.starts, found.ends)] == [w for t in texts for w in t.lower().split()]
    assert np.diff(found.first).tolist() == [len(t.split()) for t in texts]
    by_hash = {}
    for s, e, h in zip(found.starts, found.ends, found.hashes.tolist()):
        assert by_hash.setdefault(h, found.data[s:e]) == found.data[s:e]
    assert len(by_hash) == len({w for t in texts for w in t.lower().split()})


def test_shingles():
    found = find_words([b"a b c d e f", b"A B C D E F a b c d e", b"a b", b"", b"a  B"])
    first, second, short, none, same = (found.shingles(i) for i in range(5))
    assert len(first) == 2 and set(first) <= set(second) and len(second) == 6 and len(short) == 1 and len(none) == 0
    assert short.tolist() == same.tolist()


def test_chunks_hold_every_text_once():
    texts = ["x" * n for n in (3, 50, 0, 200, 7)] + [None]
    parts = list(chunks(pa.array(texts), 60))
    assert [t for _, p in parts for t in p] == [(t or "").encode() for t in texts] and len(parts) > 2
    assert [b for b, _ in parts] == [sum(len(p) for _, p in parts[:i]) for i in range(len(parts))]


def test_ids_are_the_tokenizers(monkeypatch):
    coder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [(r[1] or "").encode() for r in documents()]
    texts += ["İstanbul <|endoftext|> ẞ ǅ ﬁ é".encode(), "it's 'S don't WE'RE ÀÉ×÷ÿ ¼ a.b ... a b\u0085c".encode(), "a\x00b\x7f".encode()]
    for limit in (10, 300_000):
        monkeypatch.setattr("dimflow.llm.tokens.CACHED", limit)
        for _ in range(2):
            ids, lengths = coder.encode(texts, 9)
            at = 0
            for text, n in zip(texts, lengths.tolist()):
                assert ids[at:at + n].tolist() == coder.tokenizer.encode(text.decode(), add_special_tokens=False).ids + [9]
                at += n
    assert at == len(ids)


def test_a_worker_keeps_no_tables_of_large_texts():
    find_words([b"a b"])
    held = dict(sys._kept_by_workers)
    assert len(find_words([b"a b " * (1 << 20)]).hashes) == 2 << 20
    assert sys._kept_by_workers == held
    assert sum(table.nbytes for table in held["powers"]) < 18 << 20


def test_known_words_take_little_memory():
    coder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"w{i + k}x" for k in range(2000)).encode() for i in range(0, 120_000, 2000)]
    texts += [" ".join(f"{w}{a}{b}{c}" for w in ("q", "z") for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"
                       for c in (f"{x}{y}" for x in "abcdefghijkl" for y in "abcdefghijkl")).encode()]
    tracemalloc.start()
    try:
        for text in texts:
            coder.encode([text], 9)
        assert tracemalloc.get_traced_memory()[0] < 30e6
    finally:
        tracemalloc.stop()
