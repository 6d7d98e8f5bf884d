import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dimflow.llm import packing
from tests.llm.data import documents, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("capacity,block", [(64, 40), (4096, 20_000)])
def test_pieces_and_sequences(spark, capacity, block):
    coder, want = Tokenizer.from_file(PATH), []
    for doc_id, text, *_ in documents():
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(doc_id, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                 for k, s in enumerate(range(0, len(ids), capacity))]
    found = packing.pack(packing.token_pieces(frame(spark), PATH, 1, capacity), capacity, block).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in found)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in found) // capacity)
    assert len(sequences) <= least + 3


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(empty(spark), PATH)).count() == 0


def test_genetic_search_keeps_packings_whole():
    rng = np.random.default_rng(3)
    sizes = rng.integers(20, 60, 400)
    best = packing.evolve(sizes, [], 1, 100)
    for bins in best:
        fill = np.bincount(bins, weights=sizes)
        assert fill.max() <= 100 and (fill > 0).all() and len(bins) == 400
    child = packing.crossover(best[0], best[-1], sizes, 100, rng)
    assert (child >= 0).all() and np.bincount(child, weights=sizes).max() <= 100
    assert packing.fitness(best[0], sizes, 100) >= packing.fitness(
        packing.best_fit(sizes, np.argsort(-sizes, kind="stable"), 100), sizes, 100)


def test_genetic_search_beats_best_fit_decreasing(spark):
    """Pieces that fill sequences three by three: best-fit decreasing needs more sequences than the islands find, whose
    crossover, elite and epochs all take part."""
    rng, sizes = np.random.default_rng(5), []
    for _ in range(150):
        a, b = (int(x) for x in rng.integers(1100, 1500, 2))
        sizes += [a, b, 4096 - a - b]
    sizes = np.array(sizes)
    plain = packing.best_fit(sizes, np.argsort(-sizes, kind="stable"), 4096).max() + 1
    pieces = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)],
                                   "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG")
    found = packing.pack(pieces, 4096).collect()
    fill = {}
    for r in found:
        fill.setdefault(r.sequence_id, []).append(r.length)
    assert sorted(r.length for r in found) == sorted(sizes.tolist()) and max(map(sum, fill.values())) <= 4096
    print("sequences:", len(fill), "best-fit decreasing:", plain, "least:", 150)
    assert 150 <= len(fill) < plain
