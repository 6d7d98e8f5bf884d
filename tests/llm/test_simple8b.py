import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dimflow.llm import simple8b
from dimflow.sources.storage import work_dir
from tests.llm.data import documents, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_round_trip(values):
    ids = np.array(values, np.uint64)
    coded = simple8b.encode(ids)
    assert simple8b.decode(coded, len(ids)).tolist() == values
    assert len(coded.offsets) == -(-len(ids) // simple8b.BLOCK) + 1


def test_small_ids_take_little_room():
    assert len(simple8b.encode(np.ones(6000, np.uint64)).words) <= 6 * 18


@pytest.mark.parametrize("segment", [50, 1 << 18])
def test_files_give_the_ids_back(spark, monkeypatch, segment):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", segment)
    coder, path = Tokenizer.from_file(PATH), work_dir(spark, "test-ids")
    simple8b.write_ids(frame(spark), path, PATH, 2)
    found = sorted(simple8b.read_ids(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert r.start == at
        at += len(r.ids) // 4
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    want = [(d, zlib.crc32(np.array(coder.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
            for d, t, *_ in documents()]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, zlib.crc32(r.ids))) for r in found)


def test_empty_table(spark):
    path = work_dir(spark, "test-ids")
    simple8b.write_ids(empty(spark), path, PATH, 2)
    assert simple8b.read_ids(spark, path).count() == 0
