"""Words of whole texts as 64-bit hashes, found with array operations over the bytes of many texts at once."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
POWERS = CHUNK_BYTES + (1 << 16)  # kept by a worker; a chunk has a byte more for each text
BASE = np.uint64(0x9E3779B97F4A7C15)
SHINGLE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
SHINGLE_WORDS = 5


def kept(name: str, make: Callable):
    """What ``make`` gives, made once per Python process: functions sent by value bring no module state along."""
    cache = sys.__dict__.setdefault("_kept_by_workers", {})
    if name not in cache:
        cache[name] = make()
    return cache[name]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def give_back() -> None:
    """Return freed memory to the system: idle workers stay alive beside the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = kept("malloc_trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", None))
    if trim is not None:
        trim(0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(POWERS, n)

    def table(base: int) -> np.ndarray:
        out = np.full(size, np.uint64(base), np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def make() -> tuple[np.ndarray, np.ndarray]:
        return table(int(BASE)), table(pow(int(BASE), -1, 2**64))

    # those of a larger text go with it: making them is quick, and workers live on beside later stages
    return make() if size > POWERS else kept("powers", make)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    def make():
        space = np.zeros(256, bool)
        space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        return mix(np.arange(1, 257, dtype=np.uint64)), space

    return kept("bytes", make)


@dataclass(frozen=True)
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts. Text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def shingles(self, i: int) -> np.ndarray:
        """Sorted distinct hashes of the 5-word shingles of text ``i``; of all its words if it has fewer."""
        h = self.hashes[self.first[i]:self.first[i + 1]]
        if len(h) == 0:
            return h
        n = min(SHINGLE_WORDS, len(h))
        out = h[:len(h) - n + 1].copy()
        for k in range(1, n):
            out = out * SHINGLE_BASE + h[k:len(h) - n + 1 + k]
        return np.unique(mix(out + np.uint64(n)))


def find_words(texts: list[bytes | None], lower: bool = True) -> Words:
    texts = [t or b"" for t in texts]
    data = b"\n".join(texts) + b"\n"
    if lower:
        data = data.lower()  # bytes: A-Z only
    value, is_space = _byte_tables()
    a = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], is_space[a]])
    change = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = change[0::2], change[1::2]
    up, down = _powers(len(a))
    running = value[a]
    running *= up[:len(a)]
    np.cumsum(running, out=running)
    before = np.where(starts > 0, running[starts - 1], np.uint64(0)) if len(starts) else np.zeros(0, np.uint64)
    hashes = mix((running[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64)) if len(starts) else before
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    borders = np.concatenate([[0], np.cumsum(lengths)])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, borders))


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as UTF-8) for pieces of a string column of about ``size`` bytes; NULL is empty."""
    texts: list[bytes] = []
    at = begin = held = 0
    for text in column.cast(pa.binary()):
        t = text.as_py() or b""
        if texts and held + len(t) > size:
            yield begin, texts
            texts, begin, held = [], at, 0
        texts.append(t)
        held += len(t)
        at += 1
    if texts:
        yield begin, texts
