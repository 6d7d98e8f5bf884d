"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per chunk."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from dimflow.llm.words import Words, find_words, kept

CACHED, CACHED_IDS = 300_000, 2_400_000  # words, and ids of theirs
CACHED_PIECES = 50_000
CHUNK_BYTES = 1 << 20
# Bytes of texts in which the tokenizer's white space, case folding and classes are those spelled out below:
# ASCII without other control characters, and the Latin letters U+00C0 to U+00FF, whose UTF-8 begins with C3.
ODD = np.ones(256, bool)
ODD[[*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3]] = False
# The tokenizer's own splitting rule on such lower-cased texts, and its byte alphabet, are fixed values.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def byte_alphabet() -> list[str]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class WordEncoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The tokenizer never joins characters across white space, so a text's ids are those of its words one after the
    other. Words of plain Latin texts are split as the tokenizer does and encoded by its model; any other text, and any
    text with a special token's string in it, goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.pieces: dict[str, bytes] = {}
        # words met lately, by ascending hash, in arrays: objects of their own would take ten times the memory
        self.names = np.zeros(0, np.uint64)
        self.sizes, self.used, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.chunk = 0

    def _plain(self, texts: list[bytes]) -> list[bool]:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        begin = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        odd = ODD[data]
        odd = np.add.reduceat(odd, begin, dtype=np.int64) if odd.any() else np.zeros(len(texts), np.int64)
        return [n == 0 and not (b"<|" in t and any(s in t for s in self.special)) for n, t in zip(odd.tolist(), texts)]

    def _piece(self, shown: str) -> bytes:
        """Ids of a piece in the tokenizer's byte alphabet."""
        found = self.pieces.get(shown)
        if found is None:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            found = self.pieces[shown] = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return found

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters, lower case already: one piece, shown as it is
            return self._piece(word.decode())
        if word[:-1].isalpha() and word[-1:] in b".,":
            return self._piece(word[:-1].decode()) + self._piece(word[-1:].decode())
        text = word.decode().lower()
        parts = [text] if text.isalpha() else PIECES.findall(text)
        return b"".join([self._piece(p.encode().decode("latin-1").translate(self.alphabet)) for p in parts])

    def _coded(self, names: np.ndarray, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of known words, and where those of the words at ``at`` begin and how many they are. ``names``: their hashes,
        ascending and distinct. Words stay for later chunks; once there are too many, those met lately, at most half, do."""
        self.chunk += 1
        if len(self.names) > CACHED or len(self.ids) > CACHED_IDS:
            half = len(self.used) // 2
            keep = self.used > np.partition(self.used, half)[half]
            self.ids = self.ids[np.repeat(keep, self.sizes)]
            self.names, self.sizes, self.used = self.names[keep], self.sizes[keep], self.used[keep]
        place = np.searchsorted(self.names, names)
        there = np.zeros(len(names), bool)
        inside = place < len(self.names)
        there[inside] = self.names[place[inside]] == names[inside]
        new = np.flatnonzero(~there)
        if len(new):
            starts, ends, data = words.starts[at[new]].tolist(), words.ends[at[new]].tolist(), words.data
            coded = [self._word(data[s:e]) for s, e in zip(starts, ends)]
            sizes = np.fromiter(map(len, coded), np.int32, len(coded)) // 4
            before = np.concatenate([[0], np.cumsum(self.sizes)])
            self.ids = np.insert(self.ids, np.repeat(before[place[new]], sizes), np.frombuffer(b"".join(coded), np.uint32))
            self.names = np.insert(self.names, place[new], names[new])
            self.sizes = np.insert(self.sizes, place[new], sizes)
            self.used = np.insert(self.used, place[new], self.chunk)
            place = np.searchsorted(self.names, names)
        self.used[place] = self.chunk
        return self.ids, (np.cumsum(self.sizes, dtype=np.int64) - self.sizes)[place], self.sizes[place].astype(np.int64)

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, each followed by the id ``end``; the number of ids of each text."""
        plain = self._plain(texts)
        words = find_words([t if p else b"" for t, p in zip(texts, plain)], lower=True)
        order = np.argsort(words.hashes)
        ordered = words.hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        at, which = order[new], np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        flat, begin, size = self._coded(words.hashes[at], words, at)
        sizes = size[which]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.arange(before[-1]) + np.repeat(begin[which] - before[:-1], sizes)]
        counts = np.diff(before[words.first])
        borders = before[words.first]
        out, lengths = [], counts + 1
        if all(plain):
            out = np.insert(ids, borders[1:], np.uint32(end))
            return out, lengths
        for i, text in enumerate(texts):
            if plain[i]:
                own = ids[borders[i]:borders[i + 1]]
            else:
                own = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
            out += [own, np.array([end], np.uint32)]
            lengths[i] = len(own) + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint32), lengths


def encoder(path: str) -> WordEncoder:
    return kept(f"tokenizer {path}", lambda: WordEncoder(path))
