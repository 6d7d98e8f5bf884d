"""Bloom filters as tables: a row per word of 64 bits, made by aggregation and probed by a broadcast join.

A key sets a few bits of one word, so a probe is one lookup. Filters of parts of a set with the same number of words are merged
by OR, which is also how tasks combine theirs before the shuffle. A filter of ``MOST_WORDS`` words is some tens of MB in an
executor, which bounds what is broadcast; beyond some 10 keys a word it settles less, and never wrongly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_WORD, BITS_PER_KEY = 5, 4
MOST_WORDS = 1 << 20
_WORD, _BITS = "_word", "_bits"


def words_for(keys: int) -> int:
    """A power of two, as many as the keys ask for and the bound allows."""
    return min(MOST_WORDS, 1 << max(0, (keys // KEYS_PER_WORD).bit_length()))


def _place(key: str, words: int) -> tuple[Column, Column]:
    """(word, bits in it) of a key."""
    h = F.xxhash64(F.lit(1), F.col(key))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, 6 * i) % 64).cast("int"))
            for i in range(BITS_PER_KEY)]
    return F.pmod(F.xxhash64(F.lit(2), F.col(key)), F.lit(words)), reduce(lambda a, b: a.bitwiseOR(b), bits)


def built(df: DataFrame, key: str, keys: int) -> DataFrame:
    """``_word, _bits, _words``: the filter of the values of ``key`` that are not NULL, sized for some number of them."""
    words = words_for(keys)
    word, bits = _place(key, words)
    return merged(df.filter(F.col(key).isNotNull()).select(word.alias(_WORD), bits.alias(_BITS), F.lit(words).alias("_words")))


def merged(filters: DataFrame) -> DataFrame:
    """One filter from the rows of several of the same size."""
    return filters.groupBy(_WORD, "_words").agg(F.bit_or(_BITS).alias(_BITS))


def probed(df: DataFrame, filter_: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with ``name``: false where ``key`` is surely none of the filter's values, NULL included. Rows are not shuffled."""
    first = filter_.first()
    if first is None:
        return df.withColumn(name, F.lit(False))
    word, bits = _place(key, first["_words"])
    known = df.withColumn("_at", word).withColumn("_own", bits).join(
        F.broadcast(filter_.select(F.col(_WORD).alias("_at"), _BITS)), "_at", "left")
    held = F.col(key).isNotNull() & F.col(_BITS).isNotNull() & (F.col(_BITS).bitwiseAND(F.col("_own")) == F.col("_own"))
    return known.select(*df.columns, F.coalesce(held, F.lit(False)).alias(name))
