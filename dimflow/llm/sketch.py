"""A number that most near copies of a text share."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from dimflow.llm.words import chunks, find_words, give_back, mix

SKETCH_WORDS = 4


def _sketch(texts: pd.Series) -> pd.Series:
    out = []
    for _, part in chunks(pa.array(texts, pa.string())):
        words = find_words(part)
        for a, b in zip(words.first[:-1], words.first[1:]):
            own, key = words.hashes[a:b], np.uint64(0)
            for k in range(SKETCH_WORDS if b > a else 0):
                key = mix(np.array([key ^ mix(own + np.uint64(k)).min()]))[0]
            out.append(int(key.view(np.int64)))
    give_back()
    return pd.Series(out, dtype="int64")


def sketch(text: str) -> Column:
    """Its words with the smallest hashes, of a few kinds, as one number."""
    return F.pandas_udf(_sketch, "long")(text)
