import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from dimflow.llm import perfect_hash
from tests.llm.data import documents, empty, frame


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        digests = rng.integers(0, 2**63, (n, 4)).astype(np.uint64)
        assert sorted(perfect_hash.slots(perfect_hash.build(digests), digests).tolist()) == list(range(n))


def test_groups_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(perfect_hash, "SHARD_DIGESTS", 7)
    rows = documents()
    digest = lambda t: hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest()
    members = {}
    for r in rows:
        members.setdefault(digest(r[1]), []).append(r[0])
    first = {d: min((i for i in ids if i is not None), default=None) for d, ids in members.items()}
    want = sorted(str((r[0], first[d], len(members[d]), r[0] == first[d], d)) for r in rows for d in [digest(r[1])])
    for old in (F.lit(False), F.lit(True), F.col("doc_id") > 80, F.col("doc_id") < 30):
        found = perfect_hash.exact_duplicates(frame(spark, rows), old)
        assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(str(tuple(r)) for r in found.collect()) == want


def test_little_history_and_many_new_digests(spark, monkeypatch):
    """Three rows of history: the lookups still go to as many groups as the new digests need."""
    monkeypatch.setattr(perfect_hash, "SHARD_DIGESTS", 100)
    asked, look_up = [], perfect_hash.look_up
    monkeypatch.setattr(perfect_hash, "look_up", lambda *a: asked.append(a[2]) or look_up(*a))
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 4000).alias("text"))
    found = perfect_hash.exact_duplicates(docs, F.col("doc_id") < 3)
    assert asked == [40]
    assert found.filter("keep_id = doc_id % 4000 AND kept = (doc_id < 4000)").count() == 5000


def test_empty_table(spark):
    assert perfect_hash.exact_duplicates(empty(spark), F.lit(True)).count() == 0
