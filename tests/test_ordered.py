"""Streams whose rows come in any order, against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from dimflow.operators import messages, scd
from dimflow.streaming import history, sessions
from dimflow.streaming.ordered import packed, unpacked
from tests.conftest import rows

MESSAGES = "from_number STRING, seq BIGINT, body STRING, model_reply STRING"
CONTACTS = "whatsapp_number STRING, student_id STRING"
MARK = (None, None, None, None)


def talk(seed, n=160):
    rand = random.Random(seed)
    bodies = ["1", "2", "9", "0", "How to improve?", "hello", "marks please", None]
    intents = ["summary", "grades", "homework", "attendance"]
    return [(rand.choice(["whatsapp:+1", "whatsapp:+2", "whatsapp:+3", "+4"]), i, rand.choice(bodies),
             f'{{"intent": "{rand.choice(intents)}"}}') for i in range(n)]


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame([("+1", "a"), ("+2", "b"), ("+2", "c"), ("+4", "d"), ("+4", "e")], CONTACTS)


def run_sessions(spark, contacts, folder, out, delay, bucket_ms):
    stream = sessions.message_stream(spark, folder, f"{MESSAGES}, at TIMESTAMP", max_bytes=1)
    states = sessions.session_state_ordered(stream, contacts, F.col("at"), delay, F.col("seq").isNull(), bucket_ms)
    sessions.write_sessions(states, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(f"{sessions.OUTPUT}, late BOOLEAN").parquet(f"{out}/rows")


def add_file(spark, folder, batch, at=None):
    """A file of messages at ``seq`` minutes, or of a mark at ``at`` minutes."""
    timed = [(*m, m[1] * 60 if at is None else at * 60) for m in batch]
    df = spark.createDataFrame(timed, f"{MESSAGES}, s BIGINT").withColumn("at", F.timestamp_seconds("s")).drop("s")
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("seed,bucket_ms", [(1, 60_000), (2, 600_000), (3, 86_400_000)])
def test_shuffled_messages_meet_the_states_of_the_batch(spark, contacts, tmp_path, seed, bucket_ms):
    told, folder = talk(seed), str(tmp_path / "in")
    shuffled = list(told)
    random.Random(seed).shuffle(shuffled)
    for part in range(3):
        add_file(spark, folder, shuffled[part::3])
    first = run_sessions(spark, contacts, folder, tmp_path, "1 day", bucket_ms)
    assert first.count() == 0  # all may still come before another
    add_file(spark, folder, [MARK], 100_000)
    found = run_sessions(spark, contacts, folder, tmp_path, "1 day", bucket_ms)
    want = messages.session_state(spark.createDataFrame(told, MESSAGES), contacts)
    assert rows(found.filter("NOT late").drop("late")) == rows(want)
    assert found.filter("late").count() == 0


def test_messages_behind_the_watermark_are_given_out_as_late(spark, contacts, tmp_path):
    told, folder = talk(9), str(tmp_path / "in")
    early, gone, rest = told[:60], told[30:35], told[60:]
    add_file(spark, folder, [m for m in early if m not in gone])
    add_file(spark, folder, rest[:20])
    add_file(spark, folder, [MARK], 80)  # the watermark comes to minute 70
    add_file(spark, folder, gone + rest[20:])
    add_file(spark, folder, [MARK], 100_000)
    found = run_sessions(spark, contacts, folder, tmp_path, "10 minutes", 60_000)
    assert rows(found.filter("late").select("seq")) == [(m[1],) for m in gone]
    assert found.filter("late AND turn IS NOT NULL").count() == 0
    want = messages.session_state(spark.createDataFrame([m for m in told if m not in gone], MESSAGES), contacts)
    assert rows(found.filter("NOT late").drop("late")) == rows(want)


LOG = "id BIGINT, a STRING, b BIGINT, ts TIMESTAMP_NTZ, nr BIGINT"


def changes(seed, n=300):
    rand = random.Random(seed)
    big = 2**53 + 1
    return [(rand.choice([1, 2, 2, 2, None]), rand.choice(["x", "y", None]), rand.choice([big, None]), 60 * (i // 2), i) for i in range(n)]


def log_frame(spark, log):
    df = spark.createDataFrame(log, "id BIGINT, a STRING, b BIGINT, s BIGINT, nr BIGINT")
    return df.select("id", "a", "b", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "nr")


@pytest.mark.parametrize("bucket_ms", [60_000, 86_400_000])
def test_history_over_restarts_equals_the_batch(spark, tmp_path, bucket_ms):
    log, folder, out = changes(4), str(tmp_path / "log"), str(tmp_path / "out")
    keys, tracked, order = ["id"], ["a", "b"], ["ts", "nr"]

    def run():
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder)
        versions = history.history_stream(stream, keys, tracked, order, "30 minutes", F.col("nr").isNull(), bucket_ms)
        history.write_history(versions, out, str(tmp_path / "checkpoint"))
        return spark.read.parquet(out)

    for start in range(0, len(log), 100):  # order within 100 rows, some 50 minutes, is lost, within the delay
        part = log[start:start + 40] + log[start + 60:start + 100]
        random.Random(start).shuffle(part)
        log_frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
        log_frame(spark, log[start + 40:start + 60]).coalesce(1).write.mode("append").parquet(folder)
        run()  # a restart after every two files
    log_frame(spark, [(None, None, None, 10**8, None)]).coalesce(1).write.mode("append").parquet(folder)
    found = history.history_of(run(), keys, tracked, order)
    assert rows(found) == rows(scd.scd2_from_log(log_frame(spark, log), keys, tracked, order))
    log_frame(spark, [(2, "late", 1, 60, 10_000)]).coalesce(1).write.mode("append").parquet(folder)
    written = run()
    assert rows(written.filter("late = true").select("id", "a", "nr")) == [(2, "late", 10_000)]
    assert rows(history.history_of(written, keys, tracked, order)) == rows(found)


def test_rows_survive_packing():
    import pandas as pd

    frame = pd.DataFrame({"a": ["x", None], "n": pd.Series([2**60, None], dtype=object), "t": pd.to_datetime(["2024-01-01", None])})
    back = unpacked(packed(frame))
    assert back["n"].tolist() == [2**60, None] and back["a"].tolist() == ["x", None] and back["t"].isna().tolist() == [False, True]


def test_turns_of_many_senders_at_once_are_those_of_one_after_the_other():
    import pandas as pd

    from tests.test_messages import CHILDREN, INTENTS, fold
    from tests.test_messages import talk as told

    def prepared(sender, seq, body, reply):
        text, children, intent = body.strip().lower(), CHILDREN[sender.removeprefix("whatsapp:")], reply.split('"')[3]
        pick = None if not text.isdigit() or children < 2 else int(text) if 1 <= int(text) <= children else 0
        return sender, seq, text, children, intent if intent != INTENTS[-1] else "unknown", pick, sender

    data, kept, found = told(5, 300), None, []
    for half in (data[:170], data[170:]):
        talk = pd.DataFrame([prepared(*m) for m in half], columns=["from_number", "seq", "text", "children", "intent", "pick", "_key"])
        turns, kept = sessions._turns(kept, talk)
        found += [(a, b, c, None if pd.isna(d) else int(d), e, None if pd.isna(f) else f) for a, b, c, d, e, f in turns.itertuples(index=False)]
        kept = unpacked(packed(kept))
    assert sorted(map(str, found)) == fold(data) and len(kept) == len(CHILDREN)


def test_versions_of_many_keys_at_once():
    import pandas as pd

    taker = history.HistoryProcessor(["_c0", "_c1"], "_c1", [], 60_000)
    frame = lambda *r: pd.DataFrame(r, columns=["_key", "_c0", "_c1", "_state"])
    _, kept = taker.take(None, frame(("a", "x", "1", "x"), ("b", None, "1", "n"), ("a", "x", "2", "x"), ("c", "z", "3", "z")))
    told, kept = taker.take(unpacked(packed(kept)), frame(("b", None, "5", "n"), ("a", "y", "5", "y"), ("d", "x", "6", "x"), ("a", "x", "7", "x")))
    assert sorted(map(str, told[["_c0", "_c1", "_end"]].itertuples(index=False, name=None))) == [
        "('x', '1', '5')", "('x', '6', None)", "('x', '7', None)", "('y', '5', '7')", "('y', '5', None)"]
    assert sorted(kept["_key"]) == ["a", "b", "c", "d"] and sorted(kept["_c1"]) == ["1", "3", "6", "7"]


def test_a_missing_key_is_a_key_of_its_own(spark):
    from dimflow.streaming.ordered import dealt

    known = spark.createDataFrame([(None, None), (0, None), (0, ""), (None, "null"), (None, None)], "a BIGINT, b STRING")
    found = dealt(known, ["a", "b"], 3).collect()
    assert len({r["_key"] for r in found}) == 4 and all(r["_key"] is not None and 0 <= r["_group"] < 3 for r in found)
