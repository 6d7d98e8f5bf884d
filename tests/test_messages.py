"""Conversations against a sequential fold."""

import random

import pytest

from dimflow.functions import replies
from dimflow.operators import contacts as people
from dimflow.operators import facts, messages
from dimflow.streaming.sessions import message_stream, session_state_stream, write_sessions
from tests.conftest import rows

CHILDREN = {"+0": 0, "+1": 1, "+2": 2, "+3": 3, "+4": 3}
INTENTS = ["summary", "summary", "grades", "homework", "attendance", "fee", "greeting", "nonsense"]
BODIES = ["1", "2", "3", "9", "0", "77777777777777777777", " How to IMPROVE ", "please improve", "hello", "12 monkeys", ""]


def talk(seed, n):
    rand = random.Random(seed)
    # one sender holds most of the messages
    who = [rand.choice(["+4", "+4", "+4", "+4", *CHILDREN]) for _ in range(n)]
    return [("whatsapp:" + w, i, rand.choice(BODIES), f'{{"intent": "{rand.choice(INTENTS)}"}}') for i, w in enumerate(who)]


def fold(data):
    """(sender, seq, turn, child, after_summary, intent) one message after the other."""
    sessions, out = {}, []
    for sender, seq, body, reply in sorted(data, key=lambda r: r[1]):
        n = CHILDREN[sender.removeprefix("whatsapp:")]
        body, child, last = body.strip().lower(), *sessions.get(sender, (None, None))
        turn, shown, intent = "ask", child or 1, reply.split('"')[3]
        intent = intent if intent != "nonsense" else "unknown"
        if n == 0:
            turn = "unregistered"
        elif body.isdigit() and n > 1:
            turn = "select" if 1 <= int(body) <= n else "menu"
        elif n > 1 and child is None:
            turn = "menu"
        after = last == "summary"
        if turn == "select":
            shown = int(body)
            sessions[sender] = (shown, None)
        elif turn == "ask":
            if intent == "summary":
                sessions[sender] = (child, "summary")
            if after and "improve" in body:
                intent = "improvement_plan"
        out.append((sender, seq, turn, shown if turn in ("ask", "select") else None, after, intent if turn == "ask" else None))
    return sorted(map(str, out))


def messages_of(spark, data):
    return spark.createDataFrame(data, "from_number STRING, seq BIGINT, body STRING, model_reply STRING")


@pytest.fixture(scope="module")
def contacts(spark):
    found = [(f"p{p}", f"Parent {p}", p, f"s{p}{i}", f"Kid {i}", "5", "B") for p, n in CHILDREN.items() for i in range(1, n + 1)]
    return spark.createDataFrame(found, "parent_id STRING, parent_name STRING, whatsapp_number STRING, student_id STRING, "
                                        "student_name STRING, grade STRING, section STRING")


@pytest.mark.parametrize("limit", [10, 10_000])
def test_session_state(spark, contacts, limit):
    data = talk(limit, 250)
    found = messages.session_state(messages_of(spark, data), contacts, limit)
    assert sorted(map(str, rows(found))) == fold(data)


def test_session_stream_goes_on_after_a_restart(spark, contacts, tmp_path):
    data = talk(3, 120)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for start in (0, 40, 80):  # three runs of the stream, each finding one more file
        messages_of(spark, data[start:start + 40]).coalesce(1).write.mode("append").parquet(source)
        stream = message_stream(spark, source, "from_number STRING, seq BIGINT, body STRING, model_reply STRING", 100)
        write_sessions(session_state_stream(stream, contacts), out, checkpoint)
    assert sorted(map(str, rows(spark.read.parquet(out)))) == fold(data)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_menu(spark, contacts):
    menus = {r.whatsapp_number: (r.part, r.menu) for r in people.menu_text(contacts).collect()}
    assert menus == {"+2": (1, "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)"),
                     "+3": (1, "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)\n3. Kid 3 (5-B)"),
                     "+4": (1, "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)\n3. Kid 3 (5-B)")}
    parts = sorted(tuple(r) for r in people.menu_text(contacts, 2, 2).filter("whatsapp_number = '+3'").collect())
    assert parts == [("+3", 1, "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)"), ("+3", 2, "3. Kid 3 (5-B)")]


def school(spark):
    students = spark.createDataFrame([("s+11",), ("s+21",), ("s+22",)], "student_id STRING")
    attendance = spark.createDataFrame(
        [("s+11", d, s) for d, s in (("2024-03-01", "Present"), ("2024-03-08", "Present"), ("2024-03-09", "Absent"),
                                     ("2024-03-20", "Present"), ("2024-02-29", "Absent"))] + [("s+21", "2024-01-01", "Present")],
        "student_id STRING, day STRING, status STRING").selectExpr("student_id", "CAST(day AS DATE) AS attendance_date", "status")
    homework = spark.createDataFrame(
        [("s+11", "2024-03-08", "Maths", "Done"), ("s+11", "2024-03-08", "Art", "Open"), ("s+11", "2024-03-07", "Music", "Done")],
        "student_id STRING, day STRING, subject STRING, status STRING").selectExpr(
        "student_id", "CAST(day AS DATE) AS homework_date", "subject", "status")
    grades = spark.createDataFrame([("s+11", "Maths", 38, 50), ("s+22", "Art", 9, 10), ("s+22", "Art", 9, 10)],
                                   "student_id STRING, subject STRING, score INT, max_score INT")
    return students, attendance, homework, grades


def test_digest(spark):
    found = {r.student_id: r for r in facts.weekly_digest(*school(spark), "2024-03-08").collect()}
    # days since the first of March, the future included: three of four
    assert found["s+11"].body == "Attendance: 75.0%\n- Art: Open\n- Maths: Done\n- Maths: 38/50"
    assert found["s+21"].body == f"Attendance: 0.0%\n{replies.NO_HOMEWORK}\n{replies.NO_GRADES}"
    assert found["s+22"].grades == "- Art: 9/10\n- Art: 9/10" and len(found) == 3
    parts = sorted((r.part, r.body) for r in facts.weekly_digest(*school(spark), "2024-03-08", limit=1, lines_per_part=1)
                   .filter("student_id = 's+11'").collect())
    assert parts == [(1, "Attendance: 75.0%\n- Art: Open"), (2, "- Maths: Done\n- Maths: 38/50")]
    assert "\n".join(body for _, body in parts) == found["s+11"].body


def test_null_fields_are_told(spark):
    students, attendance, homework, grades = school(spark)
    grades = grades.unionByName(spark.createDataFrame([("s+21", "Maths", None, 100)], grades.schema))
    homework = homework.unionByName(homework.filter("subject = 'Music'").selectExpr(
        "'s+22' AS student_id", "DATE '2024-03-08' AS homework_date", "subject", "CAST(NULL AS STRING) AS status"))
    found = {r.student_id: r for r in facts.weekly_digest(students, attendance, homework, grades, "2024-03-08").collect()}
    assert found["s+21"].grades == "- Maths: None/100" and found["s+22"].homework == "- Music: None" and len(found) == 3


def test_rounding_is_half_even(spark):
    students = spark.createDataFrame([("a",)], "student_id STRING")
    days = spark.createDataFrame([("a", "Present" if i == 0 else "Absent") for i in range(32)], "student_id STRING, status STRING")
    days = days.selectExpr("student_id", "DATE '2024-03-08' AS attendance_date", "status")
    assert facts.attendance_pct(students, days, "2024-03-08").first().attendance_pct == round(100 / 32, 2) == 3.12


def test_replies(spark, contacts):
    asks = [("whatsapp:+0", 0, "hi", "x"), ("whatsapp:+1", 1, "hi", "greeting"), ("+1", 2, "so?", "attendance"),
            ("+1", 3, "so?", "homework"), ("+1", 4, "so?", "grades"), ("+1", 5, "so?", "summary"), ("+1", 6, "improve", "fee"),
            ("+1", 7, "fee?", "fee"), ("+2", 8, "hi", "greeting"), ("+2", 9, "2", "x"), ("+2", 10, "so?", "grades"),
            ("+2", 11, "so?", "homework"), ("+2", 12, "5", "x"), ("+3", 13, "3", "x"), ("+3", 14, "so?", "grades")]
    data = messages_of(spark, [(a, b, c, f'{{"intent": "{d}"}}') for a, b, c, d in asks])
    digest = facts.weekly_digest(*school(spark), "2024-03-08")
    expected = {
        0: replies.NOT_REGISTERED, 1: replies.GREETING, 2: "📊 Attendance this week: 75.0%", 3: "- Art: Open\n- Maths: Done",
        4: "- Maths: 38/50", 5: replies.SUMMARY_STARTED, 6: replies.PLAN_STARTED, 7: replies.HELP,
        8: "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)", 9: "✅ Selected Kid 2. How can I help?",
        10: "- Art: 9/10\n- Art: 9/10", 11: replies.NO_HOMEWORK, 12: "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)",
        13: "✅ Selected Kid 3. How can I help?", 14: replies.NO_GRADES}
    found = messages.route_reply(messages.session_state(data, contacts), people.number_children(contacts), digest,
                                 people.menu_text(contacts)).collect()
    assert {r.seq: r.reply for r in found} == expected and len(found) == len(expected)


def test_replies_in_parts(spark, contacts):
    data = messages_of(spark, [("+1", i, "so?", f'{{"intent": "{t}"}}') for i, t in enumerate(("homework", "grades", "attendance"))]
                       + [("+3", 9, "hi", '{"intent": "fee"}')])
    digest = facts.weekly_digest(*school(spark), "2024-03-08", limit=1, lines_per_part=1)
    found = messages.route_reply(messages.session_state(data, contacts), people.number_children(contacts), digest,
                                 people.menu_text(contacts, 2, 2))
    assert rows(found.select("seq", "part", "reply")) == [
        (0, 1, "- Art: Open"), (0, 2, "- Maths: Done"), (1, 1, "- Maths: 38/50"),
        (2, 1, "📊 Attendance this week: 75.0%"),
        (9, 1, "You have multiple children:\n1. Kid 1 (5-B)\n2. Kid 2 (5-B)"), (9, 2, "3. Kid 3 (5-B)")]


def test_contacts_keep_repeated_links(spark):
    parents = spark.createDataFrame([("p1", "A", "+1"), ("p2", "B", "+2")], "parent_id STRING, parent_name STRING, phone_number STRING")
    links = spark.createDataFrame([("p1", "s1"), ("p1", "s1"), ("p2", "s1"), ("p9", "s1")], "parent_id STRING, student_id STRING")
    students = spark.createDataFrame([("s1", "Kid", "5", "B")], "student_id STRING, student_name STRING, grade STRING, section STRING")
    assert people.contacts(parents, links, students).count() == 3
    assert people.contacts(parents, links, students, "whatsapp:+2").first().parent_name == "B"


def test_daily_digests_are_the_digests_of_each_date(spark):
    rand = random.Random(6)
    dates = [f"2024-03-{d:02}" for d in range(1, 13)]
    students = spark.createDataFrame([(f"s{i}",) for i in range(6)], "student_id STRING")
    day = lambda: rand.choice([*dates, None])
    who = lambda: rand.choice(["s0", "s0", "s1", "s2", "s3", "s9"])
    attendance = spark.createDataFrame([(who(), day(), rand.choice(["Present", "Absent", None])) for _ in range(150)],
                                       "student_id STRING, attendance_date STRING, status STRING")
    homework = spark.createDataFrame([(who(), day(), f"m{i}", rand.choice(["done", None])) for i in range(150)],
                                     "student_id STRING, homework_date STRING, subject STRING, status STRING")
    grades = spark.createDataFrame([(who(), f"m{i}", i, 9) for i in range(20)], "student_id STRING, subject STRING, score INT, max_score INT")
    attendance = attendance.withColumn("attendance_date", attendance.attendance_date.cast("date"))
    homework = homework.withColumn("homework_date", homework.homework_date.cast("date"))
    wanted = dates[3:9]
    for per_part, some in ((2, wanted[::3]), (100, wanted[2:3])):
        found = facts.weekly_digest_daily(students, facts.attendance_by_day(attendance), homework, grades, wanted, 3, lines_per_part=per_part)
        assert found.select("date").distinct().count() == len(wanted)
        for d in some:
            plain = facts.weekly_digest(students, attendance, homework, grades, d, 3, lines_per_part=per_part)
            assert rows(found.filter(found.date == d).drop("date").select(*plain.columns)) == rows(plain)


def test_daily_digests_shuffle_nothing_once_for_each_date(spark):
    students, attendance, homework, grades = school(spark)
    found = facts.weekly_digest_daily(students, facts.attendance_by_day(attendance), homework, grades, ["2024-03-08", "2024-03-07"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate ") < plan.index("Exchange ")
    assert found.count() == 6
    told = {(r.student_id, str(r.date)): r for r in found.collect()}
    assert told["s+11", "2024-03-07"].body == "Attendance: 60.0%\n- Music: Done\n- Maths: 38/50"


def test_follow_ups_make_digests_only_of_students_asked_about(spark, tmp_path, monkeypatch):
    from checks import school as check

    told = {"conversations": ([(1, 0, "user", "abc"), (1, 1, "user", "abc"), (2, 0, "user", "ab")],
                              "conv_id BIGINT, turn BIGINT, role STRING, text STRING"),
            "labels": ([(9,)], "doc_id BIGINT"),
            "part": ([(i, f"n{i}", 5, "B") for i in range(1, 9)], "p_partkey BIGINT, p_name STRING, p_size INT, p_brand STRING"),
            "lineitem": ([(1, 4, "A", 1, 7.0), (1, 5, "A", 1, 8.0)],
                         "l_suppkey BIGINT, l_partkey BIGINT, l_returnflag STRING, l_linenumber INT, l_quantity DOUBLE")}
    for name, (own, schema) in told.items():
        spark.createDataFrame(own, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.sql("SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-01-30 01:00:00' AS ts, 4L AS user_id, 'view' AS event_type, 'p' AS props"
              ).write.parquet(str(tmp_path / "events.parquet"))
    made, plain = [], facts.weekly_digest
    monkeypatch.setattr(facts, "weekly_digest", lambda s, *a, **k: made.append(rows(s.select("student_id"))) or plain(s, *a, **k))
    found = rows(check.summary_messages(spark, str(tmp_path)))
    assert found == [("whatsapp:+1001", 0, 1, 1, "abc abc abc "),
                     ("whatsapp:+1001", 1, 1, 1, "Attendance: 100.0%\n- view: p\n- A: 7/50")]
    assert rows(check.plan_messages(spark, str(tmp_path))) == []
    assert made == [[("4",)], []]
