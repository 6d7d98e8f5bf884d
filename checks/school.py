"""Contacts, facts, digests and conversations.

Suppliers stand for parents, parts for students and lineitem for the map between them; events are attendance and
homework, lineitem the grades, conversations the messages.
"""

from pyspark.sql import functions as F

from checks.base import Checks, table
from dimflow.functions import intents, text
from dimflow.operators import contacts as people
from dimflow.operators import facts, messages
from dimflow.operators.skew import join_skewed
from dimflow.sources.storage import checkpointed

CHECKS = Checks()

DAY = "2024-01-30"

# Both engines run the same mapping of the tables; the operators and their oracles differ
_PARENTS = ("SELECT CAST(s_suppkey AS STRING) AS parent_id, s_name AS parent_name, "
            "concat('+', CAST(1000 + s_suppkey AS STRING)) AS phone_number FROM {supplier}")
_MAP = "SELECT CAST(l_suppkey AS STRING) AS parent_id, CAST(l_partkey AS STRING) AS student_id FROM {lineitem}"
_STUDENTS = ("SELECT CAST(p_partkey AS STRING) AS student_id, CASE WHEN p_partkey % 31 <> 0 THEN p_name END AS student_name, "
             "CAST(p_size AS STRING) AS grade, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS section FROM {part}")
_ATTENDANCE = ("SELECT CAST(user_id AS STRING) AS student_id, CAST(ts AS DATE) AS attendance_date, "
               "CASE WHEN event_type = 'view' THEN 'Present' ELSE 'Absent' END AS status FROM {events}")
_HOMEWORK = ("SELECT CAST(user_id AS STRING) AS student_id, CAST(ts AS DATE) AS homework_date, event_type AS subject, "
             "CASE WHEN event_id % 7 <> 0 THEN props END AS status, event_id FROM {events}")
_GRADES = ("SELECT CAST(l_partkey AS STRING) AS student_id, l_returnflag AS subject, "
           "CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS INT) END AS score, 50 AS max_score FROM {lineitem}")
# a conversation is a sender, registered unless its number is a labelled document's, with a child per role that speaks
_FAMILIES = ("SELECT DISTINCT CAST(conv_id AS STRING) AS parent_id, concat('Parent ', CAST(conv_id AS STRING)) AS parent_name, "
             "concat('+', CAST(1000 + conv_id AS STRING)) AS phone_number FROM {conversations} "
             "WHERE NOT EXISTS (SELECT 1 FROM {labels} WHERE doc_id = conv_id)")
_LINKS = ("SELECT DISTINCT CAST(conv_id AS STRING) AS parent_id, CAST(conv_id * 3 + CASE role WHEN 'system' THEN 0 "
          "WHEN 'user' THEN 1 ELSE 2 END AS STRING) AS student_id FROM {conversations}")
_MESSAGES = """
SELECT concat('whatsapp:+', CAST(1000 + conv_id AS STRING)) AS from_number, turn AS seq,
       CASE WHEN turn % 3 = 1 AND conv_id % 5 <> 0 THEN CAST(length(text) % 5 AS STRING)
            WHEN turn % 4 = 3 THEN concat(text, ' How to IMPROVE?') ELSE text END AS body,
       concat('{{"intent": "', CASE WHEN length(text) % 3 = 0 THEN 'summary' ELSE CASE length(text) % 8
            WHEN 0 THEN 'attendance' WHEN 1 THEN 'homework' WHEN 2 THEN 'grades' WHEN 3 THEN 'fee' WHEN 4 THEN 'greeting'
            WHEN 5 THEN 'unknown' WHEN 6 THEN 'weather' ELSE 'summary' END END, '"}}') AS model_reply
FROM {conversations}"""
_NAMES = ("supplier", "lineitem", "part", "events", "conversations", "labels")


def _read(spark, sf_dir, query):
    return spark.sql(query, **{n: table(spark, sf_dir, n) for n in _NAMES if "{" + n + "}" in query})


def _sql(query):
    return "(" + query.format(**{n: n for n in _NAMES}) + ")"


_CONTACTS = """
SELECT p.parent_id, p.parent_name, p.phone_number AS whatsapp_number, s.student_id, s.student_name, s.grade, s.section
FROM {0} p JOIN {1} m ON p.parent_id = m.parent_id JOIN {2} s ON m.student_id = s.student_id"""
_SCHOOL = _CONTACTS.format(_sql(_PARENTS), _sql(_MAP), _sql(_STUDENTS))


def _contacts(spark, sf_dir, phone=None):
    return people.contacts(*(_read(spark, sf_dir, q) for q in (_PARENTS, _MAP, _STUDENTS)), phone)


@CHECKS.add(_SCHOOL)
def contacts_join(spark, sf_dir):
    return _contacts(spark, sf_dir)


@CHECKS.add(_SCHOOL + " WHERE p.phone_number = '+1007'")
def contacts_lookup(spark, sf_dir):
    return _contacts(spark, sf_dir, "whatsapp:+1007")


_MENU = """
SELECT whatsapp_number, CAST(1 AS BIGINT) AS part, 'You have multiple children:' || chr(10) ||
       string_agg(nr || '. ' || coalesce(student_name, 'None') || ' (' || grade || '-' || coalesce(section, 'None') || ')',
                  chr(10) ORDER BY nr) AS menu
FROM (SELECT *, row_number() OVER (PARTITION BY whatsapp_number ORDER BY student_id) AS nr FROM ({0}))
GROUP BY whatsapp_number HAVING count(*) > 1"""


@CHECKS.add(_MENU.format(_SCHOOL))
def menu_text(spark, sf_dir):
    return people.menu_text(_contacts(spark, sf_dir))


_ATT = f"""
SELECT s.student_id, coalesce(CAST(round_even(count(*) FILTER (WHERE status = 'Present') * 100.0
       / nullif(count(status), 0), 2) AS DOUBLE), 0.0) AS attendance_pct
FROM {_sql(_STUDENTS)} s LEFT JOIN (SELECT * FROM {_sql(_ATTENDANCE)}
     WHERE attendance_date >= DATE '{DAY}' - 7) a ON s.student_id = a.student_id GROUP BY s.student_id"""
_HW = f"""
SELECT s.student_id, CAST(1 AS BIGINT) AS part, coalesce(string_agg(CASE WHEN event_id IS NOT NULL
       THEN '- ' || subject || ': ' || coalesce(status, 'None') END, chr(10) ORDER BY event_id),
       '📘 No homework assigned today.') AS homework
FROM {_sql(_STUDENTS)} s LEFT JOIN (SELECT * FROM {_sql(_HOMEWORK)} WHERE homework_date = DATE '{DAY}') h
     ON s.student_id = h.student_id GROUP BY s.student_id"""
_GR = f"""
SELECT s.student_id, CAST(1 AS BIGINT) AS part, coalesce(string_agg(line, chr(10) ORDER BY line), '📊 No grades available.') AS grades
FROM {_sql(_STUDENTS)} s LEFT JOIN (SELECT student_id, '- ' || subject || ': ' || coalesce(CAST(score AS VARCHAR), 'None') || '/' || max_score AS line
     FROM {_sql(_GRADES)}) g ON s.student_id = g.student_id GROUP BY s.student_id"""
_DIGEST = f"""
SELECT student_id, part, attendance_pct, homework, grades,
       'Attendance: ' || attendance_pct || '%' || chr(10) || homework || chr(10) || grades AS body
FROM ({_ATT}) JOIN ({_HW}) USING (student_id) JOIN ({_GR}) USING (student_id, part)"""


def _facts(spark, sf_dir, *queries):
    return [_read(spark, sf_dir, q) for q in (_STUDENTS, *queries)]


@CHECKS.add(_ATT)
def attendance_pct(spark, sf_dir):
    return facts.attendance_pct(*_facts(spark, sf_dir, _ATTENDANCE), DAY)


@CHECKS.add(_HW)
def homework_text(spark, sf_dir):
    return facts.homework_text(*_facts(spark, sf_dir, _HOMEWORK), DAY, ("event_id",), unique=True)


@CHECKS.add(_GR)
def grades_text(spark, sf_dir):
    return facts.grades_text(*_facts(spark, sf_dir, _GRADES))


def _digest(spark, sf_dir, who=None):
    """The digests of all students, or of those of ``who`` only, to which all tables are brought down first."""
    tables = _facts(spark, sf_dir, _ATTENDANCE, _HOMEWORK, _GRADES)
    if who is not None:
        asked = checkpointed(who.select("student_id").distinct())
        tables = [checkpointed(join_skewed(t, asked, ["student_id"], "left_semi")) for t in tables]
    return facts.weekly_digest(*tables, DAY, homework_order=("event_id",), unique=True)


@CHECKS.add(_DIGEST)
def weekly_digest(spark, sf_dir):
    return _digest(spark, sf_dir)


@CHECKS.add(f"SELECT student_id, body FROM ({_DIGEST})")
def weekly_digest_parts(spark, sf_dir):
    """Parts of two lines, put together again: the same messages as whole ones."""
    parts = facts.weekly_digest(*_facts(spark, sf_dir, _ATTENDANCE, _HOMEWORK, _GRADES), DAY, homework_order=("event_id",),
                                unique=True, lines_per_part=2)
    return parts.groupBy("student_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "body"))), lambda p: p["body"]), "\n").alias("body"))


_DATES = [f"2024-01-{d:02}" for d in range(1, 31)]


@CHECKS.add(" UNION ALL ".join(f"SELECT DATE '{d}' AS date, * FROM ({_DIGEST.replace(DAY, d)})" for d in _DATES))
def weekly_digest_daily(spark, sf_dir):
    """The digests of thirty dates in one pass, the attendance from two deliveries."""
    students, attendance, homework, grades = _facts(spark, sf_dir, _ATTENDANCE, _HOMEWORK, _GRADES)
    first = F.col("attendance_date") < "2024-01-11"
    by_day = facts.merged_days(facts.attendance_by_day(attendance.filter(first)), facts.attendance_by_day(attendance.filter(~first)))
    return facts.weekly_digest_daily(students, by_day, homework, grades, _DATES, homework_order=("event_id",), unique=True)


_PLAIN = """
SELECT m.*, coalesce(n.children, 0) AS children, trim(lower(m.body)) AS text,
       CASE WHEN json_extract_string(model_reply, '$.intent') IN ('attendance', 'homework', 'grades', 'summary', 'fee',
            'greeting', 'unknown') THEN json_extract_string(model_reply, '$.intent') ELSE 'unknown' END AS label
FROM {0} m LEFT JOIN (SELECT whatsapp_number, count(*) AS children FROM ({1}) GROUP BY 1) n
     ON n.whatsapp_number = replace(m.from_number, 'whatsapp:', '')""".format(
    _sql(_MESSAGES), _CONTACTS.format(_sql(_FAMILIES), _sql(_LINKS), _sql(_STUDENTS)))
_BEFORE = "(PARTITION BY from_number ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_STATE = f"""
WITH plain AS ({_PLAIN}),
picked AS (
  SELECT *, children > 1 AND regexp_full_match(text, '[0-9]+') AS is_pick,
         CASE WHEN is_pick AND CAST(text AS INT) BETWEEN 1 AND children THEN CAST(text AS BIGINT) END AS pick FROM plain),
selected AS (SELECT *, last_value(pick IGNORE NULLS) OVER {_BEFORE} AS chosen FROM picked),
turns AS (
  SELECT *, CASE WHEN children = 0 THEN 'unregistered' WHEN pick IS NOT NULL THEN 'select' WHEN is_pick THEN 'menu'
                 WHEN children > 1 AND chosen IS NULL THEN 'menu' ELSE 'ask' END AS turn FROM selected),
marked AS (
  SELECT *, coalesce(max(seq) FILTER (WHERE turn = 'ask' AND label = 'summary') OVER {_BEFORE}, -1)
          > coalesce(max(seq) FILTER (WHERE turn = 'select') OVER {_BEFORE}, -1) AS after_summary FROM turns),
states AS (
  SELECT from_number, seq, turn, CASE turn WHEN 'select' THEN pick WHEN 'ask' THEN coalesce(chosen, 1) END AS child,
         after_summary, CASE WHEN turn = 'ask' THEN CASE WHEN after_summary AND contains(text, 'improve')
         THEN 'improvement_plan' ELSE label END END AS intent FROM marked)
"""
_STATE_ROWS = _STATE + "SELECT * FROM states"


def family_contacts(spark, sf_dir):
    return people.contacts(*(_read(spark, sf_dir, q) for q in (_FAMILIES, _LINKS, _STUDENTS)))


def incoming(spark, sf_dir):
    return _read(spark, sf_dir, _MESSAGES)


@CHECKS.add(_STATE_ROWS)
def session_state(spark, sf_dir):
    return messages.session_state(incoming(spark, sf_dir), family_contacts(spark, sf_dir))


# SQL spells the reply texts again, so that an altered one shows
_GREETING = " || chr(10) || ".join(f"'{line}'" for line in (
    "Hello! 👋 You can ask:", "- How is my child doing?", "- Suggest improvement plan", "- Attendance this week",
    "- Homework", "- Grades"))
_FAMILY = _CONTACTS.format(_sql(_FAMILIES), _sql(_LINKS), _sql(_STUDENTS))


@CHECKS.add(_STATE + f""",
children AS (SELECT *, row_number() OVER (PARTITION BY whatsapp_number ORDER BY student_id) AS child FROM ({_FAMILY})),
digest AS ({_DIGEST}), menus AS ({_MENU.format(_FAMILY)})
SELECT s.from_number, s.seq, CAST(1 AS BIGINT) AS part, CASE
  WHEN turn = 'unregistered' THEN '❌ Your number is not registered with the school.'
  WHEN turn = 'select' THEN '✅ Selected ' || coalesce(c.student_name, 'None') || '. How can I help?'
  WHEN turn = 'menu' THEN m.menu
  WHEN intent = 'summary' THEN '⏳ Fetching detailed summary for you…'
  WHEN intent = 'improvement_plan' THEN '⏳ Creating an improvement plan…'
  WHEN intent = 'attendance' THEN '📊 Attendance this week: ' || d.attendance_pct || '%'
  WHEN intent = 'homework' THEN d.homework WHEN intent = 'grades' THEN d.grades
  WHEN intent = 'greeting' THEN {_GREETING}
  ELSE 'I can help with attendance, homework, grades, or summaries.' END AS reply
FROM states s LEFT JOIN children c ON c.whatsapp_number = replace(s.from_number, 'whatsapp:', '') AND c.child = s.child
LEFT JOIN digest d ON d.student_id = c.student_id
LEFT JOIN menus m ON m.whatsapp_number = replace(s.from_number, 'whatsapp:', '')""")
def route_reply(spark, sf_dir):
    known = checkpointed(family_contacts(spark, sf_dir))
    states = messages.session_state(incoming(spark, sf_dir), known)
    return messages.route_reply(states, checkpointed(people.number_children(known)), checkpointed(_digest(spark, sf_dir, known)),
                                checkpointed(people.menu_text(known)))


# what the model answered: nothing, an empty text or a long one
_MODEL_TEXTS = ("SELECT concat('whatsapp:+', CAST(1000 + conv_id AS STRING)) AS from_number, turn AS seq, CASE turn % 3 WHEN 0 "
                "THEN repeat(concat(text, ' '), 3) WHEN 1 THEN '' END AS model_text FROM {conversations}")
_PLAN_TEXT = " || chr(10) || ".join(f"'{line}'" for line in (
    "Here are some general improvement suggestions:", "- Encourage regular attendance", "- Ensure homework is completed daily",
    "- Spend time revising Maths and English", "- Communicate with the class teacher"))


def _follow_ups(spark, sf_dir, intent):
    known = checkpointed(family_contacts(spark, sf_dir))
    turns = messages.session_state(incoming(spark, sf_dir), known)
    states = checkpointed(turns.filter(F.col("intent") == intent))
    numbered = checkpointed(people.number_children(known))
    # of the texts and digests only those that can be sent: a plan needs no digest
    own = _read(spark, sf_dir, _MODEL_TEXTS).join(states.select("from_number", "seq"), ["from_number", "seq"], "left_semi")
    senders = states.filter("intent = 'summary'").select(text.strip_address(F.col("from_number")).alias("whatsapp_number")).distinct()
    who = numbered.join(senders, "whatsapp_number", "left_semi")
    return messages.follow_ups(states, numbered, checkpointed(_digest(spark, sf_dir, who)), checkpointed(own)).drop("intent")


@CHECKS.add(_STATE + f""",
children AS (SELECT *, row_number() OVER (PARTITION BY whatsapp_number ORDER BY student_id) AS child FROM ({_FAMILY}))
SELECT s.from_number, s.seq, CAST(1 AS BIGINT) AS part, CAST(1 AS INTEGER) AS piece, coalesce(nullif(t.model_text, ''), d.body) AS body
FROM states s JOIN {_sql(_MODEL_TEXTS)} t ON t.from_number = s.from_number AND t.seq = s.seq
LEFT JOIN children c ON c.whatsapp_number = replace(s.from_number, 'whatsapp:', '') AND c.child = s.child
LEFT JOIN ({_DIGEST}) d ON d.student_id = c.student_id
WHERE intent = 'summary' AND coalesce(nullif(t.model_text, ''), d.body) IS NOT NULL""")
def summary_messages(spark, sf_dir):
    """The model's summary whole, or the student's facts."""
    return _follow_ups(spark, sf_dir, "summary")


@CHECKS.add(_STATE + f"""
SELECT from_number, seq, CAST(1 AS BIGINT) AS part, CAST(k.i // 1500 + 1 AS INTEGER) AS piece,
       substr(body, CAST(k.i AS BIGINT) + 1, 1500) AS body
FROM (SELECT s.from_number, s.seq, coalesce(nullif(t.model_text, ''), {_PLAN_TEXT}) AS body
      FROM states s JOIN {_sql(_MODEL_TEXTS)} t ON t.from_number = s.from_number AND t.seq = s.seq
      WHERE intent = 'improvement_plan'), unnest(range(0, length(body), 1500)) AS k(i)""")
def plan_messages(spark, sf_dir):
    """The model's plan or the standing one, in pieces."""
    return _follow_ups(spark, sf_dir, "improvement_plan")


@CHECKS.add(f"""
SELECT student_id, part, p.phone_number AS "to", CAST(CASE WHEN b.body IS NULL THEN NULL ELSE k.i // 1500 + 1 END AS INTEGER) AS piece,
       substr(b.body, CAST(k.i AS BIGINT) + 1, 1500) AS body
FROM (SELECT 'whatsapp:' || phone_number AS phone_number, parent_id FROM {_sql(_FAMILIES)}) p
JOIN {_sql(_LINKS)} l USING (parent_id) JOIN ({_DIGEST}) b USING (student_id),
     unnest(range(0, length(b.body), 1500)) AS k(i)""")
def digest_messages(spark, sf_dir):
    """Every parent's weekly digests, cut into pieces and addressed."""
    known = checkpointed(family_contacts(spark, sf_dir).select("student_id", F.col("whatsapp_number").alias("to")))
    bodies = _digest(spark, sf_dir, known).select("student_id", "part", "body")
    # a child has few parents, so the links are the side with repeated keys
    linked = join_skewed(known, checkpointed(bodies), ["student_id"])
    return messages.outgoing(linked.select("student_id", "part", "to", "body"), "to", "body")


@CHECKS.add("SELECT c_custkey, 'whatsapp:' || CAST(c_custkey AS VARCHAR) AS address, CAST(c_custkey AS VARCHAR) AS number FROM customer")
def addr_normalize(spark, sf_dir):
    plain = F.col("c_custkey").cast("string")
    mixed = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("whatsapp:"), plain)).otherwise(plain)
    return table(spark, sf_dir, "customer").select("c_custkey", text.normalize_address(mixed).alias("address"),
                                                   text.strip_address(mixed).alias("number"))


@CHECKS.add(r"""
SELECT doc_id, lower(regexp_replace(regexp_replace(' ' || chr(9) || text || chr(160) || chr(10), '^[\s\v\p{Z}]+', ''),
                                   '[\s\v\p{Z}]+$', '')) AS text
FROM documents""")
def text_normalize(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit(" \n"))
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(padded).alias("text"))


@CHECKS.add("SELECT doc_id, CAST(k.i // 1500 + 1 AS INTEGER) AS piece, substr(text, CAST(k.i AS BIGINT) + 1, 1500) AS body "
            "FROM documents, unnest(range(0, length(text), 1500)) AS k(i)")
def split_text(spark, sf_dir):
    pieces = F.posexplode(text.split_text(F.col("text"))).alias("at", "body")
    return table(spark, sf_dir, "documents").select("doc_id", pieces).select("doc_id", (F.col("at") + 1).alias("piece"), "body")


_REPLIES = """
SELECT event_id, CASE event_id % 11
  WHEN 0 THEN concat('{{"intent":"', CASE event_type WHEN 'view' THEN 'attendance' WHEN 'signup' THEN 'greeting'
         WHEN 'purchase' THEN 'summary' WHEN 'error' THEN 'homework' ELSE event_type END, '"}}') WHEN 1 THEN '{{"intent": "grades"}}'
  WHEN 2 THEN concat(' {{ "intent" : "fee", "more": ', props, ' }} ') WHEN 3 THEN props
  WHEN 4 THEN event_type WHEN 5 THEN '{{"intent":5}}' WHEN 6 THEN '[{{"intent":"grades"}}]'
  WHEN 7 THEN concat('{{"intent":"grades"}} ', props) WHEN 8 THEN '' WHEN 9 THEN NULL
  ELSE '{{"intent":"summary"' END AS reply FROM {events}"""


@CHECKS.add(f"""
SELECT event_id, CASE WHEN intent IN ('attendance', 'homework', 'grades', 'summary', 'fee', 'greeting', 'unknown')
       THEN intent ELSE 'unknown' END AS intent
FROM (SELECT event_id, json_extract_string(CASE WHEN json_valid(reply) THEN reply END, '$.intent') AS intent
      FROM {_sql(_REPLIES)})""")
def parse_intent(spark, sf_dir):
    return _read(spark, sf_dir, _REPLIES).select("event_id", intents.parse_intent(F.col("reply")).alias("intent"))


@CHECKS.add("SELECT p_partkey, 'Student ' || p_name || ' is in grade ' || p_size || '.' || chr(10) || 'Answer as {\"plan\": ...} for '"
            " || p_name AS prompt FROM part")
def render_prompt(spark, sf_dir):
    template = 'Student {name} is in grade {grade}.\nAnswer as {{"plan": ...}} for {name}'
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.render_prompt(template, name=F.col("p_name"), grade=F.col("p_size")).alias("prompt"))
