"""Conversations: what state each message meets, and what is answered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions import replies
from dimflow.functions.intents import parse_intent
from dimflow.functions.text import (MESSAGE_LIMIT, normalize_address, normalize_text, split_text, strip_address,
                                    with_default)
from dimflow.operators.skew import HOT_ROWS, OrderedGroups, join_skewed
from dimflow.sources.storage import checkpointed

# Fixed values
PLAN = "improvement_plan"
PLAN_WORD = "improve"


def readable(messages: DataFrame, *more: str) -> DataFrame:
    """``from_number, seq, text, intent, _phone`` and ``more`` from messages ``from_number, seq, body, model_reply``."""
    return messages.select("from_number", "seq", normalize_text(F.col("body")).alias("text"),
                           parse_intent(F.col("model_reply")).alias("intent"),
                           strip_address(F.col("from_number")).alias("_phone"), *more)


def families(contacts: DataFrame) -> DataFrame:
    """The number of children per phone number."""
    return contacts.groupBy(F.col("whatsapp_number").alias("_phone")).agg(F.count(F.lit(1)).alias("_children"))


def with_children(joined: DataFrame, *more: str) -> DataFrame:
    children = F.coalesce("_children", F.lit(0))
    return joined.select("from_number", "seq", "text", children.alias("children"), "intent", *more)


def prepare_messages(messages: DataFrame, contacts: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """``from_number, seq, text, children, intent``: what the turn of a message is decided from."""
    return with_children(join_skewed(readable(messages), families(contacts), ["_phone"], "left", limit))


def choice() -> Column:
    """The child number a prepared message picks; 0 for a number that is none; NULL if it picks nothing."""
    number = F.col("text").try_cast("long")
    digits = F.col("text").rlike("^[0-9]+$") & (F.col("children") > 1)
    return F.when(digits, F.when(number.between(1, F.col("children")), number).otherwise(F.lit(0)))


def session_state(messages: DataFrame, contacts: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """``from_number, seq, turn, child, after_summary, intent``: the turn each message is and the state it meets.

    A valid choice selects a child until the next one and forgets an earlier summary. Senders of several children get
    the menu until they choose, and for numbers that are none of theirs. A message asking to improve after a summary
    is a request for a plan, whatever its classified intent.
    """
    rows = prepare_messages(messages, contacts, limit).withColumn("_choice", choice())
    picked = F.when(F.col("_choice") > 0, F.col("_choice"))
    talk = OrderedGroups.of(rows, ["from_number"], ["seq"], limit).last_before("_selected", picked)
    turn = (F.when(F.col("children") == 0, "unregistered").when(F.col("_choice") > 0, "select")
            .when(F.col("_choice") == 0, "menu")
            .when((F.col("children") > 1) & F.col("_selected").isNull(), "menu").otherwise("ask"))
    talk = talk.with_df(talk.df.withColumn("turn", turn))
    mark = (F.when(F.col("turn") == "select", "selection")
            .when((F.col("turn") == "ask") & (F.col("intent") == "summary"), "summary"))
    talk = talk.last_before("_mark", mark)
    asks = F.col("turn") == "ask"
    after_summary = F.coalesce(F.col("_mark") == "summary", F.lit(False))
    child = F.when(F.col("turn") == "select", F.col("_choice")).when(asks, F.coalesce("_selected", F.lit(1)))
    intent = F.when(asks & after_summary & F.col("text").contains(PLAN_WORD), PLAN).when(asks, F.col("intent"))
    return talk.df.select("from_number", "seq", "turn", child.cast("long").alias("child"),
                          after_summary.alias("after_summary"), intent.alias("intent"))


def _told(numbered: DataFrame, facts: DataFrame, menus: DataFrame, limit: int) -> DataFrame:
    """All that replies say, by ``_phone`` and ``_slot``: a child's number, or 0 for the menu. First parts, and numbers of parts."""
    first = lambda c: F.max(F.when(F.col("part") == 1, F.col(c)))
    parts = lambda c: F.max(F.when(F.col(c).isNotNull(), F.col("part")))
    by_student = facts.groupBy("student_id").agg(
        first("attendance_pct").alias("_pct"), first("homework").alias("_homework"), first("grades").alias("_grades"),
        parts("homework").alias("_homeworks"), parts("grades").alias("_gradess"))
    pupils = numbered.select(F.col("whatsapp_number").alias("_phone"), F.col("child").cast("long").alias("_slot"), "student_id",
                             "student_name")
    children = join_skewed(pupils, by_student, ["student_id"], "left", limit)
    listed = menus.groupBy(F.col("whatsapp_number").alias("_phone")).agg(first("menu").alias("_menu"), F.max("part").alias("_menus"))
    return children.unionByName(listed.withColumn("_slot", F.lit(0).cast("long")), allowMissingColumns=True)


def route_reply(states: DataFrame, numbered: DataFrame, facts: DataFrame, menus: DataFrame,
                limit: int = HOT_ROWS) -> DataFrame:
    """``from_number, seq, part, reply`` from session states, numbered contacts, digest facts and menu texts.

    What can be told is put together once for each child and menu, and every turn looks it up by one key. Replies are one
    part, but for menus and texts that have more, whose further parts are joined to their turns only. The states and what
    can be told are stored here; the other tables are read more than once: pass stored ones.
    """
    menu, one = F.col("turn") == "menu", F.lit(1).cast("long")
    slot = F.when(menu, F.lit(0).cast("long")).otherwise(F.col("child"))
    keyed = checkpointed(states.withColumn("_phone", strip_address(F.col("from_number"))).withColumn("_slot", slot))
    told = checkpointed(_told(numbered, facts, menus, limit))
    asked = join_skewed(keyed, told, ["_phone", "_slot"], "left", limit).filter(~menu | F.col("_menu").isNotNull())
    homework, grades = F.col("intent") == "homework", F.col("intent") == "grades"
    text = (F.when(menu, F.col("_menu")).when(F.col("turn") == "unregistered", replies.NOT_REGISTERED)
            .when(F.col("turn") == "select", F.replace(F.lit(replies.SELECTED), F.lit("{name}"), F.coalesce("student_name", F.lit("None"))))
            .when(F.col("intent") == "summary", replies.SUMMARY_STARTED)
            .when(F.col("intent") == PLAN, replies.PLAN_STARTED)
            .when(F.col("intent") == "attendance",
                  F.replace(F.lit(replies.ATTENDANCE), F.lit("{attendance}"), F.coalesce("_pct", F.lit(0.0)).cast("string")))
            .when(homework, F.coalesce("_homework", F.lit(replies.NO_HOMEWORK)))
            .when(grades, F.coalesce("_grades", F.lit(replies.NO_GRADES)))
            .when(F.col("intent") == "greeting", replies.GREETING).otherwise(replies.HELP))
    direct = asked.select("from_number", "seq", one.alias("part"), text.alias("reply"))
    more = [facts.filter("part > 1").select(F.col("student_id").alias("_owner"), F.lit(c).alias("_kind"), "part", F.col(c).alias("reply"))
            .filter("reply IS NOT NULL") for c in ("homework", "grades")]
    more.append(menus.filter("part > 1").select(F.col("whatsapp_number").alias("_owner"), F.lit("menu").alias("_kind"), "part",
                                                F.col("menu").alias("reply")))
    texts = reduce(DataFrame.unionByName, more)
    if texts.isEmpty():
        return direct
    kind = F.when(menu, "menu").when(homework, "homework").when(grades, "grades")
    parts = F.when(menu, F.col("_menus")).when(homework, F.col("_homeworks")).when(grades, F.col("_gradess"))
    owner = F.when(menu, F.col("_phone")).otherwise(F.col("student_id"))
    spread = asked.filter(parts > 1).select("from_number", "seq", owner.alias("_owner"), kind.alias("_kind"),
                                            F.explode(F.sequence(one + 1, parts.cast("long"))).alias("part"))
    further = join_skewed(spread, checkpointed(texts), ["_owner", "_kind", "part"], "inner", limit)
    return direct.unionByName(further.select("from_number", "seq", "part", "reply"))


def follow_ups(states: DataFrame, numbered: DataFrame, bodies: DataFrame, model_texts: DataFrame,
               limit: int = HOT_ROWS) -> DataFrame:
    """``from_number, seq, intent, part, piece, body``: what is sent after the reply to a summary or plan turn.

    ``model_texts`` holds ``from_number, seq, model_text``. A summary is the model's text whole, or without one the
    student's weekly message, as many rows as ``bodies`` (``student_id, part, body``) has parts. A plan is the model's
    text, or the standing suggestions, cut into pieces. Pass stored tables: they are measured before they are joined.
    """
    turns = states.filter(F.col("intent").isin("summary", PLAN)).select("from_number", "seq", "child", "intent")
    turns = turns.join(model_texts.select("from_number", "seq", F.nullif("model_text", F.lit("")).alias("_text")),
                       ["from_number", "seq"], "left")
    plan = F.col("intent") == PLAN
    told = turns.filter(plan | F.col("_text").isNotNull())
    text = with_default(F.col("_text"), replies.DEFAULT_PLAN)
    pieces = F.when(plan, split_text(text)).otherwise(F.array(text))
    one = F.lit(1).cast("long")
    direct = told.select("from_number", "seq", "intent", one.alias("part"), F.posexplode(pieces).alias("_at", "body")).select(
        "from_number", "seq", "intent", "part", (F.col("_at") + 1).alias("piece"), "body")
    keyed = turns.filter(~plan & F.col("_text").isNull()).withColumn("_phone", strip_address(F.col("from_number")))
    pupils = numbered.select(F.col("whatsapp_number").alias("_phone"), "child", "student_id")
    asked = join_skewed(keyed, pupils, ["_phone", "child"], "inner", limit).select("from_number", "seq", "intent", "student_id")
    lengths = bodies.groupBy("student_id").agg(F.max("part").alias("_parts"))
    spread = (join_skewed(asked, lengths, ["student_id"], "inner", limit)
              .withColumn("part", F.explode(F.sequence(one, F.col("_parts")))))
    facts = join_skewed(spread, bodies.select("student_id", "part", "body"), ["student_id", "part"], "inner", limit)
    return direct.unionByName(facts.select("from_number", "seq", "intent", "part", F.lit(1).alias("piece"), "body"))


def outgoing(messages: DataFrame, number: str, text: str, limit: int = MESSAGE_LIMIT) -> DataFrame:
    """The rows to send: each text cut into numbered pieces, addressed to its number."""
    kept = [c for c in messages.columns if c != text]
    return messages.select(*[normalize_address(F.col(c)).alias(c) if c == number else F.col(c) for c in kept],
                           F.posexplode(split_text(F.col(text), limit)).alias("_at", "body")).select(
        *kept, (F.col("_at") + 1).alias("piece"), "body")
