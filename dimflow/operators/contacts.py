"""Parents, their children and the menu to choose among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.replies import MENU_HEADING
from dimflow.functions.text import render_prompt, strip_address
from dimflow.operators.skew import HOT_ROWS, LINES_PER_PART, OrderedGroups, join_numbered, join_skewed


def contacts(parents: DataFrame, student_parent_map: DataFrame, students: DataFrame, phone: str | None = None,
             limit: int = HOT_ROWS) -> DataFrame:
    """One row per parent and child, for one phone number or for all. Repeated map entries repeat the row."""
    if phone is not None:
        parents = parents.filter(F.col("phone_number") == strip_address(F.lit(phone)))
    who = parents.select("parent_id", "parent_name", F.col("phone_number").alias("whatsapp_number"))
    # the narrower side first: with a phone number hardly any map rows are left for the students
    links = join_skewed(student_parent_map.select("parent_id", "student_id"), who, ["parent_id"], "inner", limit)
    pupils = students.select("student_id", "student_name", "grade", "section")
    return join_skewed(links, pupils, ["student_id"], "inner", limit).select(
        "parent_id", "parent_name", "whatsapp_number", "student_id", "student_name", "grade", "section")


def number_children(found: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """The contacts with ``child``, counting from 1 per number in the order of the student ids."""
    return OrderedGroups.of(found, ["whatsapp_number"], ["student_id"], limit, unique=False).row_number("child").result()


def menu_text(found: DataFrame, limit: int = HOT_ROWS, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """``whatsapp_number, part, menu`` for numbers with more than one child. A NULL field reads ``None``."""
    numbered = number_children(found, limit)
    entry = render_prompt("{child}. {student_name} ({grade}-{section})",
                          **{c: F.col(c) for c in ("child", "student_name", "grade", "section")})
    lines = numbered.select("whatsapp_number", "child", entry.alias("line"))
    text = join_numbered(lines, ["whatsapp_number"], "child", "line", "menu", "\n", lines_per_part)
    first = F.concat_ws("\n", F.lit(MENU_HEADING), "menu")
    return (text.filter((F.col("part") > 1) | (F.col("lines") > 1))
            .select("whatsapp_number", "part", F.when(F.col("part") == 1, first).otherwise(F.col("menu")).alias("menu")))
