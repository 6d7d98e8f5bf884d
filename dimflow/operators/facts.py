"""Per-student facts, for all students at once: attendance, homework, grades and the weekly digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.replies import DIGEST_HEADING, NO_GRADES, NO_HOMEWORK
from dimflow.functions.text import render_prompt
from dimflow.operators.scd import load_date
from dimflow.operators.skew import HOT_ROWS, LINES_PER_PART, hot_keys, join_lines, join_skewed, split_hot
from dimflow.sources.storage import checkpointed


def attendance_pct(students: DataFrame, attendance: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """``student_id, attendance_pct``: the share of days present since ``days`` before the date, 0.0 without days."""
    recent = attendance.filter(F.col("attendance_date") >= F.date_sub(load_date(as_of), days))
    share = recent.groupBy("student_id").agg(
        F.try_divide(F.count_if(F.col("status") == "Present") * F.lit(100.0), F.count(F.lit(1))).alias("_pct"))
    return (students.select("student_id").join(share, "student_id", "left")
            .select("student_id", F.coalesce(F.bround("_pct", 2), F.lit(0.0)).alias("attendance_pct")))


def _texts(students: DataFrame, lines: DataFrame, keys: list[str], order: Sequence[str], name: str, limit: int,
           lines_per_part: int, unique: bool) -> DataFrame:
    """Texts of the students' lines by ``keys`` and ``part``, and their number of ``lines``.

    The lines are matched with the students, not the finished texts, which may be long and many for one student.
    """
    own = join_skewed(lines, students.select("student_id"), ["student_id"], "left_semi", limit)
    return join_lines(own, keys, order, "line", name, "\n", lines_per_part, limit, unique)


def _or_default(texts: DataFrame, wanted: DataFrame, told: DataFrame, keys: list[str], name: str, default: str) -> DataFrame:
    """The texts, and the default for those ``wanted`` that are not ``told`` anything."""
    without = wanted.join(told, keys, "left_anti")
    return texts.select(*keys, "part", name).unionByName(
        without.select(*keys, F.lit(1).cast("long").alias("part"), F.lit(default).alias(name)))


def _text_or(students: DataFrame, lines: DataFrame, order: Sequence[str], name: str, default: str, limit: int,
             lines_per_part: int, unique: bool) -> DataFrame:
    """Texts of the students' lines, and the default for students without any."""
    keys = ["student_id"]
    texts = _texts(students, lines, keys, order, name, limit, lines_per_part, unique)
    return _or_default(texts, students.select(*keys), lines.select(*keys).distinct(), keys, name, default)


def _dated(rows: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Every row once for each date."""
    return rows.withColumn("date", F.explode(F.array(*[F.lit(d).cast("date") for d in dates])))


def homework_text(students: DataFrame, homework: DataFrame, as_of: str | None = None,
                  order: Sequence[str] = ("line",), unique: bool = False, limit: int = HOT_ROWS,
                  lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """``student_id, part, homework``: a line per homework of the date, or the sentence for none. ``unique`` says that
    the order columns are unique per student. A NULL field reads ``None``."""
    line = render_prompt("- {subject}: {status}", subject=F.col("subject"), status=F.col("status")).alias("line")
    lines = (homework.filter(F.col("homework_date") == load_date(as_of))
             .select("student_id", *[c for c in order if c != "line"], line))
    return _text_or(students, lines, order, "homework", NO_HOMEWORK, limit, lines_per_part, unique)


def grades_text(students: DataFrame, grades: DataFrame, order: Sequence[str] = ("line",), unique: bool = False,
                limit: int = HOT_ROWS, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """``student_id, part, grades``: a line per grade, or the sentence for none. A NULL field reads ``None``."""
    return _text_or(students, _grade_lines(grades, order), order, "grades", NO_GRADES, limit, lines_per_part, unique)


def _grade_lines(grades: DataFrame, order: Sequence[str]) -> DataFrame:
    line = render_prompt("- {subject}: {score}/{max_score}", subject=F.col("subject"), score=F.col("score"),
                         max_score=F.col("max_score")).alias("line")
    return grades.select("student_id", *[c for c in order if c != "line"], line)


def weekly_digest(students: DataFrame, attendance: DataFrame, homework: DataFrame, grades: DataFrame,
                  as_of: str | None = None, days: int = 7, homework_order: Sequence[str] = ("line",),
                  grades_order: Sequence[str] = ("line",), unique: bool = False, limit: int = HOT_ROWS,
                  lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """``student_id, part, attendance_pct, homework, grades, body``: the week's facts and the message made of them.

    ``homework`` and ``grades`` are the parts of either text. The bodies of a student's parts, joined by line breaks in
    the order of ``part``, are the message: the heading, all homework, then all grades; the first part of the grades
    shares a body with the last of the homework. Texts of up to ``lines_per_part`` lines have one part, and so has their
    message. Only part 1 has the attendance. ``unique`` is about the homework order.
    """
    works = homework_text(students, homework, as_of, homework_order, unique, limit, lines_per_part)
    marks = grades_text(students, grades, grades_order, False, limit, lines_per_part)
    return _digests(works, marks, attendance_pct(students, attendance, as_of, days), ["student_id"])


def _digests(works: DataFrame, marks: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Digests per ``keys`` from the parts of homework and grades and the attendance."""
    none = F.lit(None).cast("string")
    more = works.filter("part > 1").groupBy(*keys).agg((F.max("part") - 1).alias("_shift"))
    one = F.lit(1).cast("long")
    rows = works.select(*keys, "part", F.lit(None).cast("double").alias("attendance_pct"), "homework",
                        none.alias("grades"), F.col("homework").alias("_first"), none.alias("_second"))
    rows = rows.unionByName(marks.select(*keys, "part", F.lit(None).cast("double").alias("attendance_pct"),
                                         none.alias("homework"), "grades", none.alias("_first"), none.alias("_second")))
    shifted = F.col("part") + F.coalesce("_shift", F.lit(0))
    rows = rows.unionByName(marks.join(more, keys, "left").select(
        *keys, shifted.alias("part"), F.lit(None).cast("double").alias("attendance_pct"), none.alias("homework"),
        none.alias("grades"), none.alias("_first"), F.col("grades").alias("_second")))
    rows = rows.unionByName(present.select(*keys, one.alias("part"), "attendance_pct", none.alias("homework"),
                                           none.alias("grades"), none.alias("_first"), none.alias("_second")))
    # at most four rows for each student (and date) and part
    whole = rows.groupBy(*keys, "part").agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns[len(keys) + 1:]])
    heading = F.when(F.col("part") == 1, render_prompt(DIGEST_HEADING, attendance=F.col("attendance_pct")))
    return whole.select(*keys, "part", "attendance_pct", "homework", "grades",
                        F.concat_ws("\n", heading, "_first", "_second").alias("body"))


def attendance_by_day(attendance: DataFrame) -> DataFrame:
    """``student_id, attendance_date, present, total``: partial sums that :func:`merged_days` adds up. Rows without a date
    count for no window."""
    return attendance.filter(F.col("attendance_date").isNotNull()).groupBy("student_id", "attendance_date").agg(
        F.count_if(F.col("status") == "Present").alias("present"), F.count(F.lit(1)).alias("total"))


def merged_days(days: DataFrame, more: DataFrame) -> DataFrame:
    """The sums of two deliveries of attendance, e.g. a stored table and a new day."""
    return days.unionByName(more).groupBy("student_id", "attendance_date").agg(F.sum("present").alias("present"),
                                                                              F.sum("total").alias("total"))


def attendance_pct_daily(students: DataFrame, by_day: DataFrame, dates: Sequence[str], days: int = 7) -> DataFrame:
    """``student_id, date, attendance_pct`` for all dates, as :func:`attendance_pct` gives it for each."""
    return _attended(students, by_day, dates, days).select("student_id", F.inline("_days"))


def _attended(students: DataFrame, by_day: DataFrame, dates: Sequence[str], days: int) -> DataFrame:
    """``student_id, _days``: a row per student with the attendance on each date, as structs ``date, attendance_pct``.

    A window has no end, so a day counts for the dates up to some date: days are summed up by it first, after which a
    student has no more sums than there are dates; days of other people than the students are left out.
    """
    asked = F.array_sort(F.array_distinct(F.array(*[F.lit(d).cast("date") for d in dates])))
    last = F.size(F.filter(asked, lambda d: F.date_sub(d, days) <= F.col("attendance_date")))
    sums = (by_day.select("student_id", last.alias("last"), "present", "total").filter("last > 0")
            .groupBy("student_id", "last").agg(F.sum("present").alias("present"), F.sum("total").alias("total")))
    rows = sums.select("student_id", F.struct("last", "present", "total").alias("_sum"), F.lit(False).alias("_known")).unionByName(
        students.select("student_id", F.lit(None).cast("struct<last:int,present:bigint,total:bigint>").alias("_sum"),
                        F.lit(True).alias("_known")))
    own = rows.groupBy("student_id").agg(F.collect_list("_sum").alias("_sums"), F.max("_known").alias("_known")).filter("_known")

    def total(name: str, nr: Column) -> Column:
        return F.aggregate(F.filter("_sums", lambda x: x["last"] > nr), F.lit(0).cast("long"), lambda a, x: a + x[name])

    def day(d: Column, nr: Column) -> Column:
        pct = F.bround(F.try_divide(total("present", nr) * F.lit(100.0), total("total", nr)), 2)
        return F.struct(d.alias("date"), F.coalesce(pct, F.lit(0.0)).alias("attendance_pct"))

    return own.select("student_id", F.transform(asked, day).alias("_days"))


def weekly_digest_daily(students: DataFrame, by_day: DataFrame, homework: DataFrame, grades: DataFrame, dates: Sequence[str],
                        days: int = 7, homework_order: Sequence[str] = ("line",), grades_order: Sequence[str] = ("line",),
                        unique: bool = False, limit: int = HOT_ROWS, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """:func:`weekly_digest` of many dates at once: its columns and ``date``.

    Attendance comes as sums by day (:func:`attendance_by_day`), which a table can keep and each delivery add to; homework is
    read once for all dates, and the grades' text, the same on every date, is made once. What there is about a student meets
    in one row, from which the dates are spread; so nothing is shuffled once for each date. Only students with more than
    ``lines_per_part`` lines, of grades or of all homework, which should not meet in a row, get a row for each date and part first.
    """
    line = render_prompt("- {subject}: {status}", subject=F.col("subject"), status=F.col("status")).alias("line")
    lines = homework.withColumnRenamed("homework_date", "date").filter(F.col("date").isin([F.lit(d).cast("date") for d in dates]))
    lines = lines.select("student_id", "date", *[c for c in homework_order if c != "line"], line)
    keys = ["student_id", "date"]
    works = checkpointed(_texts(students, lines, keys, homework_order, "homework", limit, lines_per_part, unique))
    marks = checkpointed(_texts(students, _grade_lines(grades, grades_order), ["student_id"], grades_order, "grades", limit,
                                lines_per_part, False))
    present = _attended(students, by_day, dates, days)
    told = works.select("student_id", "lines").unionByName(marks.filter("part > 1").select(
        "student_id", F.lit(lines_per_part + 1).alias("lines")))
    long = hot_keys(told, ["student_id"], lines_per_part, F.sum("lines"))
    if long is None:
        return _spread(works, marks, present)
    (works, long_works), (marks, long_marks), (present, long_present) = (
        split_hot(df, ["student_id"], long) for df in (works, marks, present))
    own = long.select("student_id")
    long_works = _or_default(long_works, _dated(own, dates), long_works.select(*keys), keys, "homework", NO_HOMEWORK)
    long_marks = _or_default(long_marks, own, long_marks.select("student_id"), ["student_id"], "grades", NO_GRADES)
    return _spread(works, marks, present).unionByName(
        _digests(long_works, _dated(long_marks, dates), long_present.select("student_id", F.inline("_days")), keys))


def _spread(works: DataFrame, marks: DataFrame, present: DataFrame) -> DataFrame:
    """Digests of one part for each date, from texts of one part and the rows of :func:`_attended`."""
    rows = present.select("student_id", "_days")
    rows = rows.unionByName(marks.select("student_id", "grades"), allowMissingColumns=True)
    rows = rows.unionByName(works.select("student_id", F.struct("date", "homework").alias("_work")), allowMissingColumns=True)
    whole = rows.groupBy("student_id").agg(F.first("_days", ignorenulls=True).alias("_days"),
                                           F.first("grades", ignorenulls=True).alias("grades"),
                                           F.map_from_entries(F.collect_list("_work")).alias("_works"))
    daily = whole.select("student_id", F.inline("_days"), "_works", F.coalesce("grades", F.lit(NO_GRADES)).alias("grades"))
    daily = daily.withColumn("homework", F.coalesce(F.try_element_at("_works", F.col("date")), F.lit(NO_HOMEWORK)))
    heading = render_prompt(DIGEST_HEADING, attendance=F.col("attendance_pct"))
    return daily.select("student_id", "date", F.lit(1).cast("long").alias("part"), "attendance_pct", "homework", "grades",
                        F.concat_ws("\n", heading, "homework", "grades").alias("body"))
