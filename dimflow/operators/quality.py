"""Validation rules, per-rule reports and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.operators import bloom
from dimflow.operators.skew import BROADCAST_BYTES, HOT_ROWS, byte_size, join_skewed
from dimflow.sources.storage import checkpointed

VIOLATIONS = "violations"


@dataclass(frozen=True)
class Rule:
    """One check on one column. Except for ``not_null``, NULL passes."""

    name: str
    kind: str
    column: str
    low: Any = None
    high: Any = None
    pattern: str | None = None
    allowed: tuple[Any, ...] = ()
    parent: DataFrame | None = None
    parent_key: str | None = None

    def row_failure(self) -> Column | None:
        """The failing condition, for rules that one row decides."""
        c = F.col(self.column)
        match self.kind:
            case "not_null":
                return c.isNull()
            case "range":
                bounds = [test for value, test in ((self.low, c < self.low), (self.high, c > self.high))
                          if value is not None]
                return bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
            case "regex":
                return ~c.rlike(self.pattern)
            case "in_set":
                return ~c.isin(*self.allowed)
            case "unique" | "foreign_key":
                return None
            case other:
                raise ValueError(f"unknown rule kind {other!r}")


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", "not_null", column)


def in_range(column: str, low: Any = None, high: Any = None) -> Rule:
    if low is None and high is None:
        raise ValueError("a range needs a bound")
    return Rule(f"{column}_range", "range", column, low=low, high=high)


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column}_regex", "regex", column, pattern=pattern)


def in_set(column: str, allowed: Sequence[Any]) -> Rule:
    return Rule(f"{column}_in_set", "in_set", column, allowed=tuple(allowed))


def unique(column: str) -> Rule:
    return Rule(f"{column}_unique", "unique", column)


def foreign_key(column: str, parent: DataFrame, parent_key: str) -> Rule:
    return Rule(f"{column}_foreign_key", "foreign_key", column, parent=parent, parent_key=parent_key)


def mark_orphans(df: DataFrame, base: DataFrame, parents: DataFrame, column: str, mark: str, limit: int,
                 broadcast_bytes: int) -> DataFrame:
    """``df`` with ``mark`` true where ``column`` is a value that ``parents`` lack, for parents too many to broadcast.

    Only the different values of the column (in ``base``) meet the parents, not the rows. The values that have no parent are
    broadcast to the rows if they are few; else a Bloom filter of them is, which settles the rows it does not hold, and only
    the others are joined with the values themselves.
    """
    values = base.select(column).filter(F.col(column).isNotNull()).distinct()
    orphans = checkpointed(values.join(parents, column, "left_anti").withColumn(mark, F.lit(True)))
    if byte_size(orphans) <= broadcast_bytes:
        return df.join(F.broadcast(orphans), column, "left")
    may_be = bloom.probed(df, bloom.built(orphans, column, orphans.count()), column, "_may_be")
    settled = may_be.filter("NOT _may_be").withColumn(mark, F.lit(None).cast("boolean"))
    exact = join_skewed(may_be.filter("_may_be"), orphans, [column], "left", limit, broadcast_bytes)
    return settled.drop("_may_be").unionByName(exact.drop("_may_be"))


def _failure_flags(df: DataFrame, rules: Sequence[Rule], limit: int,
                   broadcast_bytes: int) -> tuple[DataFrame, list[Column]]:
    """The rows with what the set-wise rules need joined on, and one failing condition per rule."""
    base, flags = df, []
    for i, rule in enumerate(rules):
        failure = rule.row_failure()
        if failure is None:
            mark, key = f"_mark{i}", F.col(rule.column)
            if rule.kind == "unique":
                # counting combines per task first; only the repeated values, kept on disk, come back to the rows
                counts = checkpointed(base.groupBy(rule.column).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"))
                # NULL is repeated too, and may be hot, but breaks no rule
                found = counts.filter(key.isNotNull()).select(rule.column, F.lit(True).alias(mark))
                failure = F.col(mark).isNotNull()
                df = join_skewed(df, found, [rule.column], "left", limit, broadcast_bytes, counts)
            else:
                parents = rule.parent.select(F.col(rule.parent_key).alias(rule.column)).filter(key.isNotNull())
                if byte_size(parents) <= broadcast_bytes:
                    df = df.join(F.broadcast(parents.distinct().withColumn(mark, F.lit(True))), rule.column, "left")
                    failure = key.isNotNull() & F.col(mark).isNull()
                else:
                    df = mark_orphans(df, base, parents, rule.column, mark, limit, broadcast_bytes)
                    failure = F.col(mark).isNotNull()
        flags.append(F.coalesce(failure, F.lit(False)))
    return df, flags


def validate(df: DataFrame, rules: Sequence[Rule], limit: int = HOT_ROWS,
             broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with ``violations``, the names of the rules each one breaks in the order of the rules."""
    marked, flags = _failure_flags(df, rules, limit, broadcast_bytes)
    names = F.array(*[F.when(f, F.lit(r.name)) for r, f in zip(rules, flags)])
    return marked.select(*df.columns, F.array_compact(names).alias(VIOLATIONS))


def quality_report(df: DataFrame, rules: Sequence[Rule], limit: int = HOT_ROWS,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rule, checked, failed``: every rule counted in one pass over the marked rows."""
    marked, flags = _failure_flags(df, rules, limit, broadcast_bytes)
    counts = marked.agg(F.count(F.lit(1)).alias("checked"),
                        *[F.count_if(f).alias(f"_failed{i}") for i, f in enumerate(flags)])
    lines = [F.struct(F.lit(r.name).alias("rule"), F.col("checked"), F.col(f"_failed{i}").alias("failed"))
             for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*lines)))


def split_valid(df: DataFrame, rules: Sequence[Rule], limit: int = HOT_ROWS,
                broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows without violations, rejected rows with theirs)."""
    checked = validate(df, rules, limit, broadcast_bytes)
    broken = F.size(VIOLATIONS) > 0
    return checked.filter(~broken).drop(VIOLATIONS), checked.filter(broken)


def split_corrupt(raw: DataFrame, corrupt_column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rows of unparsable lines) of a source read with a corrupt-record column in its schema. Spark reads
    that column only together with others, so the second keeps what could be parsed."""
    c = F.col(corrupt_column)
    return raw.filter(c.isNull()).drop(corrupt_column), raw.filter(c.isNotNull())
