"""One line of loads though several writers may try at once, with the catalog as arbiter.

The catalog lets one writer only create a view of a name. A writer first claims a number, by a view named after it, and writes
files under that number alone. It then commits by creating the view that says which load follows the one it started from; who
comes second finds that view there and has lost. The commit holds all that is needed to show the load, so if its writer is lost
before showing it, the next one does. Claims that were never committed are dead: their numbers are noted and never read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

KEPT = 50  # commits that are kept, for writers and readers that far behind
PREFIX = "dimflow."


class ConcurrentLoad(RuntimeError):
    """Another load has been committed since this one was started; nothing of this one is shown."""


def literal(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(facts: dict[str, object]) -> str:
    """Facts for SQL text."""
    return "TBLPROPERTIES (" + ", ".join(f"{literal(PREFIX + k)} = {literal(v)}" for k, v in facts.items()) + ")"


def noted(spark: SparkSession, name: str) -> dict[str, str]:
    """The facts of a view or table; none if it is not there."""
    if not spark.catalog.tableExists(name):
        return {}
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").startswith(PREFIX)).collect()
    return {r["key"].removeprefix(PREFIX): r["value"] for r in found}


def _create(spark: SparkSession, name: str, facts: dict[str, object]) -> bool:
    try:
        spark.sql(f"CREATE VIEW {name} {properties(facts)} AS SELECT 1 AS one")
        return True
    except AnalysisException:
        if spark.catalog.tableExists(name):
            return False
        raise


def _claim(table: str, era: str, number: int) -> str:
    return f"{table}__claim_{era}_{number}"


def _after(table: str, era: str, base: int) -> str:
    return f"{table}__after_{era}_{base}"


def claim(spark: SparkSession, table: str, era: str, base: int) -> int:
    """A number above ``base`` that no other writer has or will get."""
    number = base + 1
    while not _create(spark, _claim(table, era, number), {"load": number}):
        number += 1
    return number


def commit(spark: SparkSession, table: str, era: str, base: int, facts: dict[str, object]) -> bool:
    """Make the load of ``facts`` the one that follows ``base``, unless another one does already."""
    return _create(spark, _after(table, era, base), facts)


def following(spark: SparkSession, table: str, era: str, base: int) -> dict[str, str]:
    """The facts of the load that follows ``base``, if one does."""
    return noted(spark, _after(table, era, base))


def forget(spark: SparkSession, table: str, era: str, number: int) -> None:
    """Drop what lies ``KEPT`` loads back."""
    if number > KEPT:
        for name in (_claim, _after):
            spark.sql(f"DROP VIEW IF EXISTS {name(table, era, number - KEPT)}")
