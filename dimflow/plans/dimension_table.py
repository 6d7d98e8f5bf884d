"""Dimension tables that readers see change in one step.

Every load writes its rows once, into its own partitions of ``<table>__loads``; then a view named like the dimension is
replaced and shows the new state. Closed versions stay in the partitions of the load that closed them, so a load
rewrites current rows only. A failed load leaves the view as it was, and its files are never read. Of several loads at once
one is committed and the others raise ``ConcurrentLoad``; see ``commits``.

A late load replaces closed versions, too. It keeps their keys and starts in ``<table>__retired``; the view leaves out what an
earlier load closed under them. ``<table>__seen`` has the keys of every load with its date, where they are asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dimflow.plans import commits
from dimflow.plans.commits import ConcurrentLoad, noted
from dimflow.sources.storage import remove
from dimflow.sources.tables import ensure_database, quoted, table_path

FLAGS = ("true", "false")


def loads_table(table: str) -> str:
    return f"{table}__loads"


def retired_table(table: str) -> str:
    return f"{table}__retired"


def seen_table(table: str) -> str:
    return f"{table}__seen"


def load_number(spark: SparkSession, table: str) -> int:
    """The number of the load the dimension shows, 0 before the first."""
    return int(noted(spark, table).get("load", 0))


def newest_day(spark: SparkSession, table: str) -> str | None:
    """The latest date of any load so far."""
    return noted(spark, table).get("newest")


def _among(facts: dict[str, str], first: str) -> str:
    """Which loads count, as SQL."""
    dead = f" AND load NOT IN ({facts['dead']})" if facts.get("dead") else ""
    return f"load BETWEEN {facts[first]} AND {facts['load']}{dead}"


def seen_rows(spark: SparkSession, table: str) -> DataFrame | None:
    """The sightings of the loads that the dimension shows, if they are kept."""
    facts = noted(spark, table)
    if "seen" not in facts or not spark.catalog.tableExists(seen_table(table)):
        return None
    return spark.table(seen_table(table)).filter(_among(facts, "seen")).drop("load")


def _put(rows: DataFrame, table: str, load: int, flags: Sequence[str] = ()) -> None:
    """Store rows of a load in its own folder and make that a partition of the table, two with ``flags``."""
    spark, path = rows.sparkSession, f"{table_path(rows.sparkSession, table)}/load={load}"
    writer = rows.write.mode("overwrite")
    (writer.partitionBy("is_current") if flags else writer).parquet(path)
    for part in [f"load={load}, is_current={flag}" for flag in flags] or [f"load={load}"]:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({part})")


def _keep_beside(rows: DataFrame, table: str, load: int) -> None:
    """Store rows of a load in a table beside the dimension."""
    spark = rows.sparkSession
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load INT) USING parquet PARTITIONED BY (load) "
              f"LOCATION {commits.literal(table_path(spark, table))}")
    _put(rows, table, load)


def era_of(spark: SparkSession, table: str) -> str | None:
    """Names one creation of the loads table, so that commits to an earlier one do not count."""
    return noted(spark, loads_table(table)).get("era") if spark.catalog.tableExists(loads_table(table)) else None


def _ensure_loads(rows: DataFrame, table: str, first: bool) -> str:
    """Create the loads table unless it is there; its era."""
    spark, loads = rows.sparkSession, loads_table(table)
    flag = ["is_current"] if "is_current" in rows.columns else []
    plain = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name not in flag}
    if first and spark.catalog.tableExists(loads):
        there = {f.name: f.dataType.simpleString() for f in spark.table(loads).schema.fields if f.name not in ("load", *flag)}
        if there != plain:  # left by a first load of other columns that never came through
            spark.sql(f"DROP TABLE {loads}")
    columns = ", ".join(f"{quoted(c)} {t}" for c, t in plain.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {loads} ({columns}, load INT{', is_current BOOLEAN' * bool(flag)}) USING parquet "
              f"PARTITIONED BY ({', '.join(['load', *flag])}) LOCATION {commits.literal(table_path(spark, loads))} "
              + commits.properties({"era": uuid.uuid4().hex[:8]}))
    return era_of(spark, table)


def settle(spark: SparkSession, table: str) -> dict[str, str]:
    """The facts of the load that the next one starts from. Shows it, where its writer did not come to that."""
    era = era_of(spark, table)
    while True:
        facts = noted(spark, table)
        after = commits.following(spark, table, era, int(facts.get("load", 0))) if era else {}
        if not after:
            return facts
        show(spark, table, after)


def show(spark: SparkSession, table: str, facts: dict[str, object]) -> None:
    """Replace the view, and that of replaced rows, by what a commit says."""
    shown = {k: v for k, v in facts.items() if k not in ("select", "beside", "beside_select")}
    if "beside" in facts:
        spark.sql(f"CREATE OR REPLACE VIEW {facts['beside']} AS {facts['beside_select']}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} {commits.properties(shown)} AS {facts['select']}")


def current_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows a merge starts from: current versions where there are versions, else all."""
    shown = spark.table(table)
    return shown.filter("is_current") if "is_current" in shown.columns else shown


def _clear(spark: SparkSession, table: str, load: int, flag: str = "") -> None:
    """Forget and empty one partition."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load={load}{f', is_current={flag}' if flag else ''})")
    remove(spark, f"{table_path(spark, table)}/load={load}{f'/is_current={flag}' if flag else ''}")


def _select(loads: str, columns: list[str], facts: dict[str, object], key: str | None, newest: Sequence[str],
            retired: str | None = None) -> str:
    """The query behind the dimension after the load of ``facts``.

    The flag is shown as a literal per branch, so that a reader of current rows never plans the closed ones.
    """
    number = facts["load"]

    def listed(flag: str) -> str:
        return ", ".join(f"{flag} AS is_current" if c == "is_current" else quoted(c) for c in columns)

    if "is_current" not in columns:
        return f"SELECT {listed('')} FROM {loads} WHERE load = {number}"
    current = f"FROM {loads} WHERE load = {number} AND is_current"
    closed = f"SELECT {listed('false')} FROM {loads} WHERE {_among(facts, 'first')} AND NOT is_current"
    if retired:
        gone = f"SELECT * FROM {retired} WHERE {_among(facts, 'first')}"
        closed = (f"SELECT {listed('false')} FROM (SELECT * FROM {loads} WHERE {_among(facts, 'first')} AND NOT is_current) l "
                  f"LEFT ANTI JOIN ({gone}) r ON l.{quoted(key)} = r.{quoted(key)} AND l.start_date = r.start_date "
                  "AND l.load < r.load")
    if newest:
        fresh = {f"current_{c}": f"n.{quoted(c)} AS {quoted(f'current_{c}')}" for c in newest}
        names = ", ".join(fresh.get(c, f"c.{quoted(c)}") for c in columns)
        values = ", ".join(quoted(c) for c in (key, *newest))
        closed = (f"SELECT {names} FROM ({closed}) c LEFT JOIN (SELECT {values} {current}) n "
                  f"ON c.{quoted(key)} = n.{quoted(key)}")
    return f"SELECT {listed('true')} {current} UNION ALL {closed}"


def publish(rows: DataFrame, table: str, key: str | None = None, newest: Sequence[str] = (), afresh: bool = False,
            day: str | None = None, seen: DataFrame | None = None, retired: DataFrame | None = None,
            base: dict[str, str] | None = None, replaced: tuple[str, DataFrame] | None = None) -> int:
    """Write a load and show it. ``rows`` are the current rows and, with versions, those this load closed. ``afresh``
    leaves out the versions closed by earlier loads, from the moment the view is replaced.

    For the columns in ``newest`` closed versions show in ``current_<c>`` what the key's current version holds; that
    is joined on when read, so a load need not rewrite history for it. ``seen`` are the load's sightings on its ``day``;
    ``retired`` (the key and start_date) are closed versions that ``rows`` replace; ``replaced`` names a view and gives the rows
    that this load adds to it. ``base`` is what :func:`settle` said before ``rows`` were made from the table: if another load
    has been committed since, this one raises ``ConcurrentLoad`` and shows nothing.
    """
    spark, loads = rows.sparkSession, loads_table(table)
    ensure_database(spark, table)
    old = settle(spark, table) if base is None else base
    start = int(old.get("load", 0))
    era, versioned = _ensure_loads(rows, table, start == 0), "is_current" in rows.columns
    number = commits.claim(spark, table, era, start)
    flags = FLAGS if versioned else ()
    for own, name in ((seen, seen_table(table)), (retired, retired_table(table))):
        if own is not None:
            _keep_beside(own, name, number)
    if replaced is not None:
        _keep_beside(replaced[1], f"{replaced[0]}__rows", number)
    _put(rows, loads, number, flags)
    kept = {} if afresh else old
    facts = {"load": number, "before": start, "first": number if afresh else kept.get("first", number)}
    dead = [n for n in kept.get("dead", "").split(",") if n] + [str(n) for n in range(start + 1, number)]
    facts |= {"dead": ", ".join(dead)} if dead and start else {}
    facts |= {"newest": max(day, kept.get("newest", day))} if day else {}
    facts |= {"seen": kept.get("seen", number)} if seen is not None else {}  # from this load on
    facts |= {"retired": "true"} if retired is not None or "retired" in kept else {}
    facts["select"] = _select(loads, rows.columns, facts, key, newest, retired_table(table) if "retired" in facts else None)
    if replaced is not None:
        everything = facts | {"first": 1}
        facts |= {"beside": replaced[0], "beside_select": f"SELECT * FROM {replaced[0]}__rows WHERE {_among(everything, 'first')}"}
    if load_number(spark, table) != start or not commits.commit(spark, table, era, start, facts):
        for flag in flags or ("",):
            _clear(spark, loads, number, flag)
        raise ConcurrentLoad(f"{table}: another load came after load {start}; load {number} is not shown")
    show(spark, table, facts)
    settle(spark, table)  # a later load may have been shown meanwhile
    commits.forget(spark, table, era, number)
    # readers of the previous state may still be running; the one before has been replaced for a whole load
    if int(old.get("before", 0)) > 0:
        _clear(spark, loads, int(old["before"]), flags[0] if flags else "")
    return number


def reset(spark: SparkSession, table: str) -> None:
    """Forget a dimension; its next load is a first load."""
    ensure_database(spark, table)
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for beside in (loads_table, retired_table, seen_table):
        spark.sql(f"DROP TABLE IF EXISTS {beside(table)}")
