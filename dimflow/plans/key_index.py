"""The newest row of every key over many loads, kept by hash ranges of the keys.

A load reads and rewrites only the ranges its keys fall into; the others stay where earlier loads wrote them. The view named
like the index says which load holds which range, and is replaced in one step; loads commit as those of dimensions do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.operators.cleaning import dedup_latest
from dimflow.plans import commits
from dimflow.plans.commits import ConcurrentLoad
from dimflow.plans.dimension_table import era_of, load_number, loads_table, settle, show
from dimflow.sources.storage import checkpointed, remove
from dimflow.sources.tables import ensure_database, quoted, table_path

RANGE = "_range"
RANGES = 256  # fixed by the first load


def _range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def _held(facts: dict[str, str]) -> dict[int, int]:
    """The load that holds each range."""
    return {int(r): load for r, load in json.loads(facts.get("ranges", "{}")).items()}


def _where(held: dict[int, int]) -> str:
    """The partitions of some ranges, as SQL."""
    by_load: dict[int, list[int]] = {}
    for r, load in sorted(held.items()):
        by_load.setdefault(load, []).append(r)
    return " OR ".join(f"(load = {load} AND {RANGE} IN ({', '.join(map(str, own))}))" for load, own in by_load.items()) or "false"


def _touched(placed: DataFrame) -> list[int]:
    return sorted(r[0] for r in placed.select(RANGE).distinct().collect())  # as many as there are ranges at most


def rows_near(spark: SparkSession, table: str, facts: dict[str, str], touched: Sequence[int]) -> DataFrame:
    """The index's rows in some ranges. Other ranges' files are not read."""
    held = _held(facts)
    return spark.table(loads_table(table)).filter(_where({r: held[r] for r in touched if r in held})).drop("load", RANGE)


def merge_latest(batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], ranges: int = RANGES,
                 tries: int = 3) -> DataFrame:
    """Bring a batch into the index and return it: per key the row with the highest order columns of all batches so far.

    As ``dedup_latest`` over the batches' union; repeated batches change nothing. NULL is a key. All batches have the same
    columns. A batch that finds another committed meanwhile is merged again, up to ``tries`` times in all.
    """
    spark = batch.sparkSession
    ensure_database(spark, table)
    newest = dedup_latest(batch, keys, order)
    while True:
        tries -= 1
        try:
            return _merge(newest, table, keys, order, ranges)
        except ConcurrentLoad:
            if tries <= 0:
                raise


def _merge(newest: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    spark, loads = newest.sparkSession, loads_table(table)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in newest.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {loads} ({columns}, load INT, {RANGE} INT) USING parquet PARTITIONED BY (load, {RANGE}) "
              f"LOCATION {commits.literal(table_path(spark, loads))} " + commits.properties({"era": uuid.uuid4().hex[:8]}))
    old, era = settle(spark, table), era_of(spark, table)
    start, held, ranges = int(old.get("load", 0)), _held(old), int(old.get("of", ranges))
    placed = checkpointed(newest.withColumn(RANGE, _range(keys, ranges)))
    touched = _touched(placed)
    both = rows_near(spark, table, old, touched).select(*newest.columns).unionByName(placed.drop(RANGE))
    merged = dedup_latest(both, keys, order).withColumn(RANGE, _range(keys, ranges))
    number = commits.claim(spark, table, era, start)
    path = table_path(spark, loads)
    merged.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/load={number}")
    if touched:
        spark.sql(f"ALTER TABLE {loads} ADD IF NOT EXISTS " + " ".join(f"PARTITION (load={number}, {RANGE}={r})" for r in touched))
    now = held | {r: number for r in touched}
    replaced = [[held[r], r] for r in touched if r in held]
    names = ", ".join(quoted(c) for c in newest.columns)
    facts = {"load": number, "of": ranges, "ranges": json.dumps(now), "replaced": json.dumps(replaced),
             "select": f"SELECT {names} FROM {loads} WHERE {_where(now)}"}
    if load_number(spark, table) != start or not commits.commit(spark, table, era, start, facts):
        remove(spark, f"{path}/load={number}")
        raise ConcurrentLoad(f"{table}: another load came after load {start}; load {number} is not shown")
    show(spark, table, facts)
    settle(spark, table)
    commits.forget(spark, table, era, number)
    # readers of the previous state may still be running; what that one replaced is read no more
    for load, r in json.loads(old.get("replaced", "[]")):
        spark.sql(f"ALTER TABLE {loads} DROP IF EXISTS PARTITION (load={load}, {RANGE}={r})")
        remove(spark, f"{path}/load={load}/{RANGE}={r}")
    return spark.table(table)


def unseen(batch: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """The batch's rows whose key no earlier batch had; of those with the same key, all. Reads the touched ranges only."""
    spark = batch.sparkSession
    facts = settle(spark, table) if spark.catalog.tableExists(loads_table(table)) else {}
    if not facts:
        return batch
    placed = checkpointed(batch.withColumn(RANGE, _range(keys, int(facts["of"]))))
    known = rows_near(spark, table, facts, _touched(placed)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return placed.drop(RANGE).join(known, same, "left_anti")
