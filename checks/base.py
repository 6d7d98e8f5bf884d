"""Shared pieces of the checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    query: Query
    sql: str | None


class Checks(list):
    """A list that collects checks through a decorator."""

    def add(self, sql: str | None):
        def keep(query: Query) -> Query:
            self.append(Check(query.__name__, query, sql))
            return query
        return keep


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def fresh_name(prefix: str) -> str:
    """An identifier no earlier call in this session has used."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
