"""Renaming, ordering, adding and dropping columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame


def _require(df: DataFrame, names: Sequence[str]) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"no such columns: {missing}")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Old name to new name; an absent column is an error."""
    _require(df, list(names))
    return df.withColumnsRenamed(dict(names))


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The listed columns first, the others after them in their old order."""
    _require(df, first)
    return df.select(*first, *[c for c in df.columns if c not in first])


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the listed columns; an absent column is an error."""
    _require(df, names)
    return df.drop(*names)
