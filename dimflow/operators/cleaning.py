"""Row cleaning: casting, keys, NULLs, duplicates, code and unit tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from dimflow.functions.convert import cast_int_lenient, fill_null
from dimflow.functions.text import trim_initcap
from dimflow.operators.skew import HOT_ROWS, join_skewed
from dimflow.spec import PipelineSpec


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Only rows whose key is not NULL."""
    return df.filter(F.col(key).isNotNull())


def clean(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Names in title case, integers with defaults, a usable key of the spec's type: one projection and one filter.

    :func:`unusable_keys` has the rows the filter drops.
    """
    def cleaned(name: str) -> Column:
        c, numeric = F.col(f"`{name}`"), isinstance(df.schema[name].dataType, NumericType)
        if name == spec.key:
            return _key(df, spec).alias(name)
        if name in spec.int_defaults:
            return fill_null(c, spec.int_defaults[name], spec.int_type, numeric).alias(name)
        return trim_initcap(c).alias(name) if name in spec.name_columns else c

    needed = {spec.key, *spec.name_columns, *spec.int_defaults, *spec.tracked}
    if missing := sorted(needed - set(df.columns)):
        raise ValueError(f"{spec.pipeline_name}: source lacks columns {missing}")
    return require_key(df.select(*map(cleaned, df.columns)), spec.key)


def _key(df: DataFrame, spec: PipelineSpec) -> Column:
    c = F.col(f"`{spec.key}`")
    if spec.key_type == "string":
        return c.cast("string")
    return cast_int_lenient(c, spec.key_type, isinstance(df.schema[spec.key].dataType, NumericType))


def unusable_keys(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """The source rows that :func:`clean` drops, as they are: their key is NULL or not of the key's type."""
    return df.filter(_key(df, spec).isNull())


def handle_nulls(df: DataFrame, fill: Mapping[str, Any] | None = None, drop_any: Sequence[str] = (),
                 drop_all: Sequence[str] = ()) -> DataFrame:
    """Drop rows where any of ``drop_any``, or all of ``drop_all``, are NULL; then fill what is left."""
    if drop_any:
        df = df.na.drop("any", subset=list(drop_any))
    if drop_all:
        df = df.na.drop("all", subset=list(drop_all))
    return df.na.fill(dict(fill)) if fill else df


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per value of the columns. Copies collapse before the shuffle."""
    return df.distinct() if columns is None else df.dropDuplicates(list(columns))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest order columns per key; they must order the rows of a key totally.

    Filtering on the first rank lets Spark keep one row per key and task before the shuffle, so a hot key is harmless.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def map_codes(df: DataFrame, column: str, codes: DataFrame, code: str, value: str, name: str,
              default: str | None = None, limit: int = HOT_ROWS) -> DataFrame:
    """``name``: the value for a code in a table unique by code; the default, or else the code itself, if unknown."""
    table = codes.select(F.col(code).alias(column), F.col(value).alias("_value"))
    other = F.col(column) if default is None else F.lit(default)
    joined = join_skewed(df, table, [column], "left", limit)
    return joined.select(*df.columns, F.when(F.col(column).isNotNull(), F.coalesce("_value", other)).alias(name))


def convert_unit(df: DataFrame, value: str, unit: str, factors: DataFrame, name: str,
                 limit: int = HOT_ROWS) -> DataFrame:
    """``name`` = value * factor + offset, from a table ``unit, factor, offset``; NULL for an unknown unit."""
    table = factors.select(F.col("unit").alias(unit), F.col("factor").alias("_factor"),
                           F.col("offset").alias("_offset"))
    joined = join_skewed(df, table, [unit], "left", limit)
    return joined.select(*df.columns, (F.col(value) * F.col("_factor") + F.col("_offset")).alias(name))
