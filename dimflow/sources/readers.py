"""Sources: delimited text, JSON, XML, Parquet, ORC, SQL text, and the dispatch on a pipeline's file type."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow.spec import SourceSpec

Schema = StructType | str | None


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema: Schema = None,
                   **options: Any) -> DataFrame:
    """Delimited text. Without a schema every column is a string, so nothing is scanned to guess types; an empty field
    is NULL, surplus fields are cut and short rows are padded with NULL."""
    reader = spark.read.options(header=header, sep=sep, **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: Schema = None, **options: Any) -> DataFrame:
    return read_delimited(spark, path, ",", header, schema, **options)


def read_text(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """One row per line in a single ``value`` column."""
    return spark.read.options(**options).text(path)


def read_json(spark: SparkSession, path: str, schema: Schema = None, **options: Any) -> DataFrame:
    """One JSON object per line; give a schema to avoid the inference scan."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: Schema = None, **options: Any) -> DataFrame:
    reader = spark.read.options(rowTag=row_tag, **options)
    return (reader.schema(schema) if schema is not None else reader).xml(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """A SELECT over registered tables; values are bound as named parameters, never formatted into the text."""
    return spark.sql(text, args=dict(args or {}))


def as_schema(df: DataFrame, schema: StructType | str) -> DataFrame:
    """The columns a schema names, by name and cast to its types; a column the data lacks is an error. Columnar files
    have types of their own, which readers do not change."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Read what a pipeline names, by its file type."""
    options, schema = dict(source.options), source.schema
    match source.file_type:
        case "csv":
            return read_delimited(spark, source.path, schema=schema, **options)
        case "tsv":
            return read_delimited(spark, source.path, sep="\t", schema=schema, **options)
        case "txt":
            return (read_delimited(spark, source.path, schema=schema, **options) if "sep" in options
                    else read_text(spark, source.path, **options))
        case "json":
            return read_json(spark, source.path, schema=schema, **options)
        case "xml":
            return read_xml(spark, source.path, options.pop("row_tag", "row"), schema=schema, **options)
        case "sql":
            return read_sql(spark, source.path, options)
        case "parquet" | "orc" | "avro" as name:
            rows = spark.read.format(name).options(**options).load(source.path)
            return rows if schema is None else as_schema(rows, schema)
        case other:
            raise ValueError(f"unknown file type {other!r}")


def describe_source(df: DataFrame) -> DataFrame:
    """Column names, types and nullability as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, name STRING, type STRING, nullable BOOLEAN")


def profile_source(df: DataFrame) -> DataFrame:
    """The description with row and NULL counts of each column, from one pass over the data."""
    counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                                                  for i, c in enumerate(df.columns)]
    entries = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"),
                        F.lit(f.dataType.simpleString()).alias("type"), F.col("rows"), F.col(f"n{i}").alias("nulls"))
               for i, f in enumerate(df.schema.fields)]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
