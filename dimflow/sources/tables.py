"""Table and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    """A column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def ensure_database(spark: SparkSession, table: str) -> str:
    """Create the database of a ``database.name`` table if it is absent."""
    database = table.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return database


def table_path(spark: SparkSession, table: str) -> str:
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


def overwrite_table(df: DataFrame, table: str) -> DataFrame:
    """Replace a Parquet table. The path is written in overwrite mode, so files left by a dropped table or a failed
    run do not stand in the way and a second run gives the same rows."""
    spark = df.sparkSession
    ensure_database(spark, table)
    df.write.mode("overwrite").format("parquet").option("path", table_path(spark, table)).saveAsTable(table)
    return spark.table(table)


def create_typed_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Replace a table by an empty one with the given columns."""
    return overwrite_table(spark.createDataFrame([], schema), table)


def append_table(df: DataFrame, table: str) -> None:
    """Append, matching columns by name and not by position."""
    df.write.mode("append").format("parquet").saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def _content(df: DataFrame) -> DataFrame:
    # order-free: a sum of row hashes, wide enough not to overflow
    row = F.xxhash64(*[F.col(quoted(c)) for c in sorted(df.columns)]).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("content"))


def validate_readback(df: DataFrame, table: str) -> DataFrame:
    """``source_rows, table_rows, equal``: whether a table holds exactly the rows of a DataFrame."""
    source = _content(df).withColumnsRenamed({"rows": "source_rows", "content": "source_content"})
    stored = _content(df.sparkSession.table(table)).withColumnsRenamed({"rows": "table_rows",
                                                                        "content": "table_content"})
    # one row each
    equal = (F.col("source_rows") == F.col("table_rows")) & (F.col("source_content") == F.col("table_content"))
    both = source.withColumn("_one", F.lit(1)).join(F.broadcast(stored.withColumn("_one", F.lit(1))), "_one")
    return both.select("source_rows", "table_rows", equal.alias("equal"))


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a header CSV to a folder, replacing it. A single file means a single writer: only for small extracts."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_xml(df: DataFrame, path: str, row_tag: str, rows_per_file: int = 100_000) -> str:
    """Write XML to a folder. Spark reads an XML file whole in one task, so no file has more than ``rows_per_file`` rows."""
    df.write.option("rowTag", row_tag).option("maxRecordsPerFile", rows_per_file).xml(path)
    return path
