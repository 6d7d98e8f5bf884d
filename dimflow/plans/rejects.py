"""Source rows that a pipeline cannot load, kept by the day of the load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.operators.cleaning import unusable_keys
from dimflow.sources.tables import ensure_database, table_path
from dimflow.spec import PipelineSpec

COLUMNS = "pipeline_name STRING, key_value STRING, reason STRING, source_row STRING"


def rejected(raw: DataFrame, spec: PipelineSpec) -> DataFrame:
    """``pipeline_name, key_value, reason, source_row`` for each source row without a usable key; the whole row as JSON, so
    that one table holds rows of sources whose columns change. A repeated row is there as often as it was delivered."""
    key = F.col(f"`{spec.key}`")
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    reason = F.when(key.isNull(), "key is missing").otherwise(f"key is no {spec.key_type}")
    return unusable_keys(raw, spec).select(
        F.lit(spec.pipeline_name).alias("pipeline_name"), key.cast("string").alias("key_value"), reason.alias("reason"),
        whole.alias("source_row"))


def store_rejects(raw: DataFrame, spec: PipelineSpec, day: str) -> DataFrame:
    """Put the rejected rows of ``day`` in place of what the table holds of that day, also if there are none any more, so a
    repeated load counts nothing twice; other days are not touched. Returns the table, with ``load_date``."""
    spark, table = raw.sparkSession, spec.rejects_table
    ensure_database(spark, table)
    path = table_path(spark, table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({COLUMNS}, load_date DATE) USING parquet "
              f"PARTITIONED BY (load_date) LOCATION '{path}'")
    rejected(raw, spec).write.mode("overwrite").parquet(f"{path}/load_date={day}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (load_date = DATE'{day}')")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def reject_counts(spark: SparkSession, table: str) -> DataFrame:
    """``pipeline_name, load_date, reason, n_rows`` over the days of a table of rejects."""
    return spark.table(table).groupBy("pipeline_name", "load_date", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
