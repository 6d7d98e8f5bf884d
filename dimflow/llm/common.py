"""Helpers shared by the operators: stored tables and joins on keys of any weight."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.sources.storage import work_dir

HOT_PER_PARTITION = 8


def stored(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and later readings see the same rows."""
    path = work_dir(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, dim: DataFrame, on: str, weight: str) -> DataFrame:
    """Join ``rows`` to the one row of ``dim`` with their ``on``; ``weight`` of ``dim`` is the number of such rows.

    Keys with more than 1/(8 x shuffle partitions) of all rows are hot. There are fewer than 8 x partitions of them by
    construction, so their rows of ``dim`` are broadcast and their rows of ``rows`` stay where they are; the others are
    shuffled. Both inputs are read twice: pass stored tables. Rows without a partner in ``dim`` are left out.
    """
    spark = rows.sparkSession
    total = dim.agg(F.sum(weight)).first()[0] or 0
    limit = max(1, total // (HOT_PER_PARTITION * partitions(spark)))
    hot, cold = dim.filter(F.col(weight) > limit), dim.filter(F.col(weight) <= limit)
    few = rows.join(F.broadcast(hot), on)
    many = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on)
    return few.unionByName(many)


def per_batch(f: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function for ``mapInArrow`` from one on batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = f(batch)
                if out is not None:
                    yield out
    return run


def arrow(schema: dict[str, pa.DataType], columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in schema.items()], names=list(schema))


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sampled(wanted: int, total: int) -> Column:
    """Holds for some nine tenths of ``wanted`` of ``total`` rows, by the hash of their text; for all if they are fewer."""
    share = 1.0 if total <= wanted else 0.9 * wanted / total
    return F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))
