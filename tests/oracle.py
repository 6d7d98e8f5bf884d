"""Compare every query with its SQL in DuckDB, or count the rows of one without SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql):
    """None if both give the same columns, kinds of types and bag of rows, else what differs."""
    result = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(result.columns)
    if ours != theirs:
        return f"columns {ours} / {theirs}"
    kinds = {"tinyint": "INT", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    other = dict(zip(result.columns, map(str, result.types)))
    wrong = [(f.name, f.dataType.simpleString(), other[f.name]) for f in df.schema.fields
             if kinds.get(f.dataType.simpleString()) != other[f.name]]
    if wrong:
        return f"types {wrong}"
    mine = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in ours]).collect())
    hers = Counter(result.select(*[duckdb.ColumnExpression(c) for c in ours]).fetchall())
    if mine != hers:
        return (f"{sum(mine.values())} / {sum(hers.values())} rows; only ours {list((mine - hers).items())[:3]}; "
                f"only theirs {list((hers - mine).items())[:3]}")
    return None if mine else "no rows"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.warehouse.dir", "/tmp/dimflow-warehouse").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = difference(query(spark, sf_dir), con, sql[name]) if name in sql else None
            note = found or ("" if name in sql else f"no SQL, {query(spark, sf_dir).count()} rows")
        except Exception as error:
            found = note = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("bad:", bad)
    spark.stop()
