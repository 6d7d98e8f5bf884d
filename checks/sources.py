"""Readers and sinks."""

from pyspark.sql import functions as F

from checks.base import Checks, fresh_name, table
from dimflow.operators import quality
from dimflow.plans.pipeline import run_pipelines
from dimflow.sources import compare, readers, tables
from dimflow.sources.storage import work_dir
from dimflow.spec import PipelineSpec, SourceSpec

CHECKS = Checks()


@CHECKS.add("SELECT * FROM customer")
def src_csv_roundtrip(spark, sf_dir):
    customer, path = table(spark, sf_dir, "customer"), work_dir(spark, "csv")
    tables.export_csv(customer, path)
    return readers.read_csv(spark, path, schema=customer.schema)


@CHECKS.add("SELECT * FROM part")
def src_tsv_roundtrip(spark, sf_dir):
    part, path = table(spark, sf_dir, "part"), work_dir(spark, "tsv")
    part.write.options(header=True, sep="\t").csv(path)
    return readers.read_delimited(spark, path, sep="\t", schema=part.schema)


@CHECKS.add("SELECT CAST(n_nationkey AS VARCHAR) || ' ' || n_name AS value FROM nation "
            "UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ' ' || c_name FROM customer")
def src_text_lines(spark, sf_dir):
    path = work_dir(spark, "txt")
    nation = table(spark, sf_dir, "nation").select(F.concat_ws(" ", F.col("n_nationkey").cast("string"), "n_name"))
    customer = table(spark, sf_dir, "customer").select(F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name"))
    nation.union(customer).write.text(path)
    return readers.read_source(spark, SourceSpec("txt", path))


@CHECKS.add("SELECT * FROM orders")
def src_json_roundtrip(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), work_dir(spark, "json")
    orders.write.json(path)
    return readers.read_json(spark, path, schema=orders.schema)


@CHECKS.add("SELECT * FROM customer")
def src_xml_roundtrip(spark, sf_dir):
    customer, path = table(spark, sf_dir, "customer"), work_dir(spark, "xml")
    tables.write_xml(customer, path, "customer")
    return readers.read_xml(spark, path, "customer", schema=customer.schema)


@CHECKS.add("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'")
def src_parquet_scan(spark, sf_dir):
    lines = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    since = F.lit("2000-01-01").cast("timestamp_ntz")
    return lines.filter(F.col("l_shipdate") >= since).select("l_orderkey", "l_partkey", "l_quantity")


@CHECKS.add("SELECT * FROM lineitem")
def src_orc_roundtrip(spark, sf_dir):
    path = work_dir(spark, "orc")
    table(spark, sf_dir, "lineitem").write.orc(path)
    return readers.read_orc(spark, path)


@CHECKS.add("SELECT c_mktsegment AS segment, count(*) AS customers, min(c_custkey) AS first_key FROM customer "
            "WHERE c_acctbal >= 0.0 GROUP BY c_mktsegment")
def src_sql_text(spark, sf_dir):
    name = fresh_name("customer")
    table(spark, sf_dir, "customer").createOrReplaceTempView(name)
    return readers.read_sql(
        spark, f"SELECT c_mktsegment AS segment, count(*) AS customers, min(c_custkey) AS first_key FROM {name} "
        "WHERE c_acctbal >= :least GROUP BY c_mktsegment", {"least": 0.0})


@CHECKS.add("SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer "
            "UNION ALL SELECT p_partkey, p_name FROM part")
def src_dispatch(spark, sf_dir):
    schema, found = "id BIGINT, name STRING", []
    for kind, name, key, text in (("csv", "supplier", "s_suppkey", "s_name"), ("json", "customer", "c_custkey", "c_name"),
                                  ("parquet", "part", "p_partkey", "p_name")):
        path = work_dir(spark, kind)
        rows = table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(text).alias("name"))
        rows.write.options(**({"header": True} if kind == "csv" else {})).format(kind).save(path)
        found.append(readers.read_source(spark, SourceSpec(kind, path, schema=schema)))
    return found[0].unionByName(found[1]).unionByName(found[2])


_LINEITEM = (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
             ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))


@CHECKS.add(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name, '{t}' AS type, count(*) AS \"rows\", "
    f"count(*) - count({c}) AS nulls FROM lineitem" for i, (c, t) in enumerate(_LINEITEM)))
def src_schema_profile(spark, sf_dir):
    return readers.profile_source(table(spark, sf_dir, "lineitem"))


@CHECKS.add("SELECT * FROM customer")
def sink_overwrite_twice(spark, sf_dir):
    name, customer = f"staging.{fresh_name('twice')}", table(spark, sf_dir, "customer")
    tables.overwrite_table(customer, name)
    return tables.overwrite_table(customer, name)


@CHECKS.add("SELECT s_suppkey AS id, s_name AS name, CAST('2024-01-01' AS DATE) AS start_date, "
            "sha256(s_name) AS hash FROM supplier")
def sink_append_by_name(spark, sf_dir):
    name = f"staging.{fresh_name('byname')}"
    rows = table(spark, sf_dir, "supplier").select(
        F.sha2("s_name", 256).alias("hash"), F.lit("2024-01-01").cast("date").alias("start_date"),
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    typed = rows.select("id", "name", "start_date", "hash").schema
    tables.create_typed_table(spark, name, typed)
    tables.append_table(rows, name)
    return tables.read_table(spark, name)


@CHECKS.add("SELECT count(*) AS source_rows, count(*) AS table_rows, true AS equal FROM orders")
def sink_readback_report(spark, sf_dir):
    name, orders = f"staging.{fresh_name('readback')}", table(spark, sf_dir, "orders")
    tables.overwrite_table(orders, name)
    return tables.validate_readback(orders, name)


@CHECKS.add("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 450000 THEN 'missing' ELSE 'changed' END AS difference FROM orders
WHERE o_orderstatus = 'P' AND o_totalprice > 450000 OR o_orderpriority LIKE '1%' AND o_totalprice < 60000
UNION ALL SELECT -o_orderkey, 'extra' FROM orders WHERE o_totalprice > 490000""")
def sink_readback_diff(spark, sf_dir):
    """A stored copy of the orders with some of them lost, some altered and some that never were, against the orders."""
    name, orders = f"staging.{fresh_name('compared')}", table(spark, sf_dir, "orders")
    lost = "NOT (o_orderstatus = 'P' AND o_totalprice > 450000)"
    altered = F.expr("CASE WHEN o_orderpriority LIKE '1%' AND o_totalprice < 60000 THEN NULL ELSE o_orderpriority END")
    extra = orders.filter("o_totalprice > 490000").withColumn("o_orderkey", -F.col("o_orderkey"))
    stored = compare.overwrite_ranged(orders.filter(lost).withColumn("o_orderpriority", altered).unionByName(extra), name, ["o_orderkey"])
    return compare.differences(orders, stored, ["o_orderkey"])


@CHECKS.add("SELECT c_custkey AS id, '****' AS name_masked, c_mktsegment AS department FROM customer")
def sink_export_dashboard(spark, sf_dir):
    view, path = fresh_name("board"), work_dir(spark, "board")
    table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "'****' AS name_masked", "c_mktsegment AS department").createOrReplaceTempView(view)
    tables.export_csv(spark.table(view), path)
    return readers.read_csv(spark, path, schema="id BIGINT, name_masked STRING, department STRING")


@CHECKS.add("""
SELECT c_custkey * 3000000000 AS id, '****' AS name_masked, c_mktsegment AS department,
       sha256('pepper' || CAST(CAST(trunc(c_acctbal * 10000) AS BIGINT) AS VARCHAR)) AS salary_hash, CAST('2024-01-31' AS DATE) AS start_date
FROM customer""")
def end_to_end_parquet(spark, sf_dir):
    """A typed source read with a schema, 64-bit keys and a salted view."""
    path = work_dir(spark, "typed")
    table(spark, sf_dir, "customer").selectExpr(
        "c_custkey * 3000000000 AS id", "c_name AS name", "c_mktsegment AS department", "c_acctbal * 10000 AS salary",
        "c_nationkey AS other").write.parquet(path)
    name = fresh_name("typed")
    spec = PipelineSpec(name, SourceSpec("parquet", path, schema="id BIGINT, name STRING, department STRING, salary DOUBLE"),
                        f"staging.{name}", f"target.{name}_dim", key_type="bigint", int_type="bigint", hash_salt="pepper")
    extract = run_pipelines(spark, [spec], work_dir(spark, "extracts"), "2024-01-31")[name]
    return readers.read_csv(
        spark, extract, schema="id BIGINT, name_masked STRING, department STRING, salary_hash STRING, start_date DATE")


REJECTS_SQL = """
SELECT CASE WHEN c_custkey % 7 <> 0 THEN 'x' || c_custkey END AS key_value,
       CASE WHEN c_custkey % 7 = 0 THEN 'key is missing' ELSE 'key is no int' END AS reason,
       c_name AS name, DATE '2024-01-31' AS load_date
FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0"""


@CHECKS.add(REJECTS_SQL)
def end_to_end_rejects(spark, sf_dir):
    """What a run could not load, after the day was run twice."""
    key = F.when(F.col("c_custkey") % 7 == 0, None).when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("x"), "c_custkey"))
    whole = (F.col("c_custkey") % 7 != 0) & (F.col("c_custkey") % 11 != 0)
    raw = table(spark, sf_dir, "customer").select(
        F.when(whole, F.col("c_custkey").cast("string")).otherwise(key).alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"), F.lit(1).alias("salary"))
    path = tables.export_csv(raw, work_dir(spark, "raw"))
    name = fresh_name("customers")
    spec = PipelineSpec(name, SourceSpec("csv", path), f"staging.{name}", f"target.{name}_dim",
                        rejects_table=f"staging.{name}_rejects")
    for _ in range(2):
        run_pipelines(spark, [spec], work_dir(spark, "extracts"), "2024-01-31")
    return spark.table(spec.rejects_table).select(
        "key_value", "reason", F.get_json_object("source_row", "$.name").alias("name"), "load_date")


@CHECKS.add("SELECT r_regionkey, r_name FROM region")
def src_preview(spark, sf_dir):
    """More rows asked for than there are."""
    return readers.preview(table(spark, sf_dir, "region"), 1000)


@CHECKS.add("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey % 3 <> 0")
def quality_split_corrupt(spark, sf_dir):
    path = work_dir(spark, "corrupt")
    lines = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("{broken "), "n_name")).otherwise(
        F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))))
    table(spark, sf_dir, "nation").select(lines.alias("value")).write.text(path)
    raw = readers.read_json(spark, path, schema="id INT, name STRING, _corrupt_record STRING")
    return quality.split_corrupt(raw)[0]


@CHECKS.add("""
SELECT CAST(c_custkey AS INTEGER) AS id, '****' AS name_masked, c_mktsegment AS department,
       sha256(CAST(CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR)) AS salary_hash,
       CAST('2024-01-31' AS DATE) AS start_date
FROM customer""")
def end_to_end_extract(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("department"),
        F.floor("c_acctbal").cast("int").alias("salary"))
    path = tables.export_csv(raw, work_dir(spark, "raw"))
    spec = PipelineSpec.register(fresh_name("customers"), path)
    extract = run_pipelines(spark, [spec], work_dir(spark, "extracts"), "2024-01-31")[spec.pipeline_name]
    return readers.read_csv(
        spark, extract,
        schema="id INT, name_masked STRING, department STRING, salary_hash STRING, start_date DATE")
