"""Hashing, masking, encryption and access rules."""

from pyspark.sql import functions as F

from checks.base import Checks, fresh_name, table
from checks.dimensions import DAYS, state, _sql
from dimflow.functions import protect
from dimflow.operators import access
from dimflow.plans.pipeline import apply_scd
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, SourceSpec

CHECKS = Checks()

_SEGMENT = "nullif(c_mktsegment, 'BUILDING')"


@CHECKS.add(f"SELECT c_custkey, sha256(concat_ws('||', c_name, {_SEGMENT}, CAST(c_nationkey AS VARCHAR))) AS hash FROM customer")
def hash_row(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", f"{_SEGMENT} AS segment", "c_nationkey")
    return rows.select("c_custkey", protect.row_hash(["c_name", "segment", "c_nationkey"]).alias("hash"))


@CHECKS.add("SELECT c_custkey, '****' AS name_masked FROM customer")
def mask_constant(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", protect.mask_constant().alias("name_masked"))


@CHECKS.add(f"SELECT c_custkey, sha256(CAST(c_nationkey AS VARCHAR)) AS nation_hash, sha256({_SEGMENT}) AS segment_hash, "
            "sha256('s1' || c_name) AS name_hash FROM customer")
def hash_column(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", protect.hash_column(F.col("c_nationkey")).alias("nation_hash"),
        protect.hash_column(F.expr(_SEGMENT)).alias("segment_hash"),
        protect.hash_column(F.col("c_name"), "s1").alias("name_hash"))


@CHECKS.add(f"""
SELECT id, '****' AS name_masked, department, sha256(CAST(salary AS VARCHAR)) AS salary_hash,
       CASE WHEN o.old IS NULL OR (o.name, o.department, o.salary) IS DISTINCT FROM (n.name, n.department, n.salary)
            THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS start_date
FROM {_sql(1)} n LEFT JOIN (SELECT id, name, department, salary, true AS old FROM {_sql(0)}) o USING (id)
UNION ALL
SELECT id, '****', department, sha256(CAST(salary AS VARCHAR)), DATE '2024-01-01'
FROM {_sql(0)} WHERE id NOT IN (SELECT id FROM {_sql(1)})""".replace(", department, sha256(CAST(salary AS VARCHAR)) AS",
                                                                 ", n.department, sha256(CAST(n.salary AS VARCHAR)) AS"))
def secure_view(spark, sf_dir):
    name = fresh_name("customers")
    spec = PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}_dim", 2)
    for day in (0, 1):
        apply_scd(overwrite_table(state(spark, sf_dir, day), spec.staging_table), spec, DAYS[day])
    return spark.table(access.create_secure_view(spark, spec))


@CHECKS.add("SELECT c_custkey, '****' AS c_name_masked, sha256(CAST(c_nationkey AS VARCHAR)) AS c_nationkey_hash, "
            "c_acctbal, c_mktsegment FROM customer")
def mask_policy(spark, sf_dir):
    return access.mask_by_policy(table(spark, sf_dir, "customer"), ["c_name"], ["c_nationkey"])


@CHECKS.add("SELECT c_custkey, c_name AS opened, true AS hidden, CAST(NULL AS VARCHAR) AS wrong_key FROM customer")
def encrypt_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("secret", protect.encrypt(F.col("c_name"), F.lit("0123456789abcdef")))
    return rows.select("c_custkey", protect.decrypt(F.col("secret"), F.lit("0123456789abcdef")).alias("opened"),
                       (F.col("secret") != F.col("c_name")).alias("hidden"),
                       protect.decrypt(F.col("secret"), F.lit("fedcba9876543210")).alias("wrong_key"))


@CHECKS.add("SELECT c.* FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
            "WHERE r_name = 'ASIA'")
def row_policy(spark, sf_dir):
    # a region's desk may see the customers of its nations
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("principal"))
    grants = table(spark, sf_dir, "nation").join(region, "n_regionkey").select(
        "principal", F.col("n_nationkey").alias("c_nationkey"))
    return access.row_policy(table(spark, sf_dir, "customer"), grants, "c_nationkey", "ASIA")


@CHECKS.add("SELECT c_custkey, '****' AS c_name, sha256(c_mktsegment) AS c_mktsegment FROM customer")
def column_policy(spark, sf_dir):
    roles = {"analyst": {"c_custkey": "clear", "c_name": "masked", "c_mktsegment": "hashed", "c_acctbal": "absent"}}
    return access.column_policy(table(spark, sf_dir, "customer"), roles, "analyst")
