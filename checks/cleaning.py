"""Cleansing, quality, conversion and shape."""

from pyspark.sql import functions as F

from checks.base import Checks, fresh_name, table
from dimflow.functions import convert, text
from dimflow.operators import cleaning, quality, shape
from dimflow.plans import key_index
from dimflow.spec import PipelineSpec, SourceSpec

CHECKS = Checks()

_TITLE = "array_to_string(list_transform(string_split(lower(trim({0})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@CHECKS.add(f"SELECT p_partkey, {_TITLE.format('p_name')} AS name, "
            f"{_TITLE.format(chr(39) + '  ' + chr(39) + ' || upper(p_type) || ' + chr(39) + ' ' + chr(39))} AS kind "
            "FROM part")
def clean_initcap(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.upper("p_type"), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", text.trim_initcap(F.col("p_name")).alias("name"),
                                               text.trim_initcap(padded).alias("kind"))


# numbers with fractions, words and NULLs in one text column
_RAW = ("CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN c_name "
        "WHEN c_acctbal > 9000 THEN '99999999999' WHEN c_acctbal < 0 THEN ' ' || CAST(c_acctbal AS VARCHAR(20)) || ' ' "
        "ELSE CAST(c_acctbal AS VARCHAR(20)) END")
_INT = "TRY_CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS INTEGER)"


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment",
                                                       f"{_RAW.replace('VARCHAR(20)', 'STRING')} AS raw")


@CHECKS.add(f"SELECT c_custkey, CASE WHEN raw IS NULL THEN 0 ELSE {_INT} END AS amount "
            f"FROM (SELECT *, {_RAW} AS raw FROM customer)")
def clean_fill_null(spark, sf_dir):
    return _texts(spark, sf_dir).select("c_custkey", convert.fill_null(F.col("raw"), 0).alias("amount"))


@CHECKS.add(f"SELECT c_custkey, {_INT} AS amount FROM (SELECT *, {_RAW} AS raw FROM customer)")
def clean_cast_int(spark, sf_dir):
    return _texts(spark, sf_dir).select("c_custkey", convert.cast_int_lenient(F.col("raw")).alias("amount"))


@CHECKS.add(f"SELECT c_custkey, amount FROM (SELECT *, {_INT} AS amount FROM (SELECT *, {_RAW} AS raw FROM customer)) "
            "WHERE amount IS NOT NULL")
def clean_require_key(spark, sf_dir):
    keyed = _texts(spark, sf_dir).select("c_custkey", convert.cast_int_lenient(F.col("raw")).alias("amount"))
    return cleaning.require_key(keyed, "amount")


@CHECKS.add(f"""
SELECT CAST(c_custkey AS INTEGER) AS id, {_TITLE.format('c_name')} AS name, c_mktsegment AS department,
       CASE WHEN raw IS NULL THEN 0 ELSE {_INT} END AS salary
FROM (SELECT *, {_RAW} AS raw FROM customer) WHERE c_mktsegment <> 'FURNITURE'""")
def clean_full(spark, sf_dir):
    # one segment has unusable keys
    raw = _texts(spark, sf_dir).select(
        F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_name")).otherwise(F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("name"), F.col("c_mktsegment").alias("department"),
        F.col("raw").alias("salary"))
    spec = PipelineSpec("customers", SourceSpec("csv", "unused"), "staging.customers", "target.customers_dim")
    return cleaning.clean(raw, spec)


@CHECKS.add(f"""
SELECT c_custkey * 3000000000 AS id, {_TITLE.format('c_name')} AS name, c_mktsegment AS department,
       CASE WHEN c_acctbal > 9000 THEN 0 ELSE CAST(trunc(c_acctbal * 1000000) AS BIGINT) END AS salary
FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def clean_typed_source(spark, sf_dir):
    """Keys beyond 32 bits and numbers that text would show with an exponent."""
    raw = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey") * 3_000_000_000).alias("id"),
        F.lower("c_name").alias("name"), F.col("c_mktsegment").alias("department"),
        F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal") * 1_000_000).alias("salary"))
    spec = PipelineSpec("customers", SourceSpec("parquet", "unused"), "staging.customers", "target.customers_dim",
                        key_type="bigint", int_type="bigint")
    return cleaning.clean(raw, spec)


@CHECKS.add("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def dedup_by_columns(spark, sf_dir):
    return cleaning.drop_duplicates(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"]).select(
        "c_mktsegment", "c_nationkey")


_HOLES = ("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, "
          "CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS priority, "
          "CASE WHEN o_totalprice < 300000 THEN o_totalprice END AS price FROM {0}")


@CHECKS.add("SELECT o_orderkey, status, coalesce(priority, 'none') AS priority, price FROM "
            f"({_HOLES.format('orders')}) WHERE status IS NOT NULL AND (priority IS NOT NULL OR price IS NOT NULL)")
def clean_nulls(spark, sf_dir):
    rows = spark.sql(_HOLES.format("{orders}"), orders=table(spark, sf_dir, "orders"))
    return cleaning.handle_nulls(rows, {"priority": "none"}, ["status"], ["priority", "price"])


@CHECKS.add("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_rows(spark, sf_dir):
    return cleaning.drop_duplicates(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@CHECKS.add("SELECT user_id, event_id, ts, event_type, value FROM events "
            "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def dedup_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return cleaning.dedup_latest(events, ["user_id"], ["ts", "event_id"])


@CHECKS.add(CHECKS[-1].sql)
def dedup_latest_incremental(spark, sf_dir):
    """The events in three deliveries, each merged into an index of the newest ones by user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    name = f"target.{fresh_name('newest')}"
    for day in (1, 0, 2):
        found = key_index.merge_latest(events.filter(F.col("event_id") % 3 == day), name, ["user_id"], ["ts", "event_id"], 16)
    return found


_BROKEN = ("SELECT o_orderkey, nullif(o_custkey, 0) AS o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, "
           "o_totalprice, o_orderpriority FROM {0}")
_RULES = ("o_orderstatus_not_null", "o_totalprice_range", "o_orderpriority_regex", "o_orderstatus_in_set",
          "o_custkey_unique", "o_custkey_foreign_key")
_FAILS = """
SELECT o.*, o_orderstatus IS NULL AS f0, o_totalprice < 5000 OR o_totalprice > 400000 AS f1,
       NOT regexp_matches(o_orderpriority, '^[1-3]-') AS f2,
       o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F') AS f3,
       o_custkey IS NOT NULL AND count(*) OVER (PARTITION BY o_custkey) > 1 AS f4,
       o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS f5
FROM ({0}) o""".replace("{0}", _BROKEN.format("orders"))
_NAMES = "concat_ws(','" + "".join(f", CASE WHEN f{i} THEN '{n}' END" for i, n in enumerate(_RULES)) + ")"


def _orders_and_rules(spark, sf_dir):
    rows = spark.sql(_BROKEN.format("{orders}"), orders=table(spark, sf_dir, "orders"))
    solvent = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return rows, [quality.not_null("o_orderstatus"), quality.in_range("o_totalprice", 5000, 400000),
                  quality.matches("o_orderpriority", "^[1-3]-"), quality.in_set("o_orderstatus", ["F"]),
                  quality.unique("o_custkey"), quality.foreign_key("o_custkey", solvent, "c_custkey")]


@CHECKS.add(f"SELECT o_orderkey, {_NAMES} AS violations FROM ({_FAILS})")
def quality_violations(spark, sf_dir):
    checked = quality.validate(*_orders_and_rules(spark, sf_dir))
    return checked.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@CHECKS.add(" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS checked, count(*) FILTER (WHERE f{i}) AS failed "
                               f"FROM ({_FAILS})" for i, n in enumerate(_RULES)))
def quality_report(spark, sf_dir):
    return quality.quality_report(*_orders_and_rules(spark, sf_dir))


@CHECKS.add("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
            f"FROM ({_FAILS}) WHERE NOT (f0 OR f1 OR f2 OR coalesce(f3, false) OR f5)")
def quality_valid(spark, sf_dir):
    # without the rule on repeated customers, which nearly every order breaks
    rows, rules = _orders_and_rules(spark, sf_dir)
    return quality.split_valid(rows, [r for r in rules if r.kind != "unique"])[0]


@CHECKS.add(f"SELECT o_orderkey, o_custkey, o_orderstatus, {_NAMES} AS violations FROM ({_FAILS}) WHERE {_NAMES} <> ''")
def quality_rejects(spark, sf_dir):
    rejects = quality.split_valid(*_orders_and_rules(spark, sf_dir))[1]
    return rejects.select("o_orderkey", "o_custkey", "o_orderstatus", F.array_join("violations", ",").alias("violations"))


_CODES = {"BUILDING": "B", "MACHINERY": "M", "AUTOMOBILE": "A"}


@CHECKS.add("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' "
            "WHEN 'AUTOMOBILE' THEN 'A' ELSE 'X' END AS segment, lower(c_name) AS name FROM customer")
def clean_standardize(spark, sf_dir):
    messy = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" \t"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.standardize(messy, "upper", True, _CODES, "X").alias("segment"),
        text.standardize(F.col("c_name"), "lower").alias("name"))


@CHECKS.add("SELECT c_custkey, coalesce(n_name, 'elsewhere') AS nation FROM customer "
            "LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey")
def clean_map_codes(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").filter("n_regionkey <> 1")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return cleaning.map_codes(rows, "c_nationkey", codes, "n_nationkey", "n_name", "nation",
                              "elsewhere").select("c_custkey", "nation")


@CHECKS.add("SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 3, '0') AS key3, rpad(p_name, 12, '.') AS name12 FROM part")
def clean_pad(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.pad(F.col("p_partkey").cast("string"), 3, "0").alias("key3"),
        text.pad(F.col("p_name"), 12, ".", "right").alias("name12"))


@CHECKS.add("""
SELECT o_orderkey, strftime(try_strptime(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
           ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y'), '%Y%m%d') AS day
FROM orders""")
def convert_date(spark, sf_dir):
    written = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", convert.convert_date(written, "dd/MM/yyyy", "yyyyMMdd").alias("day"))


@CHECKS.add("SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_ts FROM events")
def convert_tz(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", convert.convert_zone(F.col("ts"), "UTC", "America/New_York").alias("local_ts"))


@CHECKS.add("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN true WHEN '4-NOT SPECIFIED' THEN false
       WHEN '5-LOW' THEN false END AS urgent
FROM orders""")
def convert_bool(spark, sf_dir):
    words = (F.when(F.col("o_orderpriority") == "1-URGENT", " Yes").when(F.col("o_orderpriority") == "2-HIGH", "T")
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "no ").when(F.col("o_orderpriority") == "5-LOW", "0")
             .otherwise("perhaps"))
    return table(spark, sf_dir, "orders").select("o_orderkey", convert.normalize_bool(words).alias("urgent"))


@CHECKS.add("""
SELECT c_custkey, c_acctbal * (n_nationkey * 0.5 + 1) + n_regionkey AS converted FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_name = 'NATION_' || c_nationkey""")
def convert_unit(spark, sf_dir):
    factors = table(spark, sf_dir, "nation").filter("n_regionkey <> 2").selectExpr(
        "n_name AS unit", "n_nationkey * 0.5D + 1 AS factor", "n_regionkey AS offset")
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_acctbal", "'NATION_' || c_nationkey AS unit")
    return cleaning.convert_unit(rows, "c_acctbal", "unit", factors, "converted").select("c_custkey", "converted")


@CHECKS.add("SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal AS balance FROM supplier")
def shape_rename(spark, sf_dir):
    return shape.rename(table(spark, sf_dir, "supplier"), {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})


@CHECKS.add("SELECT s_acctbal, s_name, s_suppkey, s_nationkey FROM supplier")
def shape_reorder(spark, sf_dir):
    return shape.reorder(table(spark, sf_dir, "supplier"), ["s_acctbal", "s_name"])


@CHECKS.add("SELECT s_suppkey, s_name, s_acctbal < 0 AS in_debt, 'supplier' AS kind FROM supplier")
def shape_add_drop(spark, sf_dir):
    rows = shape.add_columns(table(spark, sf_dir, "supplier"),
                             {"in_debt": F.col("s_acctbal") < 0, "kind": F.lit("supplier")})
    return shape.drop_columns(rows, ["s_nationkey", "s_acctbal"])
