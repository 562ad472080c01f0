"""Binding fields to columns and casting them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.functions.casts import time_field
from loadkit.operators.binding import ERROR, RAW, bind, bind_by_name, bind_expr
from loadkit.operators.loading import load_batch

DDL = T.StructType.fromDDL
EPOCH_START = "timestamp_ntz'1970-01-01 00:00:00'"


@query("""
    SELECT CAST(p_size AS DOUBLE) AS size_number, p_name AS name, p_brand AS brand,
           CAST(p_size AS BIGINT) AS size_count, CAST(p_partkey AS VARCHAR) AS part_text
    FROM part
""")
def bind_reorder_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = DDL("size_number DOUBLE, name STRING, brand STRING, size_count BIGINT, part_text STRING")
    fields = ["p_size", "p_name", "p_brand", "p_size", "p_partkey"]
    return bind(table(spark, sf_dir, "part"), fields, target)


@query("""
    SELECT c_custkey AS cust_key, c_name AS name, 'none' AS phone, CAST(NULL AS INTEGER) AS rating
    FROM customer
""")
def bind_absent_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{workspace(spark)}.customer_core"
    spark.sql(
        f"CREATE TABLE {target} "
        "(cust_key BIGINT, name STRING, phone STRING DEFAULT 'none', rating INT) USING parquet"
    )
    fields = ["c_custkey", "c_name", "c_phone", "c_rating"]
    bound = bind(
        table(spark, sf_dir, "customer"), fields, spark.table(target).schema, on_absent="default"
    )
    load_batch(bound, target)
    return spark.table(target)


@query("""
    SELECT p_partkey AS part_key, upper(p_name) AS name, CAST(p_size + 1 AS INTEGER) AS next_size,
           CAST(round(p_retailprice * 100) AS BIGINT) AS cents
    FROM part
""", name="bind_expr")
def bind_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = DDL("part_key BIGINT, name STRING, next_size INT, cents BIGINT")
    expressions = {
        "part_key": "p_partkey",
        "name": "upper(p_name)",
        "next_size": "p_size + 1",
        "cents": "round(p_retailprice * 100)",
    }
    return bind_expr(table(spark, sf_dir, "part"), expressions, target)


@query("SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal FROM supplier")
def load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{workspace(spark)}.supplier_core"
    schema = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DECIMAL(12,2)"
    spark.sql(f"CREATE TABLE {target} ({schema}) USING parquet")
    shuffled = table(spark, sf_dir, "supplier").select(
        "s_acctbal", "s_nationkey", "s_name", "s_suppkey"
    )
    bound = bind_by_name(shuffled, spark.table(target).schema)
    load_batch(bound.select(*reversed(bound.columns)), target)
    return spark.table(target)


@query("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number,
           CAST(l_quantity AS INTEGER) AS quantity_int, CAST(l_quantity AS BIGINT) AS quantity_long,
           CAST(l_partkey AS VARCHAR) AS part_text, CAST(l_partkey AS DOUBLE) AS part_number
    FROM lineitem
""")
def cast_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = DDL(
        "order_key BIGINT, line_number INT, quantity_int INT, quantity_long BIGINT, "
        "part_text STRING, part_number DOUBLE"
    )
    fields = ["l_orderkey", "l_linenumber", "l_quantity", "l_quantity", "l_partkey", "l_partkey"]
    return bind(table(spark, sf_dir, "lineitem"), fields, target)


@query("""
    SELECT event_id, date_trunc('millisecond', ts) AS ts, date_trunc('millisecond', ts) AS ts_native
    FROM events
""")
def cast_epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = f"timestampdiff(MILLISECOND, {EPOCH_START}, ts) AS millis"
    records = table(spark, sf_dir, "events").selectExpr("event_id", millis, "ts")
    target = DDL("event_id BIGINT, ts TIMESTAMP_NTZ, ts_native TIMESTAMP_NTZ")
    return bind(records, ["event_id", "millis", "ts"], target)


@query("SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS ordered FROM orders")
def cast_epoch_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "datediff(o_orderdate, date'1970-01-01') AS days"
    )
    return bind(records, ["o_orderkey", "days"], DDL("order_key BIGINT, ordered DATE"))


@query("SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS ordered FROM orders")
def cast_date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        CASE WHEN o_orderkey % 2 = 0
             THEN CAST(datediff(o_orderdate, date'1970-01-01') AS STRING)
             ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS day_text
    """
    records = table(spark, sf_dir, "orders").selectExpr("o_orderkey", text)
    return bind(records, ["o_orderkey", "day_text"], DDL("order_key BIGINT, ordered DATE"))


@query("""
    SELECT event_id, CAST(date_diff('millisecond', date_trunc('day', ts), date_trunc('millisecond', ts))
           AS INTEGER) AS time_millis, strftime(ts, '%H:%M:%S.%g') AS time_text
    FROM events
""")
def cast_time_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = "CAST(timestampdiff(MILLISECOND, CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ), ts) AS INT) AS t"
    records = table(spark, sf_dir, "events").selectExpr("event_id", millis)
    tagged = records.withMetadata("t", time_field("t").metadata)
    target = DDL("event_id BIGINT, time_millis INT, time_text STRING")
    return bind(tagged, ["event_id", "t", "t"], target)


@query("""
    SELECT l_orderkey AS order_key, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CAST(l_discount AS DECIMAL(4,2)) AS discount
    FROM lineitem
""")
def cast_decimal_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = DDL("order_key BIGINT, price DECIMAL(12,2), discount DECIMAL(4,2)")
    fields = ["l_orderkey", "l_extendedprice", "l_discount"]
    return bind(table(spark, sf_dir, "lineitem"), fields, target)


@query("""
    WITH records AS (
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber = 3 THEN l_returnflag ELSE CAST(l_partkey AS VARCHAR) END AS part
        FROM lineitem)
    SELECT l_orderkey AS order_key, TRY_CAST(part AS INTEGER) AS part_key,
           CASE WHEN TRY_CAST(part AS INTEGER) IS NULL THEN 'part' END AS error,
           CASE WHEN TRY_CAST(part AS INTEGER) IS NULL
                THEN '{"l_orderkey":' || l_orderkey || ',"part":"' || part || '"}' END AS raw
    FROM records
""")
def cast_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "CASE WHEN l_linenumber = 3 THEN l_returnflag ELSE CAST(l_partkey AS STRING) END AS part"
    records = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", text)
    target = DDL("order_key BIGINT, part_key INT")
    bound = bind(records, ["l_orderkey", "part"], target, errors=True)
    return bound.withColumnsRenamed({ERROR: "error", RAW: "raw"})
