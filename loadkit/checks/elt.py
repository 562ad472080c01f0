"""ELT over loaded rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.checks import query, table, workspace
from loadkit.operators.elt import latest_per_key, publish_merge, rollup


@query("""
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events)
    WHERE rn = 1
""", name="latest_per_key")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
           CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
    FROM customer
    UNION ALL
    SELECT c_custkey + 1000000000000, c_name, c_nationkey, c_mktsegment, c_acctbal FROM customer
""")
def merge_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers change twice, others stay, and as many new ones arrive."""
    core = f"{workspace(spark)}.customer_core"
    customers = table(spark, sf_dir, "customer")
    customers.write.saveAsTable(core)
    changed = customers.filter("c_mktsegment <> 'HOUSEHOLD'")
    new_key = F.col("c_custkey") + F.lit(1_000_000_000_000)
    versions = [
        changed.withColumns({"c_acctbal": F.col("c_acctbal") + 10, "version": F.lit(1)}),
        changed.withColumns({"c_acctbal": F.col("c_acctbal") + 100, "version": F.lit(2)}),
        customers.withColumns({"c_custkey": new_key, "version": F.lit(1)}),
    ]
    staged = versions[0].unionByName(versions[1]).unionByName(versions[2])
    publish_merge(spark, core, staged, ["c_custkey"], ["version"])
    return spark.table(core)


@query("""
    SELECT o_orderkey, o_orderstatus,
           o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_totalprice,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '1-URGENT'
                ELSE o_orderpriority END AS o_orderpriority
    FROM orders
""")
def merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge that moves rows between the partitions of the core table."""
    core = f"{workspace(spark)}.orders_core"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    orders.write.partitionBy("o_orderpriority").saveAsTable(core)
    raised = F.when(F.col("o_orderpriority") == "5-LOW", "1-URGENT").otherwise(
        F.col("o_orderpriority")
    )
    staged = orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderpriority": raised}
    )
    publish_merge(spark, core, staged, ["o_orderkey"])
    return spark.table(core)


@query("""
    SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS n, min(value) AS low,
           max(value) AS high, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM events GROUP BY 1, 2
""")
def rollup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {
        "n": F.count(F.lit(1)),
        "low": F.min("value"),
        "high": F.max("value"),
        "total": F.sum(F.col("value").cast("decimal(18,2)")),
    }
    return rollup(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], aggs)
