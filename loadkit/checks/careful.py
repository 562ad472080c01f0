"""What goes wrong easily: other formats, typed keys, letter case, declared lengths, retries."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext, new_context, with_context
from loadkit.operators.binding import ERROR, RAW, bind, bind_by_name, bind_expr
from loadkit.operators.elt import latest_per_key, publish_merge, purge
from loadkit.operators.loading import core_schema, create_core, load_many, load_staged
from loadkit.operators.routing import route
from loadkit.plans.outcomes import FAILED, LOADED, read_outcomes
from loadkit.plans.run import LoadSpec, Unit, run_load
from loadkit.session import scratch_path
from loadkit.sources.records import UNIT

CHANGED = "CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END"


@query(f"SELECT c_custkey, c_name, {CHANGED} AS c_acctbal FROM customer")
def merge_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge keeps the format of an unpartitioned table, in a folder with dashes in its name."""
    core = f"{workspace(spark)}.customer_core"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "my--data")
    customers.write.format("orc").option("path", path).saveAsTable(core)
    changed = customers.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.expr("c_acctbal + 1"))
    publish_merge(spark, core, changed, ["c_custkey"])
    publish_merge(spark, core, changed, ["c_custkey"])
    return spark.table(core)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0")
def purge_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one of two loads go from an unpartitioned table that is not Parquet."""
    core, first, second = f"{workspace(spark)}.core", new_context(), new_context()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    even, odd = customers.filter("c_custkey % 2 = 0"), customers.filter("c_custkey % 2 = 1")
    loads = with_context(even, first).unionByName(with_context(odd, second))
    loads.write.format("orc").saveAsTable(core)
    purge(spark, core, second)
    return spark.table(core).select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def load_orc_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads attach files in the format of their core table."""
    core = f"{workspace(spark)}.supplier_core"
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    spark.sql(
        f"CREATE TABLE {core} (s_suppkey BIGINT, s_name STRING, s_nationkey BIGINT, {TABLE_ID} STRING,"
        f" {COMMIT_EPOCH} INT) USING orc PARTITIONED BY ({TABLE_ID}, {COMMIT_EPOCH})"
    )
    ctx = new_context()
    for part in (0, 1):
        rows = suppliers.filter(f"s_suppkey % 2 = {part}")
        load_staged(bind_by_name(rows, core_schema(spark, core)), core, ctx)
        ctx = ctx.next_epoch()
    return spark.table(core).drop(TABLE_ID, COMMIT_EPOCH)


def _routed(spark: SparkSession, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Every row of a routing with the target it went to."""
    targets = route(rows, keys, "k")
    parts = [df.withColumn("target", F.lit(t or "none")) for t, df in targets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("event_id", "target")


@query("""
    SELECT event_id, CASE WHEN value IS NULL THEN 'none' WHEN value > 50 THEN 'high' ELSE 'low' END
           AS target FROM events
""")
def route_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "value > 50 AS k")
    keys = spark.createDataFrame([(True, "high"), (False, "low")], "k boolean, target string")
    return _routed(spark, rows, keys)


@query("""
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'whole' WHEN 1 THEN 'part' ELSE 'none' END AS target
    FROM events
""")
def route_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = "timestampadd(MILLISECOND, event_id % 3 * 250, TIMESTAMP '2024-01-01 00:00:00')"
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{at} AS k")
    keys = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:00' AS k, 'whole' AS target"
        " UNION ALL SELECT TIMESTAMP '2024-01-01 00:00:00.25', 'part'"
    )
    return _routed(spark, rows, keys)


@query("""
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'large' ELSE 'none' END AS target
    FROM events
""")
def route_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "event_id % 3 * 1e20 AS k")
    keys = spark.createDataFrame([(0.0, "zero"), (1e20, "large")], "k double, target string")
    return _routed(spark, rows, keys)


@query("""
    SELECT event_id, epoch_ms(1704067200123 + event_id) AS at, upper(event_type) AS kind FROM events
""")
def bind_expr_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole number that an expression gives is a moment in milliseconds, as a field would be."""
    target = T.StructType.fromDDL("event_id BIGINT, at TIMESTAMP_NTZ, kind STRING")
    expressions = {"event_id": "event_id", "at": "1704067200123 + event_id", "kind": "upper(event_type)"}
    return bind_expr(table(spark, sf_dir, "events"), expressions, target)


@query("""
    SELECT event_id, CAST(json_object('event_id', event_id, 'event_type', event_type) AS VARCHAR) AS raw
    FROM events
""")
def expr_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure output holds the fields as they were read, not what was computed from them."""
    target = T.StructType.fromDDL("event_id BIGINT, kind INT")
    expressions = {"event_id": "event_id", "kind": "upper(event_type)"}
    bound = bind_expr(table(spark, sf_dir, "events"), expressions, target, errors=True)
    return bound.filter(F.col(ERROR) == "kind").select("event_id", F.col(RAW).alias("raw"))


@query("SELECT n_nationkey, n_name FROM nation")
def load_by_name_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields feed columns of the same name in any letter case."""
    target = T.StructType.fromDDL("n_nationkey BIGINT, n_name STRING")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS N_NationKey", "n_name AS N_NAME")
    return bind_by_name(nation, target)


@query("SELECT r_regionkey, 'none' AS origin FROM region")
def core_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A core table keeps the defaults of its schema, and loads fill absent fields with them."""
    db = workspace(spark)
    spark.sql(f"CREATE TABLE {db}.model (r_regionkey BIGINT, origin STRING DEFAULT 'none') USING parquet")
    create_core(spark, f"{db}.core", spark.table(f"{db}.model").schema)
    rows = table(spark, sf_dir, "region").select("r_regionkey")
    target = core_schema(spark, f"{db}.core")
    load_staged(bind_by_name(rows, target, on_absent="default"), f"{db}.core", new_context())
    return spark.table(f"{db}.core").drop(TABLE_ID, COMMIT_EPOCH)


@query("SELECT event_id, date_trunc('milliseconds', ts) AS at FROM events")
def cast_text_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments in text are bound to the millisecond."""
    text = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') || '789' AS at"
    rows = table(spark, sf_dir, "events").selectExpr("event_id", text)
    return bind(rows, ["event_id", "at"], T.StructType.fromDDL("event_id BIGINT, at TIMESTAMP_NTZ"))


@query("""
    SELECT c_custkey, CASE WHEN length(c_mktsegment) > 9 THEN 'c_mktsegment' END AS error,
           CASE WHEN length(c_mktsegment) <= 9 THEN c_mktsegment END AS segment
    FROM customer
""")
def varchar_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is longer than its column is an error of its record."""
    core = f"{workspace(spark)}.core"
    spark.sql(f"CREATE TABLE {core} (c_custkey BIGINT, segment VARCHAR(9)) USING parquet")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    bound = bind(rows, rows.columns, core_schema(spark, core), errors=True)
    return bound.select("c_custkey", F.col(ERROR).alias("error"), "segment")


@query("""
    SELECT event_type, max(event_id) AS event_id, 1 AS tags FROM events GROUP BY event_type
""")
def latest_with_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of a key may hold a map, which has no order of its own."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_type", "event_id", "map('value', cast(value AS string)) AS tags"
    )
    latest = latest_per_key(events, ["event_type"], ["event_id"])
    return latest.select("event_type", "event_id", F.size("tags").alias("tags"))


@query(f"SELECT c_custkey, {CHANGED} AS c_acctbal, CAST(c_custkey % 3 = 0 AS INTEGER) AS epoch FROM customer")
def merge_load_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table partitioned by load: merged rows belong to the load that brought them."""
    core, ctx = f"{workspace(spark)}.core", new_context()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    create_core(spark, core, customers.schema)
    load_staged(customers, core, ctx)
    changed = customers.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.expr("c_acctbal + 1"))
    publish_merge(spark, core, changed, ["c_custkey"], ctx=ctx.next_epoch())
    return spark.table(core).select("c_custkey", "c_acctbal", F.col(COMMIT_EPOCH).alias("epoch"))


@query("""
    SELECT CAST(5 + dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS epoch,
           count(*) AS update_count
    FROM orders GROUP BY o_orderstatus
""")
def update_count_second_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of many units counts its own loads only."""
    core, ctx = f"{workspace(spark)}.core", new_context()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    create_core(spark, core, orders.schema)
    load_many(orders, ["o_orderpriority"], core, ctx)
    counts = load_many(orders, ["o_orderstatus"], core, RunContext(ctx.table_id, 5))
    return counts.select(F.col(COMMIT_EPOCH).alias("epoch"), "update_count")


@query("SELECT p_partkey, p_name FROM part")
def retry_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that failed before its publish is tried again under the same id and epoch."""
    core, ctx = f"{workspace(spark)}.core", new_context()
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    create_core(spark, core, part.schema)

    def refuse(rows: DataFrame) -> None:
        raise ValueError("not yet")

    with suppress(ValueError):
        load_staged(part, core, ctx, check=refuse)
    load_staged(part, core, ctx)
    return spark.table(core).drop(TABLE_ID, COMMIT_EPOCH)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load events in one unit of several files, one by type; values above 90 cannot be cast."""
    core, out = f"{workspace(spark)}.core", scratch_path(spark, "outcomes")
    create_core(spark, core, T.StructType.fromDDL("event_id BIGINT, value INT"))
    value = "CASE WHEN value > 90 AND event_type < 'm' THEN 'much' ELSE '1' END AS value"
    events = table(spark, sf_dir, "events").selectExpr("event_id", value, f"event_type AS {UNIT}")
    unit = Unit("all types", 0, lambda s: events)
    run_load(spark, [unit], LoadSpec(target=core, fields=["event_id", "value"], outcomes=out))
    return read_outcomes(spark, out)


OUTCOMES = """
    SELECT event_type AS unit, count(*) AS n, count(*) FILTER (value > 90 AND event_type < 'm') AS bad
    FROM events GROUP BY event_type HAVING bad {test}
"""


@query(OUTCOMES.format(test="= 0"))
def success_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a unit that were loaded, with their records."""
    found = _outcomes(spark, sf_dir).filter(F.col("status") == LOADED)
    return found.select(F.col(UNIT).alias("unit"), F.col("rows").alias("n"), "bad")


@query(OUTCOMES.format(test="> 0"))
def failed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the same unit that were kept out for their bad records."""
    found = _outcomes(spark, sf_dir).filter(F.col("status") == FAILED)
    return found.select(F.col(UNIT).alias("unit"), F.col("rows").alias("n"), "bad")
