"""Loading units into tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext, fill_placeholders, new_context
from loadkit.operators.binding import bind, bind_by_name
from loadkit.operators.elt import drop_staging, loaded_rows, publish_append, purge
from loadkit.operators.loading import (
    LOAD_COLUMNS,
    STAGING_NAME,
    columns_ddl,
    core_schema,
    create_core,
    create_staging,
    load_batch,
    load_many,
    load_staged,
)
from loadkit.operators.routing import route
from loadkit.operators.units import bin_units, load_context, unit_counts
from loadkit.plans.run import run_routes
from loadkit.sources.records import UNIT, read_records

LINEITEM_FIELDS = [
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_returnflag",
]
LINEITEM_TARGET = (
    T.StructType()
    .add("order_key", T.LongType())
    .add("part_key", T.IntegerType())
    .add("line_number", T.LongType())
    .add("quantity", T.DoubleType())
    .add("price", T.DecimalType(12, 2))
    .add("return_flag", T.StringType())
)
LINEITEM_SQL = """
    SELECT l_orderkey AS order_key, CAST(l_partkey AS INTEGER) AS part_key,
           CAST(l_linenumber AS BIGINT) AS line_number, l_quantity AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_returnflag AS return_flag
    FROM lineitem
"""
# A context with a known id, for queries that show it.
KNOWN = RunContext("0123abcdef")


@query(LINEITEM_SQL)
def load_batch_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan records, bind and cast six fields, write them unseen, attach them to the core table."""
    core, ctx = f"{workspace(spark)}.lineitem_core", new_context()
    create_core(spark, core, LINEITEM_TARGET)
    schema = table(spark, sf_dir, "lineitem").schema
    records = read_records(spark, f"{sf_dir}/lineitem.parquet", "parquet", schema)
    bound = bind(records, LINEITEM_FIELDS, core_schema(spark, core), "error", errors=True)
    load_staged(bound, core, ctx)
    return loaded_rows(spark.table(core), ctx).drop(*LOAD_COLUMNS)


@query(LINEITEM_SQL)
def load_append_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load by way of a staging table that is copied into an unpartitioned core table."""
    db, ctx = workspace(spark), new_context()
    core, staging = f"{db}.lineitem_core", f"{db}.{STAGING_NAME}"
    spark.sql(f"CREATE TABLE {core} ({columns_ddl(LINEITEM_TARGET)}) USING parquet")
    name = create_staging(spark, core, staging, ctx)
    load_batch(bind(table(spark, sf_dir, "lineitem"), LINEITEM_FIELDS, LINEITEM_TARGET), name)
    publish_append(spark, name, core)
    drop_staging(spark, staging, ctx)
    return spark.table(core)


@query("""
    SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS COMMIT_EPOCH,
           count(*) AS update_count
    FROM orders GROUP BY o_orderpriority
""")
def update_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per unit of a load of many units."""
    core = f"{workspace(spark)}.orders_core"
    orders = table(spark, sf_dir, "orders")
    create_core(spark, core, orders.schema)
    return load_many(orders, ["o_orderpriority"], core, new_context()).drop(TABLE_ID)


@query("""
    SELECT o_orderkey, o_orderpriority, '0123abcdef' AS TABLE_ID,
           CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS COMMIT_EPOCH
    FROM orders
""")
def context_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return load_context(orders, ["o_orderpriority"], KNOWN)


@query("""
    SELECT event_id, replace(replace(
        'INSERT INTO ' || event_type || '_%TABLE_ID%_%COMMIT_EPOCH% -- %table_id% %COMMIT_EPOCH%',
        '%TABLE_ID%', '0123abcdef'), '%COMMIT_EPOCH%', CAST(user_id AS VARCHAR)) AS statement
    FROM events
""")
def placeholder_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements held in a column, one per unit."""
    template = F.concat(
        F.lit("INSERT INTO "),
        "event_type",
        F.lit("_%TABLE_ID%_%COMMIT_EPOCH% -- %table_id% %COMMIT_EPOCH%"),
    )
    statement = fill_placeholders(template, F.lit(KNOWN.table_id), F.col("user_id"))
    return table(spark, sf_dir, "events").select("event_id", statement.alias("statement"))


@query("""
    SELECT 'core_' || event_type AS target, count(*) AS n, max(event_id) AS last_event
    FROM events GROUP BY event_type
""")
def route_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow into several targets: the rows are written once, each target reads its own."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    control = events.select("event_type").distinct()
    control = control.withColumn("target", F.concat(F.lit("core_"), "event_type"))
    parts = [
        rows.select(F.lit(target).alias("target"), "event_id")
        for target, rows in route(events, control, "event_type").items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


@query("SELECT event_type, event_id, CAST(value AS DECIMAL(12,2)) AS amount FROM events")
def route_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type is loaded into a table of its own, with statements from a control table."""
    db = workspace(spark)
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    control = events.select("event_type").distinct().selectExpr(
        "event_type",
        f"concat('{db}.', event_type) AS target",
        "array('event_id', 'value') AS fields",
        f"""array(concat('CREATE TABLE {db}.', event_type,
            ' (event_id BIGINT, amount DECIMAL(12,2)) USING parquet')) AS before_loading""",
    )
    run_routes(spark, events, control, "event_type")
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {db}").collect()]
    parts = [spark.table(f"{db}.{n}").withColumn("event_type", F.lit(n)) for n in names]
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM (
        SELECT *, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS epoch FROM orders)
    WHERE epoch <> 2
""")
def purge_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five units are loaded, the third is purged again."""
    core, ctx = f"{workspace(spark)}.orders_core", new_context()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    create_core(spark, core, orders.schema)
    load_many(orders, ["o_orderpriority"], core, ctx)
    purge(spark, core, ctx.next_epoch().next_epoch())
    return spark.table(core).drop(*LOAD_COLUMNS)


@query("""
    SELECT doc_id, CAST(floor((sum(n_chars) OVER (ORDER BY doc_id) - n_chars) / 100000) AS BIGINT) AS bin
    FROM documents
""", name="bin_units")
def bin_small_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive documents gathered into units of about 100,000 characters."""
    listing = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return bin_units(listing, 100_000, ["doc_id"], "n_chars").select("doc_id", "bin")


@query("SELECT user_id, count(*) AS update_count FROM events GROUP BY user_id")
def unit_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_counts(table(spark, sf_dir, "events"), ["user_id"])


@query("SELECT conv_id, turn, role, text FROM conversations")
def load_by_unit_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose rows are bound by name and keep the unit they came from out of the target."""
    core, ctx = f"{workspace(spark)}.conversations_core", new_context()
    schema = table(spark, sf_dir, "conversations").schema
    create_core(spark, core, schema)
    records = read_records(spark, f"{sf_dir}/conversations.parquet", "parquet", schema)
    bound = bind_by_name(records, core_schema(spark, core), keep=(UNIT,), errors=True)
    load_staged(bound, core, ctx)
    return spark.table(core).filter(F.col(COMMIT_EPOCH) == 0).drop(*LOAD_COLUMNS)
