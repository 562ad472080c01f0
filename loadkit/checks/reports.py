"""Scripts, runs and reports."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.context import RunContext
from loadkit.operators.loading import create_core
from loadkit.plans.report import (
    REPORT_SCHEMA,
    explode_steps,
    report_json,
    step_summary,
    with_meantime,
)
from loadkit.plans.run import LoadSpec, Unit, open_run, run_load
from loadkit.plans.scripts import append_rows, result_rows, run_script
from loadkit.session import scratch_path
from loadkit.sources.records import read_records


@query("""
    SELECT 0 AS statement_no, CAST(json_object('o_orderpriority', o_orderpriority, 'n', count(*))
           AS VARCHAR) AS row FROM orders GROUP BY o_orderpriority
    UNION ALL
    SELECT 1, CAST(json_object('event_type', event_type, 'first_event', min(event_id)) AS VARCHAR)
    FROM events GROUP BY event_type
    UNION ALL
    SELECT 3, CAST(json_object('n_regionkey', n_regionkey, 'nations', count(*)) AS VARCHAR)
    FROM nation GROUP BY n_regionkey
""")
def script_resultsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script of four statements; the third returns no rows, null columns are left out."""
    statements = [
        f"SELECT o_orderpriority, count(*) AS n FROM parquet.`{sf_dir}/orders.parquet` GROUP BY 1",
        f"""SELECT event_type, min(event_id) AS first_event, CAST(NULL AS INT) AS nothing
            FROM parquet.`{sf_dir}/events.parquet` GROUP BY 1""",
        f"SELECT * FROM parquet.`{sf_dir}/labels.parquet` WHERE quality < 0",
        f"SELECT n_regionkey, count(*) AS nations FROM parquet.`{sf_dir}/nation.parquet` GROUP BY 1",
    ]
    with open_run(spark) as run:
        run.script("afterLoaded", statements)
    return result_rows(run.reports()).select("statement_no", "row")


@query("""
    SELECT 0 AS statement_no, CAST(json_object('r_regionkey', r_regionkey) AS VARCHAR) AS row
    FROM region WHERE r_regionkey < 3
    UNION ALL
    SELECT 1, CAST(json_object('c_custkey', c_custkey, 'c_name', c_name) AS VARCHAR) FROM customer
""")
def script_large_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few rows and a whole table come back in the same form from one script."""
    statements = [
        f"SELECT r_regionkey FROM parquet.`{sf_dir}/region.parquet` WHERE r_regionkey < 3",
        f"SELECT c_custkey, c_name FROM parquet.`{sf_dir}/customer.parquet`",
    ]
    with open_run(spark) as run:
        run.script("afterLoaded", statements)
    return result_rows(run.reports()).select("statement_no", "row")


@query("""
    SELECT 0 AS statement_no, CAST(NULL AS BIGINT) AS update_count
    UNION ALL SELECT 1, count(*) FROM orders
    UNION ALL SELECT 2, count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 3, NULL
""")
def script_update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL writes report their rows, and commands that count none report no number."""
    core = f"{workspace(spark)}.order_keys"
    insert = f"INSERT INTO {core} SELECT o_orderkey FROM parquet.`{sf_dir}/orders.parquet`"
    statements = [
        f"CREATE TABLE {core} (order_key BIGINT) USING parquet",
        insert,
        f"{insert} WHERE o_orderstatus = 'F'",
        f"ALTER TABLE {core} SET TBLPROPERTIES ('loaded' = 'yes')",
    ]
    with open_run(spark) as run:
        run.script("afterLoaded", statements)
    steps = run.reports().select(F.explode("steps").alias("step"))
    sets = steps.select(F.posexplode("step.resultSets").alias("statement_no", "result"))
    return sets.select("statement_no", F.col("result.updateCount").alias("update_count"))


@query("""
    SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS COMMIT_EPOCH,
           count(*) AS loaded
    FROM orders WHERE o_orderpriority < '4' GROUP BY o_orderpriority
""")
def reports_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of the loads before one that fails stay readable."""
    core, path = f"{workspace(spark)}.core", scratch_path(spark, "reports")
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_orderpriority STRING")
    create_core(spark, core, schema)
    orders = table(spark, sf_dir, "orders").select(*schema.fieldNames())

    def read(priority: str) -> DataFrame:
        if priority >= "4":
            raise OSError(f"cannot read {priority}")
        return orders.filter(F.col("o_orderpriority") == priority)

    found = orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()
    units = [Unit(p, 0, lambda s, p=p: read(p)) for (p,) in found]
    with suppress(OSError):
        run_load(spark, units, LoadSpec(target=core), reports_path=path)
    return spark.read.schema(REPORT_SCHEMA).parquet(path).select(
        F.col("attributes.COMMIT_EPOCH").alias("COMMIT_EPOCH"),
        F.col("load.updateCount").alias("loaded"),
    )


@query("""
    SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS COMMIT_EPOCH,
           count(*) AS loaded, 2 AS steps, count(*) AS appended
    FROM orders GROUP BY o_orderpriority
""")
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over five units: staging table, load, append to the core table, report."""
    db = workspace(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "orders")
    orders.withColumn("unit", F.col("o_orderpriority")).write.partitionBy("unit").parquet(path)
    spark.sql(
        f"CREATE TABLE {db}.core (order_key BIGINT, price DECIMAL(12,2), priority STRING) USING parquet"
    )
    staging = f"{db}.stg_%TABLE_ID%_%COMMIT_EPOCH%"
    spec = LoadSpec(
        target=staging,
        fields=orders.columns,
        before_loading=[f"CREATE TABLE {staging} LIKE {db}.core"],
        after_loaded=[append_rows(staging, f"{db}.core"), f"DROP TABLE {staging}"],
    )
    priorities = [r[0] for r in orders.select("o_orderpriority").distinct().collect()]
    units = [
        Unit(p, 0, lambda s, p=p: read_records(s, f"{path}/unit={p}", "parquet", orders.schema))
        for p in sorted(priorities)
    ]
    reports = run_load(spark, units, spec)
    return reports.select(
        F.col("attributes.COMMIT_EPOCH").alias("COMMIT_EPOCH"),
        F.col("load.updateCount").alias("loaded"),
        F.size("steps").alias("steps"),
        F.expr("steps[1].resultSets[0].updateCount").alias("appended"),
    )


def _order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per order, with a clock made from its columns; finished orders skip the first script."""
    clock = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "datediff(o_orderdate, date'1970-01-01') * 86400000L AS start",
        "o_custkey % 50 AS wait",
        "o_orderkey % 100 AS prepare",
        "o_custkey % 70 AS loading",
        "o_orderkey % 30 AS publish",
    )
    step = "named_struct('name', '{}', 'meantime', 0L, 'start', {}, 'stop', {}, 'elapsed', {})"
    before = step.format("beforeLoading", "start + wait", "start + wait + prepare", "prepare")
    after = step.format(
        "afterLoaded",
        "start + wait + prepare + loading",
        "start + wait + prepare + loading + publish",
        "publish",
    )
    reports = clock.selectExpr(
        "start",
        "named_struct('TABLE_ID', '0123abcdef', 'COMMIT_EPOCH', CAST(o_orderkey AS INT)) AS attributes",
        f"CASE WHEN o_orderstatus = 'F' THEN array({after}) ELSE array({before}, {after}) END AS steps",
    )
    return reports.withColumn("steps", with_meantime(F.col("steps"), F.col("start")))


ORDER_STEPS_SQL = """
    WITH clock AS (
        SELECT o_orderkey, o_orderstatus,
               CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000
                   AS first_start,
               o_custkey % 50 AS wait, o_orderkey % 100 AS prepare, o_custkey % 70 AS loading,
               o_orderkey % 30 AS publish
        FROM orders),
    steps AS (
        SELECT o_orderkey, first_start, 0 AS pos, 'beforeLoading' AS name, first_start + wait AS start,
               first_start + wait + prepare AS stop
        FROM clock WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT o_orderkey, first_start, 1, 'afterLoaded', first_start + wait + prepare + loading,
               first_start + wait + prepare + loading + publish
        FROM clock),
    report_steps AS (
        SELECT '0123abcdef' AS TABLE_ID, CAST(o_orderkey AS INTEGER) AS COMMIT_EPOCH,
               CAST(row_number() OVER w - 1 AS INTEGER) AS step_no, name,
               start - coalesce(lag(stop) OVER w, first_start) AS meantime, start, stop,
               stop - start AS elapsed
        FROM steps WINDOW w AS (PARTITION BY o_orderkey ORDER BY pos))
"""


@query(ORDER_STEPS_SQL + "SELECT * FROM report_steps")
def report_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_steps(_order_reports(spark, sf_dir))


@query(ORDER_STEPS_SQL + """
    SELECT name, count(*) AS runs, CAST(sum(elapsed) AS BIGINT) AS elapsed,
           max(elapsed) AS max_elapsed, CAST(sum(meantime) AS BIGINT) AS meantime
    FROM report_steps GROUP BY name
""")
def report_step_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step_summary(_order_reports(spark, sf_dir))


@query(ORDER_STEPS_SQL + """
    SELECT COMMIT_EPOCH, '{"attributes":{"TABLE_ID":"0123abcdef","COMMIT_EPOCH":' || COMMIT_EPOCH ||
           '},"steps":[' || string_agg('{"name":"' || name || '","meantime":' || meantime || '}', ','
           ORDER BY step_no) || ']}' AS report
    FROM report_steps GROUP BY COMMIT_EPOCH
""")
def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as JSON text."""
    reports = _order_reports(spark, sf_dir).selectExpr(
        "attributes",
        "transform(steps, s -> named_struct('name', s.name, 'meantime', s.meantime)) AS steps",
    )
    epoch = F.get_json_object("report", "$.attributes.COMMIT_EPOCH").cast("int")
    return report_json(reports).select(epoch.alias("COMMIT_EPOCH"), "report")


@query("SELECT s_nationkey AS nation_key, count(*) AS suppliers FROM supplier GROUP BY s_nationkey")
def script_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripts share the session of their run: a view made after connecting serves a later script."""
    ctx = RunContext("0123abcdef")
    view = f"CREATE TEMPORARY VIEW v_%TABLE_ID% AS SELECT * FROM parquet.`{sf_dir}/supplier.parquet`"
    core = f"{workspace(spark)}.nation_counts"
    create = f"CREATE TABLE {core}_%COMMIT_EPOCH% USING parquet AS "
    counts = "SELECT s_nationkey AS nation_key, count(*) AS suppliers FROM v_%TABLE_ID% GROUP BY 1"
    with open_run(spark, after_connected=[view], ctx=ctx) as run:
        run_script(run.spark, "afterLoaded", [create + counts], ctx)
    return spark.table(f"{core}_0")


@query("SELECT p_partkey AS part_key, upper(p_brand) AS brand FROM part")
def run_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that binds SQL expressions and attaches the load to its core table."""
    core = f"{workspace(spark)}.part_core"
    part = table(spark, sf_dir, "part")
    create_core(spark, core, T.StructType.fromDDL("part_key BIGINT, brand STRING"))
    spec = LoadSpec(target=core, expressions={"part_key": "p_partkey", "brand": "upper(p_brand)"})
    unit = Unit("part", 0, lambda s: s.read.schema(part.schema).parquet(f"{sf_dir}/part.parquet"))
    run_load(spark, [unit], spec)
    return spark.table(core).select("part_key", "brand")
