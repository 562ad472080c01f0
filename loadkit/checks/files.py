"""Files of a load: settings of their own, outcomes, headers, and the state that runs leave."""

from __future__ import annotations

import re
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.context import RunContext, TableIdInUse, new_context
from loadkit.operators.elt import publish_merge, purge
from loadkit.operators.loading import LOAD_COLUMNS, create_core, load_delimited, load_many
from loadkit.operators.rollups import RollupSpec, add_load, create_rollup, rolled_up, take_out
from loadkit.operators.units import bin_minimum, plan_units
from loadkit.plans.outcomes import read_outcomes
from loadkit.plans.run import LoadSpec, Unit, file_units, run_files, run_load
from loadkit.session import exists, scratch_path
from loadkit.sources.delimited import write_delimited
from loadkit.sources.records import UNIT, UNIT_SIZE, list_units, read_records, read_unit_stream
from loadkit.streaming.drain import BATCH, landed_files, run_stream

PARTS = 6


def _part_of(unit: str = UNIT):
    return F.regexp_extract(unit, "part=([^/]*)", 1)


def _lines(rows: DataFrame, part: str, path: str) -> None:
    """Write rows as JSON lines, a file per part."""
    told = rows.select(F.to_json(F.struct(*[c for c in rows.columns if c != part])).alias("value"), part)
    told.repartition(PARTS, part).write.partitionBy(part).text(path)


class Refused(Exception):
    """Ends a load before it is published."""


def _refuse(spark: SparkSession, ctx: RunContext) -> None:
    raise Refused


@query("""
    SELECT event_id % 6 AS part, CASE WHEN event_id % 6 IN (0, 1) THEN 'failed' ELSE 'loaded' END AS status,
        count(*) AS records, count(*) FILTER (event_id % 6 = 1 AND value > 50) AS bad
    FROM events GROUP BY event_id % 6
""")
def outcomes_after_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three loads the first is refused, the second holds a file with bad records. The refused one is
    tried again for one of its two files."""
    db, out = workspace(spark), scratch_path(spark, "outcomes")
    create_core(spark, f"{db}.core", T.StructType.fromDDL("event_id BIGINT, value DOUBLE"))
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 6 = 1 AND value > 50 THEN 'much' ELSE CAST(value AS STRING) END AS value",
        f"CAST(event_id % 6 AS STRING) AS {UNIT}",
    )
    spec = LoadSpec(f"{db}.core", fields=["event_id", "value"], outcomes=out)

    def unit(*parts: str, how: LoadSpec = spec) -> Unit:
        return Unit("-".join(parts), 0, lambda s: events.filter(F.col(UNIT).isin(*parts)), how)

    refused = LoadSpec(**{**spec.__dict__, "before_publish": [_refuse]})
    with suppress(Refused):
        run_load(spark, [unit("0", "2", how=refused)])
    run_load(spark, [unit("1", "3"), unit("4", "5"), unit("2")])
    found = read_outcomes(spark, out, f"{db}.core")
    return found.select(
        F.col(UNIT).cast("bigint").alias("part"), "status", F.col("rows").alias("records"), "bad"
    )


@query("""
    SELECT 'core_' || event_type AS target, event_id, CASE WHEN event_type < 'm' THEN value END AS value,
        true AS sizes_agree FROM events WHERE event_type <> 'view'
    UNION ALL SELECT 'left over', NULL, NULL, true
""")
def file_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one listing go to the targets that a control table names by their paths, with bindings
    and scripts of their own; files without a row are left over."""
    db, path = workspace(spark), scratch_path(spark, "queue")
    events = table(spark, sf_dir, "events").select("event_id", "value", F.col("event_type").alias("part"))
    _lines(events, "part", path)
    kinds = [row["part"] for row in events.select("part").distinct().collect()]
    target = T.StructType.fromDDL("event_id BIGINT, value DOUBLE")
    for kind in kinds:
        create_core(spark, f"{db}.core_{kind}", target)
    control = spark.createDataFrame(
        [
            (r".*/part=([a-l]\w*)/[^/]*", 1, f"{db}.core_$1", ["event_id", "value"], "value DOUBLE"),
            (r".*/part=(?!view)(\w+)/[^/]*", 2, f"{db}.core_$1", ["event_id", "nothing"], "ignored STRING"),
        ],
        "files string, priority int, target string, fields array<string>, more string",
    )
    listing = list_units(spark, f"{path}/*", "*.txt")

    def read(session: SparkSession, paths: list[str], settings: dict) -> DataFrame:
        schema = T.StructType.fromDDL(f"event_id BIGINT, {settings['more']}")
        return read_records(session, paths, "json", schema)

    reports, left = run_files(spark, listing, control, read, target_bytes=1 << 30)
    routed = listing.filter(_part_of() != "view").agg(F.sum(UNIT_SIZE)).first()[0]
    sizes = reports.agg(F.sum("size")).first()[0] == routed
    found = [
        spark.table(f"{db}.core_{kind}").select(F.lit(f"core_{kind}").alias("target"), "event_id", "value")
        for kind in kinds
    ]
    nothing = left.limit(1).selectExpr("'left over' AS target", "CAST(NULL AS BIGINT) AS event_id", "CAST(NULL AS DOUBLE) AS value")
    for rows in found[1:] + [nothing]:
        found[0] = found[0].unionByName(rows)
    return found[0].withColumn("sizes_agree", F.lit(sizes))


@query("""
    SELECT event_id % 6 AS part, CASE WHEN event_id % 6 = 2 THEN 'failed' ELSE 'loaded' END AS status,
        count(*) AS records, count(*) FILTER (event_id % 6 = 2 AND value > 50) AS bad, 0 AS landed
    FROM events GROUP BY event_id % 6
""")
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a stream, by what became of them; a second call finds nothing, and published batches
    leave no landed file."""
    db, path, out = workspace(spark), scratch_path(spark, "queue"), scratch_path(spark, "outcomes")
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 6 = 2 AND value > 50 THEN 'much' ELSE CAST(value AS STRING) END AS value",
        "event_id % 6 AS part",
    )
    _lines(events, "part", path)
    create_core(spark, f"{db}.core", T.StructType.fromDDL("event_id BIGINT, value DOUBLE"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    schema = T.StructType.fromDDL("event_id BIGINT, value STRING")
    spec = LoadSpec(f"{db}.core", fields=["event_id", "value"], outcomes=out)
    for _ in range(2):
        stream = read_unit_stream(spark, f"{path}/*", "json", schema, max_files=2)
        run_stream(spark, stream, spec, "events", landing, checkpoint, f"{db}.ledger")
    left = sum(exists(spark, f"{landing}/{BATCH}={row[BATCH]}") for row in landed_files(spark, landing).collect())
    return read_outcomes(spark, out).select(
        _part_of().cast("bigint").alias("part"), "status", F.col("rows").alias("records"), "bad",
        F.lit(left).cast("int").alias("landed"),
    )


@query("""
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 1 THEN c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 3 = 2 THEN c_nationkey END AS c_nationkey FROM customer
""")
def delimited_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files with three different headers are loaded in one read."""
    core, path = f"{workspace(spark)}.customer_core", scratch_path(spark, "mixed")
    customers = table(spark, sf_dir, "customer")
    kinds = [
        ["c_custkey", "c_name", "c_acctbal"], ["c_name", "c_custkey"],
        ["c_nationkey", "c_acctbal", "c_custkey", "c_name"],
    ]
    for i, columns in enumerate(kinds):
        part = customers.filter(f"c_custkey % 3 = {i}").select(*columns)
        write_delimited(part.repartition(2), f"{path}/{i}")
    target = customers.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    target.limit(0).write.saveAsTable(core)
    load_delimited(spark, [f"{path}/{i}" for i in range(3)], core, mixed=True)
    return spark.table(core)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL
    SELECT c_custkey, c_name, (c_nationkey + 1) % 25, c_acctbal + 1 FROM customer WHERE c_custkey % 4 = 0
    UNION ALL
    SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 8 = 0
""")
def merge_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys move between partitions; the scan for them is filtered by the keys that are staged."""
    core = f"{workspace(spark)}.customer_core"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    customers.write.partitionBy("c_nationkey").saveAsTable(core)
    moved = customers.filter("c_custkey % 4 = 0").selectExpr(
        "c_custkey", "c_name", "(c_nationkey + 1) % 25 AS c_nationkey", "c_acctbal + 1 AS c_acctbal"
    )
    new = customers.filter("c_custkey % 8 = 0").withColumn("c_custkey", F.expr("c_custkey + 10000000"))
    publish_merge(spark, core, moved.unionByName(new), ["c_custkey"], filter_from=1)
    return spark.table(core)


@query("SELECT s_suppkey, 1 AS loads, 'claimed' AS second FROM supplier")
def reused_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run under one table id stops before its first script; what the first loaded stays."""
    db, ctx = workspace(spark), new_context()
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    create_core(spark, f"{db}.core", suppliers.schema)
    spec, second = LoadSpec(f"{db}.core", fields=["s_suppkey"]), "none"
    unit = Unit("suppliers", 0, lambda s: suppliers)
    run_load(spark, [unit], spec, ctx=ctx, claims=f"{db}.claims")
    try:
        run_load(spark, [unit], spec, [f"DROP TABLE {db}.core"], ctx=ctx, claims=f"{db}.claims")
    except TableIdInUse as error:
        second = re.search("claimed", str(error))[0]
    rows = spark.table(f"{db}.core")
    loads = rows.select(*LOAD_COLUMNS).distinct().count()
    return rows.select("s_suppkey", F.lit(loads).alias("loads"), F.lit(second).alias("second"))


@query("""
    WITH RECURSIVE p AS (
        SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS i,
            sum(n_chars) OVER (ORDER BY doc_id) AS upto FROM documents
    ), cuts AS (
        SELECT 0::BIGINT AS bin, 0::BIGINT AS after, 0::HUGEINT AS upto
        UNION ALL
        SELECT bin + 1, (SELECT min(i) FROM p WHERE p.upto >= cuts.upto + 30000)::BIGINT,
            (SELECT min(p.upto) FROM p WHERE p.upto >= cuts.upto + 30000)::HUGEINT
        FROM cuts WHERE cuts.upto + 30000 <= (SELECT max(p.upto) FROM p)
    )
    SELECT doc_id, (SELECT max(bin) FROM cuts WHERE after < i) AS bin FROM p
""")
def bin_minimum_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive documents in units of at least 30,000 characters, cut as early as that allows."""
    listing = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return bin_minimum(listing, 30_000, ["doc_id"], "n_chars").select("doc_id", "bin")


@query("""
    SELECT date_trunc('hour', ts) AS bucket, count(*) AS n, min(value) AS low, max(value) AS high,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
    FROM events WHERE event_type <> (SELECT event_type FROM events GROUP BY 1 ORDER BY 1 LIMIT 1 OFFSET 2)
    GROUP BY 1
""")
def rollup_after_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads are rolled up one by one, one of them twice, and one is taken out again."""
    db, ctx = workspace(spark), new_context()
    events = table(spark, sf_dir, "events").select("ts", "value", "event_type")
    create_core(spark, f"{db}.core", events.schema)
    loads = load_many(events, ["event_type"], f"{db}.core", ctx).count()
    values = {
        "n": ("count", "1"), "low": ("min", "value"), "high": ("max", "value"),
        "total": ("sum", "CAST(value AS DECIMAL(18,2))"),
    }
    create_rollup(spark, f"{db}.hourly", f"{db}.core", RollupSpec("ts", "1 hour", [], values))
    contexts = [RunContext(ctx.table_id, epoch) for epoch in range(loads)]
    for load in [*contexts, contexts[1]]:
        add_load(spark, f"{db}.hourly", f"{db}.core", load)
    purge(spark, f"{db}.core", contexts[2])
    take_out(spark, f"{db}.hourly", contexts[2])
    return rolled_up(spark, f"{db}.hourly")


@query("SELECT event_id, value, 1 AS copies, 3 AS runs FROM events")
def parallel_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of different sizes are loaded by three runs side by side, the largest first, under a bound."""
    db, path = workspace(spark), scratch_path(spark, "queue")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    parted = events.withColumn("part", F.floor(F.log2(F.col("event_id") % 64 + 1)).cast("string"))
    parted.repartition(8, "part").write.partitionBy("part").parquet(path)
    listing = list_units(spark, f"{path}/*", "*.parquet")

    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return read_records(session, paths, "parquet", events.schema)

    create_core(spark, f"{db}.core", events.schema)
    units = file_units(plan_units(listing), read, largest_first=True)
    most = listing.agg(F.max(UNIT_SIZE)).first()[0] + 1
    spec = LoadSpec(f"{db}.core", fields=["event_id", "value"])
    reports = run_load(spark, units, spec, parallel=3, bytes_in_flight=most, after_connected=["SELECT 1"])
    runs = reports.select("attributes.TABLE_ID").distinct().count()
    rows = spark.table(f"{db}.core").groupBy("event_id").agg(F.max("value").alias("value"), F.count("*").cast("int").alias("copies"))
    return rows.withColumn("runs", F.lit(runs).cast("int"))
