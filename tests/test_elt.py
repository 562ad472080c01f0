from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import TableIdInUse, with_context
from loadkit.operators import elt
from loadkit.operators.elt import (
    MergeResult,
    drop_staging,
    latest_per_key,
    loaded_rows,
    publish_append,
    publish_merge,
    purge,
    rollup,
)
from loadkit.operators.loading import STAGING_NAME, create_core, create_staging, load_batch, load_many

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k int, v int, p string"


def table(spark, name, rows, partition=None, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=repr)


# Latest -------------------------------------------------------------------------------------------


def test_latest_with_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "q"), (None, 2, "n")],
        "k string, o int, v string",
    )
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["o"]).collect()), key=repr)
    assert got == sorted([("a", 1, "y"), ("b", None, "q"), (None, 2, "n")], key=repr)


def test_latest_sends_one_row_per_key_and_task(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("CAST(id % 3 = 0 AS INT) AS k", "id AS o")
    plan = latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text("ab", max_size=2)), min_size=1))
def test_latest_is_the_maximum(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    want = {}
    for k, o, v in data:
        want[k] = max(want.get(k, (o, v)), (o, v))
    assert {r["k"]: (r["o"], r["v"]) for r in latest_per_key(df, ["k"], ["o"]).collect()} == want


# Merge --------------------------------------------------------------------------------------------


def test_merge_replaces_and_adds(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a"), (2, 2, "a"), (None, 3, "a")])
    staged = spark.createDataFrame([(2, 9, "b"), (4, 4, "b"), (None, 8, "b"), (None, 8, "b")], SCHEMA)
    staged.write.saveAsTable(f"{db}.stg")
    result = publish_merge(spark, f"{db}.core", f"{db}.stg", ["k"], ["v"])
    assert result == MergeResult(updated=1, inserted=3)
    assert rows(spark, f"{db}.core") == sorted(
        [(1, 1, "a"), (2, 9, "b"), (4, 4, "b"), (None, 3, "a"), (None, 8, "b"), (None, 8, "b")], key=repr
    )


def test_readers_keep_the_old_rows_until_the_swap(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a")])
    before = spark.table(f"{db}.core").inputFiles()
    change = spark.createDataFrame([(1, 2, "a")], SCHEMA)
    publish_merge(spark, f"{db}.core", change, ["k"], keep_old=True)
    assert spark.read.parquet(*before).collect()[0]["v"] == 1
    load_batch(spark.createDataFrame([(7, 7, "c")], SCHEMA), f"{db}.core")
    publish_merge(spark, f"{db}.core", spark.createDataFrame([(7, 8, "c")], SCHEMA), ["k"])
    assert rows(spark, f"{db}.core") == [(1, 2, "a"), (7, 8, "c")]


def test_a_failing_merge_changes_nothing(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a")])
    broken = spark.range(3).selectExpr(
        "CAST(id AS INT) AS k", "CAST(raise_error('no') AS INT) AS v", "'b' AS p"
    )
    with pytest.raises(Exception, match="no"):
        publish_merge(spark, f"{db}.core", broken, ["k"])
    assert rows(spark, f"{db}.core") == [(1, 1, "a")]


def test_partitions_that_are_not_touched_keep_their_files(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "p")
    files = {f for f in spark.table(f"{db}.core").inputFiles() if "p=a" not in f}
    staged = spark.createDataFrame([(1, 9, "a"), (4, 4, "d")], SCHEMA)
    assert publish_merge(spark, f"{db}.core", staged, ["p", "k"]) == MergeResult(1, 1)
    assert files <= set(spark.table(f"{db}.core").inputFiles())
    assert rows(spark, f"{db}.core") == [(1, 9, "a"), (2, 2, "b"), (3, 3, "c"), (4, 4, "d")]


def test_rows_move_between_partitions(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a"), (2, 2, "it's"), (3, 3, None)], "p")
    staged = spark.createDataFrame([(2, 9, "a"), (3, 9, "z")], SCHEMA)
    assert publish_merge(spark, f"{db}.core", staged, ["k"]) == MergeResult(2, 0)
    assert rows(spark, f"{db}.core") == [(1, 1, "a"), (2, 9, "a"), (3, 9, "z")]
    assert len(spark.sql(f"SHOW PARTITIONS {db}.core").collect()) == 2


def test_many_touched_partitions_are_pruned(spark, db):
    core = f"{db}.core"
    spark.range(1100).selectExpr("id AS k", "id AS v", "concat('p', id) AS p").repartition("p").write.partitionBy(
        "p"
    ).saveAsTable(core)
    touched = spark.range(1050).selectExpr("concat('p', id) AS p")
    found = elt.in_partitions(spark.table(core), touched, ["p"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p" in plan and "Join" not in plan
    assert found.count() == 1050


def test_twice_staged_keys_are_refused(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a")])
    staged = spark.createDataFrame([(2, 1, "a"), (2, 2, "a")], SCHEMA)
    with pytest.raises(elt.DuplicateKeys):
        publish_merge(spark, f"{db}.core", staged, ["k"])
    assert rows(spark, f"{db}.core") == [(1, 1, "a")]


def test_a_failed_rewrite_leaves_the_table(spark, db):
    table(spark, f"{db}.core", [(1, 1, "a")])
    fails = spark.table(f"{db}.core").withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        elt.replace_rows(spark, f"{db}.core", fails)
    assert rows(spark, f"{db}.core") == [(1, 1, "a")]


def test_merge_into_two_partition_columns(spark, db):
    schema = "k int, v int, p string, q int"
    df = spark.createDataFrame([(1, 1, "a", 1), (2, 2, "a", 2), (3, 3, "b", 1)], schema)
    df.write.partitionBy("p", "q").saveAsTable(f"{db}.core")
    staged = spark.createDataFrame([(2, 9, "b", 1), (3, 8, "b", 1)], schema)
    publish_merge(spark, f"{db}.core", staged, ["k"])
    assert rows(spark, f"{db}.core") == [(1, 1, "a", 1), (2, 9, "b", 1), (3, 8, "b", 1)]


keyed = st.lists(st.tuples(st.integers(0, 8) | st.none(), st.integers(0, 9), st.sampled_from(["a", "b", None])), max_size=12)


@pytest.mark.parametrize("partition", [None, "p"])
@few
@given(core=keyed, staged=keyed)
def test_merge_agrees_with_a_dictionary(spark, db, partition, core, staged):
    unique = list({k if k is not None else (i,): (k, v, p) for i, (k, v, p) in enumerate(core)}.values())
    name = f"{db}.m"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    table(spark, name, unique, partition)
    publish_merge(spark, name, spark.createDataFrame(staged, SCHEMA), ["k"], ["v"])
    want = {k: (k, v, p) for k, v, p in unique if k is not None}
    latest = {}
    for k, v, p in staged:
        if k is not None:
            latest[k] = max(latest.get(k, (k, v, p)), (k, v, p), key=lambda r: (r[1], r[2] or ""))
    want.update(latest)
    nulls = [r for r in unique + staged if r[0] is None]
    assert rows(spark, name) == sorted([*want.values(), *nulls], key=repr)


# Staging, purge, roll-up --------------------------------------------------------------------------


def test_staging_life(spark, db, ctx):
    spark.sql(f"CREATE TABLE {db}.core (k INT, v INT DEFAULT 7) USING parquet")
    name = create_staging(spark, f"{db}.core", f"{db}.{STAGING_NAME}", ctx)
    assert name == f"{db}.stg_0123abcdef_0"
    load_batch(spark.createDataFrame([(1,)], "k int"), name)
    assert publish_append(spark, name, f"{db}.core").rows == 1
    assert [tuple(r) for r in spark.table(f"{db}.core").collect()] == [(1, 7)]
    drop_staging(spark, f"{db}.{STAGING_NAME}", ctx)
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("layout", ["load", "plain", "other"])
def test_purge_deletes_one_load(spark, db, ctx, layout):
    name = f"{db}.core"
    data = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], SCHEMA)
    if layout == "load":
        create_core(spark, name, data.schema)
    else:
        part = "PARTITIONED BY (p)" if layout == "other" else ""
        columns = "k INT, v INT, TABLE_ID STRING, COMMIT_EPOCH INT, p STRING"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {part}")
        load_batch(spark.createDataFrame([(9, 9, None, None, "a")], columns), name)
    second = data.withColumn("k", F.col("k") + 10).filter("p = 'b'")
    for c, df in ((ctx, data), (ctx.next_epoch(), second)):
        stamped = with_context(df, c)
        stamped.select(*spark.table(name).columns).write.insertInto(name)
    assert loaded_rows(spark.table(name), ctx.next_epoch()).count() == 1
    assert purge(spark, name, ctx) == 2
    left = [] if layout == "load" else [9]
    assert sorted(r["k"] for r in spark.table(name).collect()) == [*left, 12]
    assert purge(spark, name, ctx) == 0
    assert spark.table(name).count() == len(left) + 1


def test_rollup(spark):
    data = [(dt.datetime(2024, 1, 1, h, m), "k", float(m)) for h in (0, 1) for m in (0, 59)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v double")
    got = rollup(df, "ts", "1 hour", ["k"], {"n": F.count(F.lit(1)), "top": F.max("v")})
    assert sorted(tuple(r) for r in got.collect()) == [
        (dt.datetime(2024, 1, 1, 0), "k", 2, 59.0),
        (dt.datetime(2024, 1, 1, 1), "k", 2, 59.0),
    ]


# Many units in one load ---------------------------------------------------------------------------


@pytest.mark.parametrize("gather", [False, True])
def test_many_units_with_one_that_holds_most_rows(spark, db, ctx, gather):
    df = spark.range(3000).selectExpr("CAST(id AS INT) AS v", "IF(id % 3 = 0, 'hot', concat('u', id % 7)) AS u")
    create_core(spark, f"{db}.core", T.StructType.fromDDL("v int, u string"))
    counts = load_many(df, ["u"], f"{db}.core", ctx, gather)
    with pytest.raises(TableIdInUse):
        load_many(df, ["u"], f"{db}.core", ctx)
    got = {r["COMMIT_EPOCH"]: r["update_count"] for r in counts.collect()}
    want = {r["u"]: r["count"] for r in df.groupBy("u").count().collect()}
    assert got == {i: want[u] for i, u in enumerate(sorted(want))}
    assert spark.table(f"{db}.core").count() == 3000
