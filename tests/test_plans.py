"""Plans that must hold at any size: what is read, what is shuffled, and how hot keys are split."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from loadkit.checks import loads, table
from loadkit.context import RunContext
from loadkit.operators.binding import bind
from loadkit.operators.elt import latest_per_key, load_rows, merge_rows, rollup
from loadkit.operators.loading import create_core, load_staged
from loadkit.operators.routing import split_bad
from loadkit.operators.units import load_context, unit_counts
from loadkit.session import materialise
from tests.oracle import TABLES

SF_DIR = f"{TABLES}/sf0.001"


def plan(df, run=False):
    execution = df._jdf.queryExecution()
    if run:
        df._jdf.collectToPython()
    return execution.executedPlan().toString()


def formatted(df):
    """The plan with full schemas and filters."""
    with redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_a_load_neither_shuffles_nor_reads_other_columns(spark):
    records = table(spark, SF_DIR, "lineitem")
    shown = formatted(bind(records, loads.LINEITEM_FIELDS, loads.LINEITEM_TARGET, errors=True))
    assert "Exchange" not in shown
    assert "Python" not in shown
    read = shown.split("ReadSchema: struct<")[1].split(">")[0]
    assert [f.split(":")[0] for f in read.split(",")] == [
        c for c in records.columns if c in loads.LINEITEM_FIELDS
    ]
    assert "Project [codegen id : 1]" in shown


def test_a_filter_on_a_bound_column_reaches_the_scan(spark):
    records = table(spark, SF_DIR, "lineitem")
    bound = bind(records, loads.LINEITEM_FIELDS, loads.LINEITEM_TARGET)
    assert "EqualTo(l_returnflag,R)" in formatted(bound.filter("return_flag = 'R'"))


def test_loaded_rows_are_found_by_partition(spark, db, ctx):
    core = f"{db}.core"
    create_core(spark, core, loads.LINEITEM_TARGET)
    records = table(spark, SF_DIR, "lineitem")
    load_staged(bind(records, loads.LINEITEM_FIELDS, loads.LINEITEM_TARGET), core, ctx)
    shown = formatted(spark.table(core).filter(load_rows(ctx)))
    filters = shown.split("PartitionFilters: [")[1].split("]")[0]
    assert "TABLE_ID" in filters and "COMMIT_EPOCH" in filters


@pytest.mark.parametrize(
    "aggregate",
    [
        lambda e: latest_per_key(e, ["user_id"], ["ts", "event_id"]),
        lambda e: unit_counts(e, ["event_type"]),
        lambda e: rollup(e, "ts", "1 hour", ["event_type"], {"n": F.count(F.lit(1))}),
    ],
)
def test_aggregates_combine_before_the_shuffle(spark, aggregate):
    shown = plan(aggregate(table(spark, SF_DIR, "events")))
    assert shown.count("hashpartitioning") == 1
    assert "partial_" in shown.split("hashpartitioning")[1]


SMALL = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
}


@pytest.fixture
def hot(spark):
    """A third of all rows in one unit, in a session in which that counts as large."""
    session = spark.newSession()
    for key, value in SMALL.items():
        session.conf.set(key, value)
    rows = session.range(0, 400_000, 1, 8).selectExpr(
        "id",
        "sha1(CAST(id AS STRING)) AS text",
        "IF(id % 3 = 0, 'hot', concat('u', id % 1000)) AS u",
        "IF(id % 5000 = 1, 'bad', NULL) AS _error",
    )
    return materialise(rows)


@pytest.mark.parametrize(
    "join",
    [
        lambda df: split_bad(df, "unit", unit=["u"])[0],
        lambda df: load_context(df, ["u"], RunContext("0123abcdef")),
        lambda df: merge_rows(df, df.filter("u = 'u1'").limit(10), ["u"]),
    ],
)
def test_joins_split_a_hot_unit(hot, join):
    assert "SortMergeJoin(skew=true)" in plan(join(hot), run=True)


def test_sides_of_a_known_small_size_are_broadcast(spark):
    rows = materialise(spark.range(1000).selectExpr("id", "id % 7 AS u", "IF(id = 3, 'bad', NULL) AS _error"))
    shown = plan(split_bad(rows, "unit", unit=["u"])[0])
    assert "BroadcastHashJoin" in shown and "hashpartitioning" not in shown
