from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.sequence import number_rows, running_total
from loadkit.operators.routing import land_routes, route, split_bad, with_control
from loadkit.operators.units import bin_units, load_context, plan_units
from loadkit.plans.run import file_units
from loadkit.session import setting
from loadkit.sources.records import UNIT, UNIT_SIZE


@pytest.mark.parametrize("count", [0, 1, 2, 1000])
def test_running_total(spark, count):
    sizes = [random.Random(7).randrange(100) for _ in range(count)]
    data = [(f"f{i:05}", s) for i, s in enumerate(sizes)]
    random.Random(3).shuffle(data)
    df = spark.createDataFrame(data, "name string, size int").repartition(7)
    got = {r["name"]: r["start"] for r in running_total(df, ["name"], F.col("size"), "start").collect()}
    starts = itertools.accumulate(sizes, initial=0)
    assert got == {f"f{i:05}": s for i, s in zip(range(count), starts, strict=False)}


def test_running_total_uses_many_tasks(spark):
    df = spark.range(100_000).withColumn("v", F.lit(1))
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        total = number_rows(df, ["id"], "n")
        assert total.filter("id <> n").isEmpty()
        assert total.select(F.spark_partition_id()).distinct().count() > 1


def test_bins_hold_whole_units(spark):
    df = spark.createDataFrame([(f"f{i}", 40) for i in range(5)] + [("g", 500), ("h", 1)], "_unit string, _unit_size long")
    got = {r["_unit"]: r["bin"] for r in bin_units(df, 100).collect()}
    assert got == {"f0": 0, "f1": 0, "f2": 0, "f3": 1, "f4": 1, "g": 2, "h": 7}


def test_context_of_many_units(spark, ctx):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "u string, v int")
    rows = load_context(df, ["u"], ctx.next_epoch()).collect()
    assert sorted((r["v"], r["COMMIT_EPOCH"]) for r in rows) == [(1, 3), (2, 2), (3, 3), (4, 1)]


def test_unit_policy_with_a_unit_of_a_third_of_all_rows(spark):
    df = spark.range(3000).selectExpr(
        "id",
        "IF(id % 3 = 0, 'hot', concat('u', id % 10)) AS u",
        "IF(id = 42 OR id = 11, 'bad', NULL) AS _error",
    )
    good, bad = split_bad(df, "unit", unit=["u"])
    assert {r["u"] for r in bad.select("u").distinct().collect()} == {"hot", "u1"}
    assert good.count() + bad.count() == 3000
    assert good.filter("_error IS NOT NULL OR u IN ('hot', 'u1')").isEmpty()


def test_unit_policy_without_a_unit_name(spark):
    df = spark.createDataFrame([(1, None, "bad"), (2, None, None), (3, "a", None)], "i int, _unit string, _error string")
    good, bad = split_bad(df)
    assert [r["i"] for r in good.collect()] == [3]
    assert sorted(r["i"] for r in bad.collect()) == [1, 2]


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="unknown"):
        split_bad(spark.range(1).withColumn("_error", F.lit(None)), "other")


ROUTES = [(1, "a"), (2, "b"), (3, ""), (4, None), (5, "c"), (6, "x=1/y")]


@pytest.mark.parametrize("gather", [False, True])
def test_routes(spark, gather):
    df = spark.createDataFrame(ROUTES, "i int, r string")
    control = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("", "t2"), ("x=1/y", "t3")], "r string, target string")
    got = {t: sorted(r["i"] for r in rows.collect()) for t, rows in route(df, control, "r", gather).items()}
    assert got == {"t1": [1, 2], "t2": [3], "t3": [6], None: [4, 5]}


def test_routes_open_their_own_folder_only(spark):
    df = spark.createDataFrame(ROUTES, "i int, r string")
    control = spark.createDataFrame([("a", "t1")], "r string, target string")
    plan = route(df, control, "r")["t1"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_route#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert land_routes(df, "r").read(spark).count() == len(ROUTES)


def test_a_route_cannot_have_two_targets(spark):
    df = spark.createDataFrame(ROUTES, "i int, r string")
    control = spark.createDataFrame([("a", "t1"), ("a", "t2")], "r string, target string")
    with pytest.raises(ValueError, match="2 times"):
        route(df, control, "r")


def test_settings_per_row(spark):
    df = spark.createDataFrame(ROUTES, "i int, r string")
    control = spark.createDataFrame([("a", "INSERT a")], T.StructType.fromDDL("r string, statement string"))
    rows = {r["i"]: r["statement"] for r in with_control(df, control, "r").collect()}
    assert rows[1] == "INSERT a" and rows[5] is None and len(rows) == 6


def test_many_tiny_files_make_one_unit(spark):
    listing = spark.range(20_000).selectExpr(f"concat('f', lpad(id, 6, '0')) AS {UNIT}", f"1L AS {UNIT_SIZE}")
    planned = plan_units(listing, target_bytes=1 << 30)
    (unit,) = file_units(planned, lambda s, paths: paths)
    assert unit.size == 20_000 and len(unit.read(spark)) == 20_000
