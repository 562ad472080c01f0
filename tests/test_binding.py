from __future__ import annotations

import json
import logging

import pytest
from pyspark.sql import types as T

from loadkit.functions.casts import UnsupportedBinding
from loadkit.operators.binding import ArityError, bind, bind_by_name, bind_expr, strict
from loadkit.operators.loading import load_batch
from loadkit.sources.records import SchemaMissing

DDL = T.StructType.fromDDL


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(1, "b", 2.5, "e")], "a int, b string, c double, extra string")


@pytest.fixture(scope="module")
def target():
    return DDL("x double, y int, z string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_by_position(spark, records):
    assert rows(bind(records, ["c", "a", "b"], DDL("x double, y int, z string"))) == [(2.5, 1, "b")]


def test_reordered_and_reused(spark, records):
    bound = bind(records, ["a", "a", "a"], DDL("x double, y int, z string"))
    assert rows(bound) == [(1.0, 1, "1")]
    assert bound.columns == ["x", "y", "z"]


def test_unbound_fields_are_not_read(spark, records, path):
    where = path("records")
    records.write.parquet(where)
    stored = spark.read.schema(records.schema).parquet(where)
    bound = bind(stored, ["a"], DDL("y int"), errors=True)
    plan = bound._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:int>" in plan


@pytest.mark.parametrize("fields", [["a"], ["a", "b", "c", "extra"]])
def test_arity(records, target, fields):
    with pytest.raises(ArityError):
        bind(records, fields, DDL("x double, y int, z string"))


@pytest.mark.parametrize(("policy", "expected"), [("null", None), ("default", "d")])
def test_absent_field(spark, records, db, caplog, policy, expected):
    spark.sql(f"CREATE TABLE {db}.t (y INT, w STRING DEFAULT 'd') USING parquet")
    with caplog.at_level(logging.WARNING):
        bound = bind(records, ["a", "missing"], spark.table(f"{db}.t").schema, on_absent=policy)
    assert "missing" in caplog.text
    load_batch(bound, f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == [(1, expected)]


def test_absent_field_can_be_an_error(records):
    with pytest.raises(SchemaMissing, match="missing"):
        bind(records, ["missing"], DDL("y int"), on_absent="error")


def test_missing_columns_of_a_frame_take_the_default(spark, db):
    spark.sql(f"CREATE TABLE {db}.t (y INT, w STRING DEFAULT 'd') USING parquet")
    result = load_batch(spark.range(3).selectExpr("CAST(id AS INT) AS y"), f"{db}.t")
    assert result.rows == 3
    assert {r["w"] for r in spark.table(f"{db}.t").collect()} == {"d"}


def test_unsupported_type_is_named(spark):
    df = spark.createDataFrame([([1.0],)], "v array<float>")
    with pytest.raises(UnsupportedBinding, match="'v'.*array<float>"):
        bind(df, ["v"], DDL("x string"))


def test_by_name(records):
    assert rows(bind_by_name(records, DDL("c string, a bigint"))) == [("2.5", 1)]


def test_expressions(spark, records, db):
    spark.sql(f"CREATE TABLE {db}.t (x INT, z STRING, w STRING DEFAULT 'd') USING parquet")
    schema = spark.table(f"{db}.t").schema
    bound = bind_expr(records, {"x": "a + 1", "z": "upper(b)"}, schema)
    assert rows(bound) == [(2, "B", "d")]
    with pytest.raises(SchemaMissing):
        bind_expr(records, {"nope": "a"}, schema)


def test_expression_errors_are_kept(records):
    bound = bind_expr(records, {"x": "b"}, DDL("x int"), errors=True)
    assert [r[:2] for r in rows(bound)] == [(None, "x")]
    assert [json.loads(r[2]) for r in rows(bound)] == [{"b": "b"}]


def test_errors_name_every_bad_field(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "y"), (None, "3")], "a string, b string")
    bound = bind(df, ["a", "b", "a"], DDL("a int, b int, c bigint"), errors=True)
    assert rows(bound) == [
        (1, 2, 1, None, None),
        (None, None, None, "a,b,a", '{"a":"x","b":"y"}'),
        (None, 3, None, None, None),
    ]


def test_strict_fails_on_the_first_bad_row(spark, db):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    spark.sql(f"CREATE TABLE {db}.t (a INT) USING parquet")
    bound = strict(bind(df, ["a"], DDL("a int"), errors=True))
    with pytest.raises(Exception, match="cannot load record"):
        load_batch(bound, f"{db}.t")
    assert spark.table(f"{db}.t").isEmpty()
    good = strict(bind(df.filter("a = '1'"), ["a"], DDL("a int"), errors=True))
    assert load_batch(good, f"{db}.t").rows == 1


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([("1", "2")], "`a.b` string, `c d` string")
    bound = bind(df, ["a.b", "c d"], DDL("x int, y int"), errors=True)
    assert rows(bound)[0][:3] == (1, 2, None)
