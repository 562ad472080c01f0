from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loadkit.context import (
    RunContext,
    TableIdInUse,
    assert_unused,
    fill_placeholders,
    new_context,
    with_context,
)
from loadkit.operators.loading import STAGING_NAME, create_staging
from loadkit.session import scratch_dir


def test_ids():
    ids = {new_context().table_id for _ in range(100)}
    assert len(ids) == 100
    assert all(re.fullmatch("[0-9a-z]{10}", i) for i in ids)
    assert len(new_context(4).table_id) == 4


def test_epochs_and_placeholders(ctx):
    text = "a_%TABLE_ID%_%COMMIT_EPOCH% b_%TABLE_ID% %table_id%"
    assert ctx.evaluate(text) == "a_0123abcdef_0 b_0123abcdef %table_id%"
    assert ctx.next_epoch().evaluate("%COMMIT_EPOCH%") == "1"
    assert ctx.evaluate(None) is None
    assert ctx.commit_epoch == 0


def test_placeholders_in_a_column(spark):
    df = spark.createDataFrame([("t_%TABLE_ID%_%COMMIT_EPOCH%", 3), (None, 4)], "t string, e int")
    filled = df.select(fill_placeholders(F.col("t"), F.lit("abc"), F.col("e")))
    assert [r[0] for r in filled.collect()] == ["t_abc_3", None]


def test_context_columns(spark, ctx):
    row = with_context(spark.range(1), ctx.next_epoch()).first()
    assert (row["TABLE_ID"], row["COMMIT_EPOCH"]) == ("0123abcdef", 1)


def test_an_id_cannot_be_used_twice(spark, db, ctx):
    spark.sql(f"CREATE TABLE {db}.core (a INT) USING parquet")
    create_staging(spark, f"{db}.core", f"{db}.{STAGING_NAME}", ctx)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_staging(spark, f"{db}.core", f"{db}.{STAGING_NAME}", ctx)
    with_context(spark.range(1), ctx).write.saveAsTable(f"{db}.ledger")
    with pytest.raises(TableIdInUse):
        assert_unused(spark, f"{db}.ledger", ctx)
    assert_unused(spark, f"{db}.ledger", RunContext("other"))


def test_scratch_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark) == (named.rstrip("/") if named else spark.sparkContext.getCheckpointDir())
