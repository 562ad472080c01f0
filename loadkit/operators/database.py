"""Loading units into a database: the loading channel of a run."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from loadkit.context import RunContext
from loadkit.operators.binding import bind, bind_by_name, bind_expr, strict
from loadkit.operators.loading import LoadResult, now_millis
from loadkit.sources.jdbc import load_staged_jdbc, read_jdbc, read_options


def jdbc_loader(
    url: str, staging: str, publish: list[str], connect: Callable, **load_options: Any
) -> Callable:
    """A loader that sends units to a database by way of a staging table and publishes them.

    Names and statements may hold placeholders. The staging table must exist, for instance by a
    statement of the before-loading script; its columns give the types to cast to. A bad record
    fails the load before anything is published.
    """

    def load(df: DataFrame, spec, ctx: RunContext, before_publish: Callable) -> LoadResult:
        start, name = now_millis(), ctx.evaluate(staging)
        reading = read_options(load_options)
        empty = f"SELECT * FROM {name} WHERE 1 = 0"
        target = read_jdbc(df.sparkSession, url, empty, **reading).schema
        if spec.expressions is not None:
            bound = bind_expr(df, spec.expressions, target, errors=True)
        elif spec.fields is not None:
            bound = bind(df, spec.fields, target, errors=True)
        else:
            bound = bind_by_name(df, target, errors=True)
        statements = [ctx.evaluate(text) for text in publish]
        counts = load_staged_jdbc(
            strict(bound), url, name, connect, statements, before_publish, **load_options
        )
        return LoadResult(counts, start, now_millis())

    return load
