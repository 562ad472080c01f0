"""Running totals and numbering over a whole frame without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import materialise

_SLICE = "_slice"


def running_total(df: DataFrame, order_by: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add the sum of `value` over all rows before the current one; `order_by` must be unique.

    Range-partition into ordered slices, total each slice, then shift the running sum inside a slice
    by the totals of the slices before it. The slices are written first, because range bounds are
    sampled and must not differ between the two reads.
    """
    sliced = materialise(
        df.withColumn("_value", value.cast("bigint"))
        .repartitionByRange(*order_by)
        .withColumn(_SLICE, F.spark_partition_id()),
        "slices",
    )
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per shuffle partition, whatever the size of the data.
    offsets = (
        sliced.groupBy(_SLICE)
        .agg(F.sum("_value").alias("_total"))
        .select(_SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    within = (
        Window.partitionBy(_SLICE).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("_value").over(within), F.lit(0))
    return (
        sliced.withColumn("_inside", inside)
        .join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop(_SLICE, "_value", "_inside", "_offset")
    )


def number_rows(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number rows from 0 in the order of `order_by`, which must be unique."""
    return running_total(df, order_by, F.lit(1), name)
