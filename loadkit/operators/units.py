"""Units of work: merging small ones into large ones and numbering them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext
from loadkit.functions.sequence import number_rows, running_total
from loadkit.session import materialise, same_values
from loadkit.sources.records import UNIT, UNIT_SIZE

BIN = "bin"


def bin_units(
    listing: DataFrame,
    target_bytes: int,
    order_by: Sequence[str] = (UNIT,),
    size: str = UNIT_SIZE,
) -> DataFrame:
    """Assign consecutive units to bins of about `target_bytes`; `order_by` must be unique.

    A unit belongs to the bin in which it starts, so no unit is split.
    """
    placed = running_total(listing, order_by, F.col(size), "_start")
    return placed.withColumn(BIN, F.expr(f"_start div {int(target_bytes)}")).drop("_start")


class _Slice:
    """Consecutive units of a listing, and the cuts that follow from where one is made.

    From a cut before unit i the next one is before the first unit with which the minimum is reached.
    Following these jumps from behind gives, for each i, how much is open at the end of the slice.
    """

    def __init__(self, sizes: np.ndarray, minimum: int) -> None:
        self.minimum, self.n = minimum, len(sizes)
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self.jump = np.searchsorted(self.before, self.before[:-1] + minimum)
        self.open, self.cuts = np.zeros(self.n + 1, np.int64), np.zeros(self.n + 1, np.int64)
        for i in range(self.n - 1, -1, -1):
            if (to := self.jump[i]) <= self.n:
                self.open[i], self.cuts[i] = self.open[to], 1 + self.cuts[to]
            else:
                self.open[i] = self.before[-1] - self.before[i]

    def pieces(self) -> list[tuple[int, int | None, int]]:
        """What happens for each amount open at the start: from which amount on, what is then open at
        the end (null: the amount and all of the slice), and the number of cuts."""
        found: list[tuple[int, int | None, int]] = [(0, None, 0)]
        for i in range(self.n, 0, -1):
            start = max(0, self.minimum - int(self.before[i]))
            piece = (start, int(self.open[i]), 1 + int(self.cuts[i]))
            if start >= self.minimum or self.before[i] == self.before[i - 1]:
                continue
            if found[-1][0] == start:
                found[-1] = piece
            elif found[-1][1:] != piece[1:]:
                found.append(piece)
        return found

    def numbers(self, given: int, first: int) -> np.ndarray:
        """The number of the bin of each unit, if `given` is open at the start in bin `first`."""
        out, at = np.zeros(self.n, np.int64), int(np.searchsorted(self.before, self.minimum - given))
        while at <= self.n and at < len(out):
            out[at] += 1
            at = int(self.jump[at])
        return first + np.cumsum(out)


def bin_minimum(
    listing: DataFrame,
    minimum: int,
    order_by: Sequence[str] = (UNIT,),
    size: str = "rows",
) -> DataFrame:
    """Assign consecutive units to bins that each hold at least `minimum`, as few units as do; only the
    last bin may hold less. `order_by` must be unique.

    A bin ends with the unit that reaches the minimum, so each cut depends on the one before it. Slices
    of the order work out in parallel what follows from every amount they may be handed; the amounts
    are then passed from slice to slice, in the driver, one at a time; and the slices number their
    units. A null size counts as 0.
    """
    if minimum < 1:
        raise ValueError("a bin holds at least one")
    sized = listing.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("bigint"))
    sliced = materialise(
        sized.repartitionByRange(*order_by).withColumn("_slice", F.spark_partition_id()), "slices"
    )

    def pieces(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(list(order_by))
        part = _Slice(group["_size"].to_numpy(np.int64), minimum)
        found = pd.DataFrame(part.pieces(), columns=["start", "open", "cuts"]).astype({"open": "Int64"})
        return found.assign(total=int(part.before[-1]), slice=int(group["_slice"].iloc[0]))

    needed = sliced.select("_slice", "_size", *order_by)
    told = needed.groupBy("_slice").applyInPandas(
        pieces, "start bigint, open bigint, cuts bigint, total bigint, slice int"
    )
    given, number, starts = 0, 0, []
    for no, of_slice in groupby(told.orderBy("slice", "start").toLocalIterator(), lambda r: r["slice"]):
        starts.append((no, given, number))
        taken = None
        for row in of_slice:
            taken = row if row["start"] <= given else taken
        given = given + taken["total"] if taken["open"] is None else taken["open"]
        number += taken["cuts"]
    # A row per slice.
    handed = listing.sparkSession.createDataFrame(starts, "_slice int, _given bigint, _first bigint")

    def numbered(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(list(order_by))
        part = _Slice(group["_size"].to_numpy(np.int64), minimum)
        bins = part.numbers(int(group["_given"].iloc[0]), int(group["_first"].iloc[0]))
        return group.assign(**{BIN: bins})[[*order_by, BIN]]

    keys = needed.select(*order_by).schema
    joined = needed.join(F.broadcast(handed), "_slice")
    bins = joined.groupBy("_slice").applyInPandas(numbered, T.StructType([*keys.fields, T.StructField(BIN, T.LongType())]))
    return sliced.drop("_slice", "_size").join(bins, list(order_by))


def plan_units(
    listing: DataFrame, target_bytes: int | None = None, least_rows: int | None = None
) -> DataFrame:
    """The loads for a file listing, in path order: a row per file with the `unit_no` of its load.

    A load per file, or per bin of consecutive small files: of about `target_bytes`, or with at least
    `least_rows` by the column `rows` of the listing.
    """
    if least_rows:
        binned = bin_minimum(listing.select(UNIT, UNIT_SIZE, "rows"), least_rows)
        return materialise(binned.select(F.col(BIN).alias("unit_no"), UNIT, UNIT_SIZE))
    listing = listing.select(UNIT, UNIT_SIZE)
    if not target_bytes:
        # Numbered from written slices, so reading it again gives the same numbers.
        return number_rows(listing, [UNIT], "unit_no")
    binned = materialise(bin_units(listing, target_bytes))
    numbers = number_rows(binned.select(BIN).distinct(), [BIN], "unit_no")
    return materialise(binned.join(numbers, BIN).select("unit_no", UNIT, UNIT_SIZE))


def number_units(df: DataFrame, units: Sequence[str]) -> DataFrame:
    """One row per distinct unit with its commit epoch, counted from 0 in unit order."""
    return materialise(number_rows(df.select(*units).distinct(), units, COMMIT_EPOCH), "units")


def load_context(df: DataFrame, units: Sequence[str], ctx: RunContext) -> DataFrame:
    """Stamp the rows of many units with the context of the load each belongs to.

    The rows are not shuffled for the numbering: only distinct units are. The numbered units come
    from files, so the planner broadcasts them when they are small and else joins with a shuffle,
    where adaptive execution splits units that hold many rows.
    """
    epochs = number_units(df, units)
    epoch = (F.col(f"u.{COMMIT_EPOCH}") + F.lit(ctx.commit_epoch)).cast("int")
    joined = df.alias("d").join(epochs.alias("u"), same_values("d", "u", units))
    return joined.select("d.*", F.lit(ctx.table_id).alias(TABLE_ID), epoch.alias(COMMIT_EPOCH))


def unit_counts(df: DataFrame, units: Sequence[str | Column]) -> DataFrame:
    """Rows per unit; partial sums leave each task before the shuffle, so large units are no risk."""
    return df.groupBy(*units).agg(F.count(F.lit(1)).alias("update_count"))
