"""Run identity: the table id, the commit epoch and the placeholders they fill."""

from __future__ import annotations

import secrets
import string
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The alphabet and the length of a table id, the two placeholder names.
ALPHABET = string.digits + string.ascii_lowercase
ID_LENGTH = 10
TABLE_ID = "TABLE_ID"
COMMIT_EPOCH = "COMMIT_EPOCH"


class TableIdInUse(RuntimeError):
    """The table id of this run was already used by an earlier one."""


@dataclass(frozen=True)
class RunContext:
    """Names the loads of one run. `commit_epoch` counts the loads that were published; `attempt` tells
    tries at one load apart."""

    table_id: str
    commit_epoch: int = 0
    attempt: str = ""

    def next_epoch(self) -> RunContext:
        return replace(self, commit_epoch=self.commit_epoch + 1)

    def evaluate(self, text: str | None) -> str | None:
        """Fill the placeholders in a statement or a table name; names are case-sensitive."""
        if text is None:
            return None
        for name, value in self.as_map().items():
            text = text.replace(f"%{name}%", value)
        return text

    def as_map(self) -> dict[str, str]:
        return {TABLE_ID: self.table_id, COMMIT_EPOCH: str(self.commit_epoch)}


def new_context(id_length: int = ID_LENGTH) -> RunContext:
    return RunContext("".join(secrets.choice(ALPHABET) for _ in range(id_length)))


def with_context(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Stamp rows with the load they belong to."""
    return df.withColumns(
        {TABLE_ID: F.lit(ctx.table_id), COMMIT_EPOCH: F.lit(ctx.commit_epoch).cast("int")}
    )


def fill_placeholders(template: Column, table_id: Column, epoch: Column) -> Column:
    """`RunContext.evaluate` for statement templates that are held in a column."""
    filled = F.replace(template, F.lit(f"%{TABLE_ID}%"), table_id)
    return F.replace(filled, F.lit(f"%{COMMIT_EPOCH}%"), epoch.cast("string"))


def create_claims(spark: SparkSession, claims: str) -> None:
    """A table whose partitions are the table ids that runs have claimed."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {claims} (claimed BOOLEAN, {TABLE_ID} STRING) "
        f"USING parquet PARTITIONED BY ({TABLE_ID})"
    )


def claim_id(spark: SparkSession, claims: str, ctx: RunContext) -> None:
    """Claim the table id of a run; raises when another run has it or has used it.

    A claim is a partition, which the catalog adds for one of several runs that try at the same time.
    """
    try:
        spark.sql(f"ALTER TABLE {claims} ADD PARTITION ({TABLE_ID} = '{ctx.table_id}')")
    except AnalysisException as error:
        if "ALREADY_EXIST" not in (error.getCondition() or ""):
            raise
        raise TableIdInUse(f"table id {ctx.table_id} is claimed in {claims}") from error


def release_id(spark: SparkSession, claims: str, ctx: RunContext) -> None:
    """Give back the table id of a run that has left nothing under it."""
    spark.sql(f"ALTER TABLE {claims} DROP IF EXISTS PARTITION ({TABLE_ID} = '{ctx.table_id}')")


def assert_unused(spark: SparkSession, ledger: str, ctx: RunContext) -> None:
    """Raise when the ledger table already knows this table id."""
    used = spark.table(ledger).filter(F.col(TABLE_ID) == ctx.table_id).select(TABLE_ID)
    if not used.isEmpty():
        raise TableIdInUse(f"table id {ctx.table_id} is already in use in {ledger}")
