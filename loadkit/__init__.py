"""Bulk load and ELT for tables and databases, as Spark jobs."""

from loadkit.context import RunContext, new_context
from loadkit.operators.binding import bind, bind_by_name, bind_expr
from loadkit.operators.elt import (
    latest_per_key,
    loaded_rows,
    publish_append,
    publish_merge,
    purge,
    rollup,
)
from loadkit.operators.loading import (
    create_core,
    create_staging,
    load_batch,
    load_delimited,
    load_many,
    load_staged,
)
from loadkit.operators.rollups import RollupSpec, add_load, create_rollup, rolled_up, take_out
from loadkit.operators.routing import route, split_bad
from loadkit.operators.units import bin_minimum, bin_units, plan_units
from loadkit.plans.outcomes import read_outcomes
from loadkit.plans.run import (
    LoadSpec,
    Unit,
    file_units,
    open_run,
    run_files,
    run_load,
    run_routes,
)
from loadkit.session import build_session
from loadkit.sources.delimited import read_delimited, write_delimited
from loadkit.sources.records import list_units, read_records, read_unit_stream
from loadkit.streaming.drain import load_unpublished, run_stream

__all__ = [
    "LoadSpec",
    "RollupSpec",
    "RunContext",
    "Unit",
    "add_load",
    "bin_minimum",
    "bin_units",
    "bind",
    "bind_by_name",
    "bind_expr",
    "build_session",
    "create_core",
    "create_rollup",
    "create_staging",
    "file_units",
    "latest_per_key",
    "list_units",
    "load_batch",
    "load_delimited",
    "load_many",
    "load_staged",
    "load_unpublished",
    "loaded_rows",
    "new_context",
    "open_run",
    "plan_units",
    "publish_append",
    "publish_merge",
    "purge",
    "read_delimited",
    "read_outcomes",
    "read_records",
    "read_unit_stream",
    "rolled_up",
    "rollup",
    "route",
    "run_files",
    "run_load",
    "run_routes",
    "run_stream",
    "split_bad",
    "take_out",
    "write_delimited",
]
