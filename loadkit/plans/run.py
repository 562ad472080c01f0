"""A run: one context, a session of its own, and a load sequence for each unit of work."""

from __future__ import annotations

import json
import logging
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.context import (
    COMMIT_EPOCH,
    TABLE_ID,
    RunContext,
    claim_id,
    create_claims,
    new_context,
    release_id,
    with_context,
)
from loadkit.operators.binding import ERROR, RAW, bind, bind_by_name, bind_expr, strict
from loadkit.operators.loading import (
    LoadResult,
    attaches,
    core_schema,
    land,
    landed_rows,
    load_batch,
    load_location,
    publish_attach,
)
from loadkit.operators.routing import UNIT_POLICY, land_routes, read_control, split_bad
from loadkit.operators.settings import SETTINGS, match_settings, plan_files
from loadkit.plans.outcomes import PUBLISHED, REFUSED, note_end, note_files
from loadkit.plans.report import build_reports, read_reports, report_row, write_reports
from loadkit.plans.scripts import Statement, Step, now_millis, run_script
from loadkit.session import TableFacts, discard, materialise, scratch_path, table_facts
from loadkit.sources.records import UNIT, UNIT_SIZE

logger = logging.getLogger(__name__)

RAISE_POLICY = "raise"
LANDED_VIEW = f"landed_%{TABLE_ID}%_%{COMMIT_EPOCH}%"


@dataclass(frozen=True)
class Unit:
    """One unit of work: what it is called, its size in bytes, how a session reads it, and how it is
    loaded if it differs from others of its run."""

    name: str
    size: int
    read: Callable[[SparkSession], DataFrame]
    spec: LoadSpec | None = None


# Loads a bound unit; calls the given function with the good rows before it publishes them.
Loader = Callable[[DataFrame, "LoadSpec", RunContext, Callable[[DataFrame], None]], LoadResult]


@dataclass(frozen=True)
class LoadSpec:
    """What to do with every unit of a run.

    `target` and the scripts may hold placeholders. A target made by `create_core` receives a load
    as a partition; any other table is appended to. Columns are bound by position (`fields`), by SQL
    expression (`expressions`) or else by name.

    `before_publish` runs once the rows are written and before anyone can see them; it finds them in
    the view `landed_%TABLE_ID%_%COMMIT_EPOCH%`, and an error there publishes nothing.

    `failure` says what a bad record does: `unit` keeps the rows of its file out of the target, `row`
    only the record itself, and `raise` fails the load. Rows kept out go to the `failures` folder.

    `outcomes` is a folder to which every load writes its files before it is published and how it ended
    after that; `read_outcomes` tells what was loaded, what failed, and how many records of it.

    `loader` replaces the load itself, for targets on another channel such as a database.
    """

    target: str
    fields: Sequence[str] | None = None
    expressions: Mapping[str, str] | None = None
    before_loading: Sequence[Statement] = ()
    before_publish: Sequence[Statement] = ()
    after_loaded: Sequence[Statement] = ()
    failure: str = UNIT_POLICY
    failures: str | None = None
    outcomes: str | None = None
    loader: Loader | None = None


class Run:
    """The state of a run. `ctx` belongs to the load that runs next; `reports` to those done.

    With a `reports_path` the reports are in that folder only, and the driver holds none of them.
    """

    def __init__(self, spark: SparkSession, ctx: RunContext, reports_path: str | None = None):
        self.spark = spark
        self.ctx = ctx
        self.reports_path = reports_path
        self.rows: list[tuple] = []
        self.loaded: list[tuple] = []
        self.tried = False

    def script(self, name: str, statements: Sequence[Statement] | None) -> None:
        """Run a script that belongs to the run as a whole and report it."""
        start = now_millis()
        step = run_script(self.spark, name, statements, self.ctx)
        if step:
            self._report(report_row(self.ctx, 0, [step], None, start, now_millis()))

    def _report(self, row: tuple) -> None:
        if self.reports_path:
            write_reports(build_reports(self.spark, [row]), self.reports_path)
        else:
            self.rows.append(row)

    def load(self, unit: Unit, spec: LoadSpec | None = None) -> LoadResult:
        """Load one unit: script, load, publish, script, report. An error publishes nothing.

        A unit that brings a spec is loaded by its own.
        """
        self.tried = True
        ctx, start = replace(self.ctx, attempt=uuid.uuid4().hex), now_millis()
        spec = unit.spec or spec
        if spec is None:
            raise ValueError(f"no spec says how to load {unit.name}")
        steps: list[Step | None] = []

        def script(name: str, statements: Sequence[Statement]) -> None:
            steps.append(run_script(self.spark, name, statements, ctx))

        def before_publish(rows: DataFrame) -> None:
            if spec.before_publish:
                view = ctx.evaluate(LANDED_VIEW)
                rows.createOrReplaceTempView(view)
                try:
                    script("beforePublish", spec.before_publish)
                finally:
                    # A unit that was not read with the run's session leaves its view in another one.
                    rows.sparkSession.catalog.dropTempView(view)

        def end(how: str) -> None:
            if spec.outcomes:
                note_end(self.spark, unit.name, how, ctx, spec.outcomes)

        try:
            script("beforeLoading", spec.before_loading)
            loader = spec.loader or load_unit
            result = loader(unit.read(self.spark), spec, ctx, before_publish)
        except Exception:
            end(REFUSED)
            raise
        # What follows finds the rows in the target, whether it succeeds or not.
        end(PUBLISHED)
        script("afterLoaded", spec.after_loaded)
        self._report(report_row(ctx, unit.size, steps, result, start, now_millis()))
        self.loaded.append((unit.name, unit.size, result.rows, *ctx.as_map().values()))
        self.ctx = ctx.next_epoch()
        return result

    def reports(self) -> DataFrame:
        if not self.reports_path:
            return build_reports(self.spark, self.rows)
        return read_reports(self.spark, self.reports_path, self.ctx)

    def loaded_units(self) -> DataFrame:
        """The units passed through, with the context of their load."""
        return self.spark.createDataFrame(
            [(n, s, r, t, int(e)) for n, s, r, t, e in self.loaded],
            f"{UNIT} string, {UNIT_SIZE} bigint, rows bigint, TABLE_ID string, COMMIT_EPOCH int",
        )


def run_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings and database whose own settings stay its own."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return session


@contextmanager
def open_run(
    spark: SparkSession,
    after_connected: Sequence[Statement] | None = None,
    before_disconnecting: Sequence[Statement] | None = None,
    ctx: RunContext | None = None,
    reports_path: str | None = None,
    claims: str | None = None,
) -> Iterator[Run]:
    """Open a run; the closing script also runs after a failure.

    `reports_path` is a folder to which each report is appended as soon as it is there. With a table of
    `claims` the run claims its table id before anything else and raises if it is in use; the claim
    stays for good once a load was tried, and is released if none was.
    """
    run = Run(run_session(spark), ctx or new_context(), reports_path)
    opened = run.ctx
    if claims:
        create_claims(spark, claims)
        claim_id(spark, claims, opened)
    logger.info("run %s opened", opened.table_id)
    try:
        run.script("afterConnected", after_connected)
        try:
            yield run
        finally:
            run.script("beforeDisconnecting", before_disconnecting)
    finally:
        if claims and not run.tried:
            release_id(spark, claims, opened)


def bind_unit(df: DataFrame, spec: LoadSpec, target: str) -> DataFrame:
    """Bind a unit as its spec says, with the error and the unit of every row."""
    schema = core_schema(df.sparkSession, target)
    if UNIT not in df.columns:
        df = df.withColumn(UNIT, F.lit(None).cast("string"))
    if spec.expressions is not None:
        return bind_expr(df, spec.expressions, schema, keep=(UNIT,), errors=True)
    if spec.fields is not None:
        return bind(df, spec.fields, schema, on_absent="default", keep=(UNIT,), errors=True)
    return bind_by_name(df, schema, on_absent="default", keep=(UNIT,), errors=True)


def load_unit(
    df: DataFrame,
    spec: LoadSpec,
    ctx: RunContext,
    before_publish: Callable[[DataFrame], None] = lambda rows: None,
) -> LoadResult:
    """Bind a unit, keep bad records out, and make the rest visible in one step.

    The source is read once. A target partitioned by load gets the written files as they are, unless
    bad records have to be taken out; other targets get a copy in one committed append.
    """
    spark = df.sparkSession
    target = ctx.evaluate(spec.target)
    bound = bind_unit(df, spec, target)
    facts = table_facts(spark, target)
    attach = attaches(facts)
    if spec.failure == RAISE_POLICY:
        bound = strict(bound)
        if not attach and not spec.before_publish:
            return load_batch(bound.drop(UNIT), target)

    def place(part: str = "") -> str:
        if not attach:
            return scratch_path(spark, "landing")
        return load_location(spark, target, ctx, part, facts.location)

    # A second folder beside the first holds the good rows alone, if there are bad ones.
    location, good = place(), place("-good")
    try:
        result = _land_and_publish(bound, spec, ctx, before_publish, target, facts, location, good)
    except Exception:
        for folder in (location, good):
            discard(spark, folder)
        raise
    if result.location != location:
        discard(spark, location)
    return result


def _land_and_publish(
    bound: DataFrame,
    spec: LoadSpec,
    ctx: RunContext,
    before_publish: Callable[[DataFrame], None],
    target: str,
    facts: TableFacts,
    location: str,
    good: str,
) -> LoadResult:
    spark, attach = bound.sparkSession, attaches(facts)
    provider = facts.provider if attach else "parquet"
    landed = land(bound, location, provider)
    rows = landed_rows(spark, landed, bound.schema)
    if spec.outcomes:
        note_files(rows, spec.failure, ctx, spec.outcomes)
    if landed.bad:
        rows, failed = split_bad(rows, spec.failure)
        logger.warning("%d bad records kept out of %s, see %s", landed.bad, target, location)
        if spec.failures:
            failed = with_context(failed, ctx)
            failed.write.mode("append").parquet(ctx.evaluate(spec.failures))
    rows = rows.drop(UNIT, ERROR, RAW)
    if attach and landed.bad:
        kept = land(rows, good, provider)
        landed = replace(kept, bad=landed.bad, start=landed.start)
        rows = landed_rows(spark, landed, rows.schema)
    before_publish(rows)
    if not attach:
        result = load_batch(rows, target)
        return replace(result, start=landed.start, bad=landed.bad)
    publish_attach(spark, target, landed.location, ctx)
    return replace(landed, stop=now_millis())


def file_units(
    planned: DataFrame,
    read: Callable[[SparkSession, list[str]], DataFrame],
    largest_first: bool = False,
) -> Iterator[Unit]:
    """The units of `plan_units` in order, or the largest first, which evens out parallel loads.

    Only paths and sizes reach the driver, unit by unit.
    """
    files, order = planned.select("unit_no", UNIT, UNIT_SIZE), ["unit_no", UNIT]
    if largest_first:
        totals = files.groupBy("unit_no").agg(F.sum(UNIT_SIZE).alias("_total"))
        files, order = files.join(totals, "unit_no"), [F.col("_total").desc(), *order]
    files = files.orderBy(*order).toLocalIterator()
    for number, of_unit in groupby(files, key=lambda row: row["unit_no"]):
        found = list(of_unit)
        paths = [row[UNIT] for row in found]
        name = paths[0] if len(paths) == 1 else f"unit {number}, {len(paths)} files"
        yield Unit(name, sum(row[UNIT_SIZE] for row in found), lambda spark, p=paths: read(spark, p))


#: What control rows may say about a load; the rest goes to the function that reads the files.
SPEC_FIELDS = frozenset(f.name for f in fields(LoadSpec)) - {"loader"}

SettingsReader = Callable[[SparkSession, list[str], dict], DataFrame]


def settings_units(planned: DataFrame, read: SettingsReader) -> Iterator[Unit]:
    """The units of `plan_files`, each with the spec that its settings give.

    `read` gets a session, the paths of a unit, and the settings that are not those of a load, such
    as a format or a schema.
    """
    files = planned.select("unit_no", UNIT, UNIT_SIZE, SETTINGS).orderBy("unit_no", UNIT).toLocalIterator()
    for number, of_unit in groupby(files, key=lambda row: row["unit_no"]):
        found = list(of_unit)
        given = json.loads(found[0][SETTINGS])
        spec = LoadSpec(**{k: v for k, v in given.items() if k in SPEC_FIELDS})
        rest = {k: v for k, v in given.items() if k not in SPEC_FIELDS}
        paths = [row[UNIT] for row in found]
        name = paths[0] if len(paths) == 1 else f"unit {number}, {len(paths)} files"
        size = sum(row[UNIT_SIZE] for row in found)
        yield Unit(name, size, lambda spark, p=paths, r=rest: read(spark, p, r), spec)


def run_files(
    spark: SparkSession,
    listing: DataFrame,
    control: DataFrame,
    read: SettingsReader,
    target_bytes: int | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Load the files of a listing, each with the settings that the control table has for its path.

    See `match_settings` and `plan_files`; `options` are those of `run_load`. Returns the reports, whose
    sizes are those of the files, and the files that no row of the control table fits.
    """
    matched = materialise(match_settings(listing, control), "matched")
    units = settings_units(plan_files(matched, target_bytes), read)
    reports = run_load(spark, units, **options)
    return reports, matched.filter(F.col(SETTINGS).isNull()).select(UNIT, UNIT_SIZE)


class _Queue:
    """Units for runs side by side, in order, under a bound of bytes that are on their way."""

    def __init__(self, units: Iterable[Unit], most: int | None) -> None:
        self.units, self.most = iter(units), most
        self.bytes, self.stopped, self.turn = 0, False, threading.Lock()
        self.changed = threading.Condition()

    def take(self) -> Unit | None:
        """The next unit once there is room for it; None when there are no more or the runs stop."""
        # One at a time, so that a large unit is not passed by smaller ones for ever.
        with self.turn:
            unit = None if self.stopped else next(self.units, None)
            if unit is None:
                return None
            with self.changed:
                self.changed.wait_for(lambda: self.stopped or self._fits(unit.size))
                if self.stopped:
                    return None
                self.bytes += unit.size
                return unit

    def _fits(self, size: int) -> bool:
        return self.most is None or not self.bytes or self.bytes + size <= self.most

    def done(self, unit: Unit) -> None:
        with self.changed:
            self.bytes -= unit.size
            self.changed.notify_all()

    def stop(self) -> None:
        with self.changed:
            self.stopped = True
            self.changed.notify_all()


def run_load(
    spark: SparkSession,
    units: Iterable[Unit],
    spec: LoadSpec | None = None,
    after_connected: Sequence[Statement] | None = None,
    before_disconnecting: Sequence[Statement] | None = None,
    ctx: RunContext | None = None,
    parallel: int = 1,
    reports_path: str | None = None,
    claims: str | None = None,
    bytes_in_flight: int | None = None,
) -> DataFrame:
    """Load every waiting unit and return the reports. Units that bring a spec need no other.

    With a `reports_path` each report is appended to that folder as soon as it is there, and can be
    read after a failure.

    Every unit is a Spark job over all executors. Loads of many small files should bin them first.
    `parallel` bounds the units that load at a time: as many runs, each with a context and a session
    of its own, take units from the same queue. With `bytes_in_flight` the units that load at a time
    have no more bytes than that together; a larger one loads alone. Scripts that rewrite one table,
    such as a merge, must not run side by side.
    """
    if parallel > 1 and ctx:
        raise ValueError("runs side by side need a context each")
    queue = _Queue(units, bytes_in_flight)

    def work() -> Run:
        try:
            with open_run(
                spark, after_connected, before_disconnecting, ctx, reports_path, claims
            ) as run:
                while unit := queue.take():
                    run.load(unit, spec)
                    queue.done(unit)
            return run
        except BaseException:
            queue.stop()
            raise

    if parallel == 1:
        return work().reports()
    with ThreadPoolExecutor(parallel) as pool:
        runs = [future.result() for future in [pool.submit(work) for _ in range(parallel)]]
    return reduce(DataFrame.unionByName, [run.reports() for run in runs])


def run_routes(
    spark: SparkSession,
    df: DataFrame,
    control: DataFrame,
    on: str,
    gather: bool = False,
    ctx: RunContext | None = None,
    reports_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load the rows of every route into its own target with its own bindings and scripts.

    `control` has a row per route: `on`, `target` and optionally `fields`, `before_loading`,
    `before_publish` and `after_loaded`, each an array of text. The rows are written once and each
    load reads its own. Returns the reports, whose sizes are those of the written rows, and the rows
    that no route takes. With a `reports_path` each report is there as soon as its load is done.
    """
    landed = land_routes(df, on, gather)
    rows = read_control(control, on)
    sizes = landed.sizes(spark, [row[on] for row in rows])
    with open_run(spark, ctx=ctx, reports_path=reports_path) as run:
        for row in rows:
            settings = row.asDict()
            key, target = settings.pop(on), settings.pop("target")
            given = {name: value for name, value in settings.items() if value is not None}
            size = sizes[key]
            unit = Unit(str(key), size, lambda session, key=key: landed.rows(session, [key]))
            run.load(unit, LoadSpec(target, **given))
    return run.reports(), landed.rest(spark, [row[on] for row in rows])
