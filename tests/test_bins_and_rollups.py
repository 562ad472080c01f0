"""Bins with a minimum, roll-ups that follow loads, and the bound of parallel loads."""

from __future__ import annotations

import random
import threading
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from loadkit.context import RunContext, new_context
from loadkit.operators.elt import purge
from loadkit.operators.loading import create_core, load_many
from loadkit.operators.rollups import (
    RollupSpec,
    add_load,
    create_rollup,
    missing_loads,
    rolled_up,
    rollup_spec,
    take_out,
)
from loadkit.operators.units import _Slice, bin_minimum, plan_units
from loadkit.plans.run import Unit, _Queue, file_units
from loadkit.sources.records import UNIT, UNIT_SIZE
from loadkit.streaming import drain


def greedy(sizes, minimum):
    out, number, open_now = [], 0, 0
    for size in sizes:
        if open_now >= minimum:
            number, open_now = number + 1, 0
        out.append(number)
        open_now += size
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=6), max_size=6), st.integers(1, 25))
def test_slices_pass_on_what_is_open(slices, minimum):
    number, carry, got = 0, 0, []
    for sizes in slices:
        part = _Slice(np.array(sizes, np.int64), minimum)
        got += part.numbers(carry, number).tolist()
        taken = [p for p in part.pieces() if p[0] <= carry][-1]
        carry, number = (carry + sum(sizes) if taken[1] is None else taken[1]), number + taken[2]
    assert got == greedy([s for sizes in slices for s in sizes], minimum)


@pytest.mark.parametrize("minimum, most", [(1, 3), (100, 60), (10**9, 60)])
def test_bins_hold_the_minimum(spark, minimum, most):
    rng = random.Random(minimum)
    sizes = [rng.choice([0, 1, rng.randrange(most), None]) for _ in range(300)]
    rows = spark.createDataFrame([(f"f{i:04d}", s, i) for i, s in enumerate(sizes)], "path string, rows int, own int")
    got = bin_minimum(rows.repartition(5), minimum, ["path"]).orderBy("path").collect()
    assert [r["bin"] for r in got] == greedy([s or 0 for s in sizes], minimum)
    assert [r["own"] for r in got] == list(range(300))


def test_units_with_least_rows(spark):
    listing = spark.createDataFrame([("a", 10, 5), ("b", 10, 6), ("c", 10, 20), ("d", 10, 1)], f"{UNIT} string, {UNIT_SIZE} bigint, rows bigint")
    plan = plan_units(listing, least_rows=10).orderBy(UNIT).collect()
    assert [r["unit_no"] for r in plan] == [0, 0, 1, 2]
    assert bin_minimum(listing.limit(0), 10, [UNIT]).isEmpty()
    with pytest.raises(ValueError):
        bin_minimum(listing, 0, [UNIT])


def test_a_roll_up_follows_its_loads(spark, db):
    schema = T.StructType().add("ts", T.TimestampType()).add("k", T.StringType()).add("v", T.IntegerType()).add("load", T.IntegerType())
    rows = spark.sql(
        "SELECT timestamp_seconds(id * 700) AS ts, CAST(id % 3 AS STRING) AS k,"
        " CAST(if(id % 5 = 0, NULL, id) AS INT) AS v, CAST(id % 4 AS INT) AS load FROM range(100)"
    )
    core, table, ctx = f"{db}.core", f"{db}.hourly", new_context()
    create_core(spark, core, schema)
    load_many(rows, ["load"], core, ctx)
    spec = RollupSpec("ts", "1 hour", ["k"], {"n": ["count", "1"], "mean": ["avg", "v"], "top": ["max", "v * 2"], "what": ["min", "concat('it''s \\\\', k)"]})
    create_rollup(spark, table, core, spec)
    assert rollup_spec(spark, table) == spec and missing_loads(spark, table, core).count() == 4
    loads = [RunContext(ctx.table_id, e) for e in range(4)]
    assert [add_load(spark, table, core, load) > 0 for load in [*loads, loads[0]]] == [True] * 4 + [False]
    assert missing_loads(spark, table, core).isEmpty()
    purge(spark, core, loads[3])
    take_out(spark, table, loads[3])
    want = spark.table(core).groupBy("k").agg({"ts": "count"}).count()
    got = rolled_up(spark, table)
    direct = spark.sql(f"""
        SELECT date_trunc('hour', ts) AS bucket, k, count(1) AS n, avg(v) AS mean, max(v * 2) AS top,
            min(concat('it''s \\\\', k)) AS what FROM {core} GROUP BY 1, 2
    """)
    assert want == 3 and sorted(map(str, got.select(direct.columns).collect())) == sorted(map(str, direct.collect()))
    with pytest.raises(ValueError, match="median"):
        create_rollup(spark, f"{db}.other", core, RollupSpec("ts", "1 hour", [], {"m": ["median", "v"]}))


def test_bytes_in_flight_are_bounded():
    rng = random.Random(7)
    sizes = [rng.randrange(1, 40) for _ in range(60)] + [500]
    queue = _Queue([Unit(str(i), s, None) for i, s in enumerate(sizes)], 100)
    now, peaks, taken, lock = [], [], [], threading.Lock()

    def work():
        while unit := queue.take():
            with lock:
                now.append(unit.size)
                taken.append(unit.name)
                peaks.append((sum(now), len(now)))
            time.sleep(0.001)
            with lock:
                now.remove(unit.size)
            queue.done(unit)

    threads = [threading.Thread(target=work) for _ in range(6)]
    [t.start() for t in threads]
    [t.join(30) for t in threads]
    assert sorted(map(int, taken)) == list(range(61))
    assert all(total <= 100 or n == 1 for total, n in peaks) and max(n for _, n in peaks) > 1


def test_a_stop_wakes_those_who_wait():
    queue = _Queue([Unit("a", 90, None), Unit("b", 90, None)], 100)
    assert queue.take().name == "a"
    got = []
    waiting = threading.Thread(target=lambda: got.append(queue.take()))
    waiting.start()
    queue.stop()
    waiting.join(10)
    assert got == [None]


def test_units_come_largest_first(spark):
    plan = spark.createDataFrame([(0, "a", 5), (0, "b", 5), (1, "c", 30), (2, "d", 10)], f"unit_no int, {UNIT} string, {UNIT_SIZE} bigint")
    got = [(u.name, u.size) for u in file_units(plan, lambda s, p: None, largest_first=True)]
    assert got == [("c", 30), ("unit 0, 2 files", 10), ("d", 10)]


def test_a_ledger_is_settled_and_compacted(spark, db):
    core, ledger = f"{db}.core", f"{db}.ledger"
    create_core(spark, core, T.StructType().add("id", T.IntegerType()))
    drain.create_ledger(spark, ledger)
    units = spark.createDataFrame([("u0", 0), ("u1", 1), ("u2", 2)], f"{UNIT} string, unit_no bigint")
    dead, later = RunContext("dead000000"), RunContext("later00000", 4)
    drain.note_units(ledger, units, "s", dead)  # published one load, then died
    spark.sql(f"ALTER TABLE {core} ADD PARTITION (TABLE_ID = 'dead000000', COMMIT_EPOCH = 1)")
    drain.note_units(ledger, units.filter("unit_no = 0"), "s", later)
    drain.note_units(ledger, units.filter("unit_no = 0"), "s", later, drain.PUBLISHED)
    drain.note_units(ledger, units, "other", later)
    names = lambda df: sorted(r[UNIT] for r in df.collect())
    assert names(drain.unpublished(spark, units, ledger, core, "s")) == ["u2"]
    drain.compact_ledger(spark, ledger, core, "s")
    rows = spark.table(ledger).filter("stream = 's'").collect()
    assert sorted((r[UNIT], r["TABLE_ID"], r["state"]) for r in rows) == [("u0", "later00000", "published"), ("u1", "dead000000", "published")]
    assert names(drain.unpublished(spark, units, ledger, core, "s")) == ["u2"]
    assert names(drain.unpublished(spark, units, ledger, core, "other")) == ["u0", "u1", "u2"]
