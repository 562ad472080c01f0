from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import RunContext
from loadkit.operators.elt import rollup
from loadkit.operators.loading import create_core
from loadkit.plans.outcomes import read_outcomes
from loadkit.plans.run import LoadSpec, open_run
from loadkit.sources.records import UNIT, list_units, read_records, read_unit_stream
from loadkit.streaming.drain import (
    create_ledger,
    drain,
    landed_files,
    load_unpublished,
    note_units,
    published_units,
    run_stream,
    unpublished,
)

SCHEMA = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())


@pytest.fixture
def queue(folder):
    def put(name, *ids):
        lines = [json.dumps({"id": i, "v": "x"}) for i in ids]
        (folder / f"{name}.json").write_text("\n".join(lines) + "\n")

    put("a", 1, 2)
    put("b", 3)
    put("c", 4, 5, 6)
    return put


@pytest.fixture
def core(spark, db):
    create_core(spark, f"{db}.core", SCHEMA)
    create_ledger(spark, f"{db}.ledger")
    return f"{db}.core"


def stream(spark, folder, max_files=1):
    return read_unit_stream(spark, str(folder), "json", SCHEMA, max_files=max_files)


def ids(spark, core):
    return sorted(r["id"] for r in spark.table(core).collect())


def test_drain_lands_every_unit_and_stops(spark, folder, queue, path):
    landing, checkpoint = path("landing"), path("checkpoint")
    source = stream(spark, folder)
    query = drain(source, landing, checkpoint)
    assert not query.isActive
    schema = source.schema.add("_batch", "string")
    assert landed_files(spark, landing).select("_batch").distinct().count() == 3
    queue("d", 7)
    drain(stream(spark, folder), landing, checkpoint)
    landed = spark.read.schema(schema).parquet(landing)
    assert sorted(r["id"] for r in landed.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert landed.groupBy("_batch").agg({"_unit": "min"}).count() == 4


def test_every_batch_is_a_load(spark, folder, queue, path, db, core):
    where = (path("landing"), path("checkpoint"), f"{db}.ledger")
    spec = LoadSpec(core, fields=["id", "v"], after_loaded=["SELECT '%COMMIT_EPOCH%' AS epoch"])
    first = run_stream(spark, stream(spark, folder), spec, "s", *where).collect()
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6]
    assert sorted(r["load"]["updateCount"] for r in first) == [1, 2, 3]
    assert [r["attributes"]["COMMIT_EPOCH"] for r in first] == [0, 1, 2]
    assert all(r["size"] > 0 for r in first)
    again = run_stream(spark, stream(spark, folder), spec, "s", *where)
    assert again.isEmpty()
    queue("d", 7)
    more = run_stream(spark, stream(spark, folder), spec, "s", *where).collect()
    assert [r["load"]["updateCount"] for r in more] == [1]
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6, 7]


def test_a_failed_batch_is_loaded_by_the_next_call(spark, folder, queue, path, db, core):
    where = (path("landing"), path("checkpoint"), f"{db}.ledger")

    def fail_second(session, ctx):
        if ctx.commit_epoch == 1:
            raise RuntimeError("lost")

    broken = LoadSpec(core, fields=["id", "v"], before_publish=[fail_second])
    with pytest.raises(RuntimeError, match="lost"):
        run_stream(spark, stream(spark, folder), broken, "s", *where)
    assert 1 <= spark.table(core).count() < 6
    run_stream(spark, stream(spark, folder), LoadSpec(core, fields=["id", "v"]), "s", *where)
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6]


def test_published_batches_are_neither_kept_nor_opened(spark, folder, queue, path, db, core):
    landing, checkpoint = path("landing"), path("checkpoint")
    spec = LoadSpec(core, fields=["id", "v"], outcomes=path("outcomes"))
    out = path("reports")
    run_stream(spark, stream(spark, folder), spec, "s", landing, checkpoint, f"{db}.ledger", reports_path=out)
    left = [f for f in glob.glob(f"{landing.removeprefix('file:')}/**/*.parquet", recursive=True)]
    assert left == [] and landed_files(spark, landing).count() == 3
    queue("d", 7)
    run_stream(spark, stream(spark, folder), spec, "s", landing, checkpoint, f"{db}.ledger", reports_path=out)
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6, 7]
    assert spark.read.parquet(out).count() == 4
    found = read_outcomes(spark, spec.outcomes).collect()
    assert sorted((r[UNIT].rsplit("/")[-1], r["status"], r["rows"]) for r in found) == [
        ("a.json", "loaded", 2), ("b.json", "loaded", 1), ("c.json", "loaded", 3), ("d.json", "loaded", 1)
    ]


def test_malformed_units_of_a_stream_are_kept_out(spark, folder, queue, path, db, core):
    (folder / "z.json").write_text('{"id":9,"v":"x"}\n{bad\n')
    spec = LoadSpec(core, fields=["id", "v"], failures=path("failures"))
    where = (path("landing"), path("checkpoint"), f"{db}.ledger")
    run_stream(spark, stream(spark, folder, max_files=10), spec, "s", *where)
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6]
    assert spark.read.parquet(spec.failures).count() == 2


def read(session, paths):
    return read_records(session, paths, "json", SCHEMA)


def test_replayed_units_load_once(spark, folder, queue, db, core):
    spec, ledger = LoadSpec(core, fields=["id", "v"]), f"{db}.ledger"
    listing = list_units(spark, str(folder), "*.json")
    with open_run(spark) as run:
        first = listing.filter(f"{UNIT} NOT LIKE '%c.json'")
        assert load_unpublished(run, first, read, spec, ledger, "s") == 2
    for expected in (1, 0):
        with open_run(spark) as run:
            assert load_unpublished(run, listing, read, spec, ledger, "s") == expected
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6]
    assert unpublished(spark, listing, ledger, core, "s").isEmpty()
    assert unpublished(spark, listing, ledger, core, "other").count() == 3


def test_a_stopped_run_is_finished_by_the_next(spark, folder, queue, db, core):
    ledger = f"{db}.ledger"
    listing = list_units(spark, str(folder), "*.json")
    broken = LoadSpec(core, fields=["id", "v"], before_loading=["SELECT 1 / (1 - %COMMIT_EPOCH%)"])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        with open_run(spark) as run:
            load_unpublished(run, listing, read, broken, ledger, "s")
    assert ids(spark, core) == [1, 2]
    with open_run(spark) as run:
        spec = LoadSpec(core, fields=["id", "v"])
        assert load_unpublished(run, listing, read, spec, ledger, "s", target_bytes=10_000) == 1
    assert ids(spark, core) == [1, 2, 3, 4, 5, 6]


def test_an_entry_without_a_load_does_not_count(spark, db, core):
    ledger = f"{db}.ledger"
    note_units(ledger, spark.sql(f"SELECT 'u' AS {UNIT}, 0 AS unit_no"), "s", RunContext("0123abcdef"))
    assert published_units(spark, ledger, core, "s").isEmpty()


def test_a_stream_is_rolled_up_behind_its_watermark(spark, folder, path):
    lines = [json.dumps({"ts": f"2024-01-01 0{h}:{m}:00", "v": h}) for h in (0, 1, 5) for m in (10, 50)]
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    schema = T.StructType().add("ts", T.TimestampType()).add("v", T.IntegerType())
    source = read_unit_stream(spark, str(folder), "json", schema)
    hourly = rollup(source, "ts", "1 hour", [], {"n": F.count(F.lit(1))}, watermark="1 hour")
    out = path("hourly")
    query = (
        hourly.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", path("checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.schema("bucket timestamp, n long").parquet(out).collect()
    assert sorted((r["bucket"].hour, r["n"]) for r in got) == [(0, 2), (1, 2)]
