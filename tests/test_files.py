"""Outcomes, settings per file, mixed headers, claims and key filters."""

from __future__ import annotations

import os
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import RunContext, TableIdInUse, claim_id, create_claims, release_id
from loadkit.operators.elt import matched_rows, publish_merge
from loadkit.operators.keyfilter import key_filter
from loadkit.operators.loading import LOAD_COLUMNS, create_core, published_loads
from loadkit.operators.settings import match_settings, plan_files
from loadkit.plans.outcomes import note_files, read_outcomes
from loadkit.plans.run import LoadSpec, Unit, open_run, run_files, run_load, run_routes
from loadkit.session import table_location
from loadkit.sources.delimited import read_delimited, read_headers
from loadkit.sources.records import UNIT, UNIT_SIZE, SchemaMissing, list_units, read_records

TARGET = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())


class Refused(Exception):
    pass


def refuse(spark, ctx):
    raise Refused


def unit(spark, name, rows):
    return Unit(name, 1, lambda s: s.createDataFrame(rows, f"id string, v string, {UNIT} string"))


def files_below(folder):
    folder = folder.removeprefix("file:")
    return [f for _, _, names in os.walk(folder) for f in names if not f.startswith((".", "_"))]


# Outcomes


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("bad", [True, False])
def test_a_refused_load_leaves_nothing(spark, db, path, partitioned, bad):
    core, out = f"{db}.core", path("outcomes")
    if partitioned:
        create_core(spark, core, TARGET)
    else:
        spark.sql(f"CREATE TABLE {core} (id INT, v STRING) USING parquet")
    rows = [("1", "a", "one"), ("2", "b", "two"), ("x" if bad else "3", "c", "two")]
    spec = LoadSpec(core, fields=["id", "v"], outcomes=out, before_publish=[refuse])
    scratch = spark.conf.get("spark.checkpoint.dir")
    landings = lambda: {d for d in os.listdir(f"{scratch}/loadkit") if d.startswith("landing")}
    before = landings()
    with open_run(spark) as run:
        with pytest.raises(Refused):
            run.load(unit(spark, "both", rows), spec)
        assert run.spark.catalog.listTables(db) and not any(t.isTemporary for t in run.spark.catalog.listTables(db))
        assert spark.table(core).count() == 0
        assert landings() == before and files_below(table_location(spark, core)) == []
        got = read_outcomes(spark, out).collect()
        assert sorted((r[UNIT], r["status"], r["rows"]) for r in got) == [("one", "failed", 1), ("two", "failed", 2)]
        run.load(unit(spark, "both", rows), replace(spec, before_publish=()))
    got = sorted((r[UNIT], r["status"], r["bad"]) for r in read_outcomes(spark, out, core if partitioned else None).collect())
    assert got == [("one", "loaded", 0), ("two", "failed", 1) if bad else ("two", "loaded", 0)] + [("two", "failed", 1)] * bad


def test_no_view_is_left_in_the_session_of_the_caller(spark, db):
    create_core(spark, f"{db}.core", TARGET)
    rows = spark.createDataFrame([("1", "a")], "id string, v string")
    spec = LoadSpec(f"{db}.core", fields=["id", "v"], before_publish=[lambda s, c: 1])
    run_load(spark, [Unit("u", 0, lambda s: rows)], spec)
    assert not any(t.isTemporary and t.name.startswith("landed") for t in spark.catalog.listTables())


def test_a_load_that_raises_before_its_files_are_known(spark, db, path):
    create_core(spark, f"{db}.core", TARGET)
    spec = LoadSpec(f"{db}.core", fields=["id", "v"], outcomes=path("outcomes"), before_loading=[refuse])
    with pytest.raises(Refused):
        run_load(spark, [unit(spark, "u", [("1", "a", "one")])], spec)
    (row,) = read_outcomes(spark, spec.outcomes).collect()
    assert (row[UNIT], row["status"], row["rows"]) == ("u", "failed", None)
    assert read_outcomes(spark, path("none")).isEmpty()


def test_an_error_behind_the_publish_does_not_undo_it(spark, db, path):
    create_core(spark, f"{db}.core", TARGET)
    spec = LoadSpec(f"{db}.core", fields=["id", "v"], outcomes=path("outcomes"), after_loaded=[refuse])
    with pytest.raises(Refused):
        run_load(spark, [unit(spark, "u", [("1", "a", "one")])], spec)
    (row,) = read_outcomes(spark, spec.outcomes).collect()
    assert (row["status"], spark.table(f"{db}.core").count()) == ("loaded", 1)


def test_loads_that_died_are_settled_by_their_partitions(spark, db, path):
    core, out = f"{db}.core", path("outcomes")
    create_core(spark, core, TARGET)
    landed = spark.createDataFrame([("one", None)], f"{UNIT} string, _error string")
    for table_id in ("alive00000", "dead000000"):
        note_files(landed, "unit", RunContext(table_id, 3, "a"), out)
    spark.sql(f"ALTER TABLE {core} ADD PARTITION (TABLE_ID = 'alive00000', COMMIT_EPOCH = 3)")
    assert [r["status"] for r in read_outcomes(spark, out).collect()] == ["pending"] * 2
    (row,) = read_outcomes(spark, out, core).collect()  # loaded in the end, so not failed as well
    assert (row["status"], row["TABLE_ID"]) == ("loaded", "alive00000")
    assert published_loads(spark, core, ["dead000000"]).isEmpty()


# Settings per file


def listing(spark, *files):
    return spark.createDataFrame(list(files), f"{UNIT} string, {UNIT_SIZE} bigint")


def test_settings_follow_priority_and_captures(spark):
    control = spark.createDataFrame(
        [
            (".*[.]csv", 5, "text", ["SELECT 1"], {"sep": ";"}),
            (r".*/(\w+)_(\d+)[.]csv", 1, "t_$1", ["SELECT $2", None], None),
            (".*/plain[.]json", None, "cost $ 5", [], {}),
        ],
        "files string, priority int, target string, after_loaded array<string>, options map<string,string>",
    )
    files = listing(spark, ("s3://in/a_1.csv", 1), ("s3://in/b.csv", 2), ("s3://in/plain.json", 3), ("s3://in/x", 4))
    got = {r[UNIT][8:]: r["settings"] for r in match_settings(files, control).collect()}
    assert got["a_1.csv"] == '{"target":"t_a","after_loaded":["SELECT 1",null]}'
    assert got["x"] is None
    assert '"cost $ 5"' in got["plain.json"]
    with pytest.raises(ValueError, match="group"):
        match_settings(files, spark.createDataFrame([(".*", "$1")], "files string, target string"))
    none = control.limit(0)
    assert [r["settings"] for r in match_settings(files, none).collect()] == [None] * 4


def test_files_of_equal_settings_share_units(spark):
    rng = random.Random(2)
    files = [(f"f{i:03d}.{rng.choice('ab')}", rng.randrange(1, 40)) for i in range(60)]
    control = spark.createDataFrame([(".*a", "one"), (".*b", "two")], "files string, target string")
    plan = plan_files(match_settings(listing(spark, *files, ("odd", 5)), control), 100).collect()
    assert sorted((r[UNIT], r[UNIT_SIZE]) for r in plan) == sorted(files)
    of_unit = {}
    for r in plan:
        of_unit.setdefault(r["unit_no"], []).append((r["settings"], r[UNIT], r[UNIT_SIZE]))
    assert sorted(of_unit) == list(range(len(of_unit))) and len(of_unit) > 4
    for found in of_unit.values():
        assert len({s for s, _, _ in found}) == 1
        assert sum(size for _, _, size in sorted(found)[:-1]) < 100
    assert [r["unit_no"] for r in sorted(plan, key=lambda r: (r["settings"], r[UNIT]))] == sorted(r["unit_no"] for r in plan)


def test_run_files_reports_what_is_left(spark, db, folder):
    for name, text in (("a", "1|x"), ("b", "2|y"), ("c", "3|z")):
        (folder / f"{name}.txt").write_text(text + "\n")
    create_core(spark, f"{db}.core_a", TARGET)
    create_core(spark, f"{db}.core_b", TARGET)
    control = spark.createDataFrame(
        [(r".*/([ab])[.]txt", f"{db}.core_$1", ["id", "v"], ["SELECT '$1' AS name"], "|")],
        "files string, target string, fields array<string>, after_loaded array<string>, sep string",
    )

    def read(session, paths, given):
        return read_records(session, paths, "csv", T.StructType.fromDDL("id STRING, v STRING"), sep=given["sep"])

    reports, left = run_files(spark, list_units(spark, str(folder)), control, read)
    assert [r["size"] for r in reports.orderBy("start").collect()] == [4, 4]
    assert [r[UNIT].rsplit("/")[-1] for r in left.collect()] == ["c.txt"]
    assert [spark.table(f"{db}.core_{n}").first()["v"] for n in "ab"] == ["x", "y"]


def test_routes_report_sizes_and_keep_reports(spark, db, path):
    create_core(spark, f"{db}.one", TARGET)
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, v string")
    control = spark.createDataFrame([("a", f"{db}.one"), ("none", f"{db}.one")], "v string, target string")
    out = path("reports")
    reports, rest = run_routes(spark, rows, control, "v", reports_path=out)
    sizes = {r["load"]["updateCount"]: r["size"] for r in reports.collect()}
    assert sizes[2] > 0 and sizes[0] == 0 and rest.count() == 1
    assert spark.read.parquet(out).count() == 2


# Mixed headers


def test_mixed_headers(spark, folder):
    (folder / "a one.csv").write_text("id;name;x\n1;Zoë;\n2;b\n", "latin-1")
    (folder / "b.csv").write_text("name;id\n" + "".join(f"n{i};{i}\n" for i in range(3, 20_000)), "latin-1")
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("name;id\n", "latin-1")
    paths = [str(folder)]
    headers = read_headers(spark, paths, "ISO-8859-1")
    assert [(h, len(p)) for h, p in headers] == [("id;name;x", 1), ("name;id", 2)]
    got = read_delimited(spark, paths, ";", "ISO-8859-1", mixed=True)
    assert got.columns == ["id", "name", "x", "_malformed", UNIT, UNIT_SIZE]
    assert got.count() == 19_999
    rows = {r["id"]: r for r in got.filter("cast(id AS int) < 5").collect()}
    assert rows["1"]["name"] == "Zoë" and rows["2"]["_malformed"] == "2;b" and rows["4"]["name"] == "n4"
    (folder / "only").mkdir()
    (folder / "only" / "e.csv").write_text("")
    with pytest.raises(SchemaMissing):
        read_delimited(spark, str(folder / "only"), ";", mixed=True)


def test_first_lines_of_files_in_many_parts(spark, folder):
    (folder / "big.csv").write_text("a|b\n" + "1|2\n" * 50_000)
    (folder / "other.csv").write_text("b|a\n" + "1|2\n" * 50_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [h for h, _ in read_headers(spark, [str(folder)])] == ["a|b", "b|a"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# Claims


def test_claims(spark, db, ctx):
    claims = f"{db}.claims"
    create_claims(spark, claims)
    claim_id(spark, claims, ctx)
    with pytest.raises(TableIdInUse):
        claim_id(spark, claims, ctx)
    release_id(spark, claims, ctx)
    with open_run(spark, ctx=ctx, claims=claims):
        pass  # nothing was loaded, so the id is free again
    ran = []
    create_core(spark, f"{db}.core", TARGET)
    load = unit(spark, "u", [("1", "a", "one")])
    run_load(spark, [load], LoadSpec(f"{db}.core", fields=["id", "v"]), ctx=ctx, claims=claims)
    with pytest.raises(TableIdInUse):
        run_load(spark, [load], LoadSpec(f"{db}.core"), [lambda s, c: ran.append(1)], ctx=ctx, claims=claims)
    assert ran == [] and spark.table(f"{db}.core").count() == 1


# Key filters

KEYS = st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**40), 2**40)), st.one_of(st.none(), st.text(max_size=3))), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS)
def test_no_match_is_ruled_out(spark, staged, core):
    schema = T.StructType.fromDDL("k BIGINT, t STRING")
    staged_rows, core_rows = spark.createDataFrame(staged, schema), spark.createDataFrame(core + staged, schema)
    known = key_filter(staged_rows, ["k", "t"], schema, filter_from=1)
    passed = {tuple(r) for r in core_rows.filter(known.may_match()).collect()}
    assert passed >= {r for r in staged if None not in r}
    assert not any(None in r for r in passed)
    assert core_rows.filter(~known.may_match()).count() + core_rows.filter(known.may_match()).count() == len(core + staged)


def test_few_others_pass(spark):
    keys = spark.range(0, 40_000, 4).toDF("k")
    known = key_filter(keys, ["k"], keys.schema, filter_from=1)
    core = spark.range(-50_000, 90_000).toDF("k")
    assert known.size >= 10 * 10_000
    assert 10_000 <= core.filter(known.may_match()).count() < 12_500
    narrow = spark.range(100).select(F.col("id").cast("int").alias("k"))
    assert key_filter(keys, ["k"], narrow.schema, filter_from=1).n == 10_000
    assert narrow.filter(key_filter(keys, ["k"], narrow.schema, filter_from=1).may_match()).count() >= 25
    beyond = spark.sql("SELECT 5000000000 AS k UNION ALL SELECT 7")
    assert key_filter(beyond, ["k"], narrow.schema, filter_from=1).n == 1  # the other key fits no int


def test_the_scan_is_filtered_before_the_shuffle(spark, db):
    core = f"{db}.core"
    spark.range(10_000).selectExpr("id AS k", "id % 7 AS part", "id AS v").write.partitionBy("part").saveAsTable(core)
    staged = spark.range(100, 900, 3).selectExpr("id AS k", "id % 5 AS part", "-id AS v")
    known = key_filter(staged, ["k"], spark.table(core).schema, filter_from=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = matched_rows(spark.table(core), staged, ["k"], known)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan[plan.index("Exchange") : plan.index("core")]
    assert "getbit" in scan and "GreaterThanOrEqual(k,100)" in plan and "LessThanOrEqual(k,898)" in plan
    result = publish_merge(spark, core, staged, ["k"], filter_from=1)
    assert (result.updated, result.inserted) == (267, 0)
    want = {(i, (i % 5 if 100 <= i < 900 and (i - 100) % 3 == 0 else i % 7)) for i in range(10_000)}
    assert {(r["k"], r["part"]) for r in spark.table(core).collect()} == want


def test_unpartitioned_merge_keeps_rows_that_cannot_match(spark, db):
    core = f"{db}.plain"
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string").write.saveAsTable(core)
    staged = spark.createDataFrame([(2, "B"), (9, "new"), (None, "m")], "k bigint, v string")
    publish_merge(spark, core, staged.selectExpr("cast(k AS int) AS k", "v"), ["k"], filter_from=1)
    assert sorted((r["v"] for r in spark.table(core).collect())) == ["B", "a", "m", "n", "new"]
    assert LOAD_COLUMNS
