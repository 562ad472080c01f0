"""Operators that compare or weigh documents against each other."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadkit.llm import embeddings, exact_dedup, jaccard, mixing
from loadkit.llm.components import components
from loadkit.llm.queries import ORACLES, QUERIES
from tests.llm.odd import CLASHING, ROWS, no_docs, odd_docs, prose, words_of
from tests.oracle import TABLES, compare, connect

SF_DIR = f"{TABLES}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) == []


# Components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(8)
    links = {
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
        "path": [(i, i + 1) for i in range(70)],
        "star": [(500, i) for i in range(100)] + [(3, 3), (7, 500)],
        "none": [],
    }[shape]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == smallest_reachable(nodes, links)


# Exact dedup


def brute_dedup(rows):
    normal = {id(r): "".join(c for c in r[1] or "" if c not in " \t\n\x0b\f\r") for r in rows}
    groups = defaultdict(list)
    for r in rows:
        groups[normal[id(r)]].append(r)
    for r in rows:
        group = groups[normal[id(r)]]
        keep = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        yield r[0], keep[0], len(group), hashlib.sha256(normal[id(r)].encode()).hexdigest()


def index(spark, db):
    return exact_dedup.DigestIndex(spark, f"{db}.digests", 4)


def test_exact_dedup_odd(spark, db):
    docs = odd_docs(spark)
    got = index(spark, db).deduplicate(docs, "one")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert Counter(tuple(r) for r in got.select(columns).collect()) == Counter(brute_dedup(ROWS))
    kept = Counter(r["text_sha256"] for r in got.filter("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == got.select("text_sha256").distinct().count()


def test_exact_dedup_later_loads(spark, db):
    docs, known = odd_docs(spark), index(spark, db)
    first, later = docs.filter("doc_id < 10 OR doc_id IS NULL"), docs.filter("doc_id <> 14")
    once = known.deduplicate(first, "one").orderBy("doc_id", "text_sha256").collect()
    again = index(spark, db).deduplicate(first, "one").orderBy("doc_id", "text_sha256").collect()
    assert once == again  # a repeated load changes nothing
    kept = {r["doc_id"] for r in index(spark, db).deduplicate(later, "two").filter("kept").collect()}
    assert kept == {10, 11, 12, 13, 16}  # case counts, so 12 is no copy of 11
    assert known.deduplicate(no_docs(spark), "three").count() == 0


def test_exact_dedup_joins_the_sorted_index(spark, db):
    known = index(spark, db)
    known.deduplicate(odd_docs(spark), "one")
    left = spark.table(f"{db}.digests")
    plan = left.hint("merge").join(left.select("digest").hint("merge"), "digest", "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_unique_rows_keep_columns(spark, db):
    docs = odd_docs(spark)
    kept = exact_dedup.unique_rows(docs, index(spark, db), "one")
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    assert Counter(r["doc_id"] for r in rows) == Counter([3, 4, 5, 8, 9, 10, 11, 12, 13, 14, 16])


# Mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    cap, target = {s: most * sizes[s] for s in sources}, {}
    left, free = sum(sizes.values()), set(sources)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= cap[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
            free.remove(s)
    return target


def check_mix(rows):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want = brute_targets(dict(sizes))
    taken, longest = Counter(), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert (r["position"] is None) == (r["copies"] == 0) and 0 <= (r["position"] or 0) <= 1
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for source, words in taken.items():
        assert abs(words - want[source]) <= longest[source]


def test_mixing_odd(spark):
    rows = mixing.mix(odd_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    texts = {i: t for i, t, _, _ in ROWS}
    assert all(r["size"] == len(words_of(texts[r["doc_id"]])) for r in rows)
    check_mix(rows)
    assert mixing.mix(no_docs(spark)).count() == 0
    nothing = mixing.mix(odd_docs(spark).withColumn("text", F.lit(None).cast("string"))).collect()
    assert {(r["target"], r["taken"]) for r in nothing} == {(0.0, 0)}


@pytest.mark.parametrize("seed", range(3))
def test_mixing_sources(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, " ".join(["w"] * rng.randint(0, 9)), rng.choice(["a", "a", "a", "b", "é", "z", "Z", None, "🙂"]))
        for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).orderBy("doc_id").collect()
    check_mix(got)
    assert got == mixing.mix(docs.repartition(5)).orderBy("doc_id").collect()


def test_mixing_is_native(spark):
    plan = mixing.mixed_rows(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_schedule_inverts_its_integral(spark):
    """The share of demand met at a position is the share that was asked for."""
    shares = [i / 50 for i in range(50)]
    for rank in (1, 2, 3):
        phases = mixing.SCHEDULE[(rank - 1) % 3]
        df = spark.createDataFrame([(s, rank) for s in shares], "s double, r int")
        for row in df.select("s", mixing.inverse_demand(F.col("s"), F.col("r"), mixing.SCHEDULE).alias("t")).collect():
            whole, part = divmod(row["t"] * len(phases), 1)
            met = sum(phases[: int(whole)]) + (phases[int(whole)] * part if whole < len(phases) else 0)
            assert met / sum(phases) == pytest.approx(row["s"], abs=1e-9)


def test_mixed_rows_in_training_order(spark):
    docs = odd_docs(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({k: v for k, v in copies.items() if v})
    first = {r["doc_id"]: r["position"] for r in mixing.mix(docs).collect()}
    seen = list(dict.fromkeys(r["doc_id"] for r in rows))
    assert seen == sorted(seen, key=lambda i: (first[i], i))


# Jaccard join


def shingle_set(text, words):
    found = words_of(text)
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def brute_groups(rows, words, percent):
    """By position in `rows`: the size of the set and the smallest id that links reach."""
    sets = [shingle_set(t, words) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    of = smallest_reachable(range(len(rows)), links)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[of[i]] += [doc_id] if doc_id is not None else []
    return [(rows[i][0], len(sets[i]), min(ids[of[i]], default=None)) for i in range(len(rows))]


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 50), (3, 100)])
def test_jaccard_near_copies(spark, words, percent):
    """Groups of variants with few to many changed words, around the threshold and beyond it."""
    rng, rows = random.Random(words * percent), []
    for group in range(8):
        base = prose(group, rng.choice([6, 30, 120])).split()
        for _ in range(18):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((rng.randrange(10**6), " ".join(text)))
    rows += [(i, prose(500 + i, rng.randint(1, 40))) for i in range(40)]
    rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.similar_groups(docs, words=words, percent=percent).collect()
    assert Counter(map(tuple, got)) == Counter(brute_groups(rows, words, percent))


def test_jaccard_odd(spark):
    rows = [(i, t) for i, t, _, _ in ROWS]
    got = jaccard.similar_groups(odd_docs(spark)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_groups(rows, 5, 80))
    assert jaccard.similar_groups(no_docs(spark)).count() == 0
    kept = jaccard.one_of_each_group(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 4, 6, 7, 8, 9, 10, 11, 13, 14, 16])


def test_jaccard_links_through_rows_without_an_id(spark):
    """A chain 1 - x - 2 is one group wherever the id is missing, also with copies of the row without one."""
    left, middle, right = (" ".join(f"w{i}" for i in range(a, a + 100)) for a in (0, 6, 12))
    schema = "doc_id bigint, text string"
    for repeats in (1, 40):
        rows = [(1, left), (2, right)] + [(None, middle)] * repeats + [(None, "some other text without id at all")]
        got = jaccard.similar_groups(spark.createDataFrame(rows, schema)).collect()
        want = brute_groups(rows, 5, 80)
        assert [w[2] for w in want[:3]] == [1, 1, 1]
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(want)


def test_jaccard_group_of_near_copies_is_not_all_pairs(spark):
    """Two thousand variants of a text, one word changed in each: a link each, not one for each pair."""
    base = prose(77, 300).split()
    rows = [(i, " ".join([*base[: i % 300], f"x{i}", *base[i % 300 + 1 :]])) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = jaccard.shingled(docs, 5, 80)
    nodes = known.select(
        F.col("doc_id").alias("node"), F.col("doc_id").alias("first"), "one", "two", F.col("n_shingles").alias("n"), "front"
    )
    may = jaccard.suspects(nodes, 80)
    ordered = jaccard.ordered_sets(jaccard.full_sets(docs, may, 5), may, 80)
    links = jaccard.node_links(ordered, 80)
    assert links.count() < 100_000
    assert {r["component"] for r in components(links).select("component").distinct().collect()} == {0}


# Embeddings


def brute_embeddings(rows, similarity=0.93):
    unit = {}
    for i, (vec_id, vector, label) in enumerate(rows):
        good = vec_id is not None and label is not None and vector and all(x is not None and np.isfinite(x) for x in vector)
        if good and any(vector):
            v = np.array(vector, float)
            unit[i] = v / np.linalg.norm(v)
    links = [
        (i, j)
        for i in unit
        for j in unit
        if j < i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity
    ]
    of, n = smallest_reachable(range(len(rows)), links), Counter(x for link in links for x in link)
    least = {}
    for i in of:
        if rows[i][0] is not None:
            least[of[i]] = min(least.get(of[i], rows[i][0]), rows[i][0])
    for i, (vec_id, _, _) in enumerate(rows):
        component = least.get(of[i])
        yield vec_id, n[i], component, vec_id is not None and vec_id == component


VECTORS = "vec_id bigint, embedding array<float>, label int, node string, copies string"


def check_embeddings(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "own", "own") for r in rows], VECTORS)
    got = embeddings.near_duplicates(docs, **options).collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in docs.collect()]  # rounded to floats
    assert Counter(map(tuple, got)) == Counter(brute_embeddings(rows, **options))


@pytest.mark.parametrize("similarity", [0.93, 0.5])
def test_embeddings(spark, similarity, monkeypatch):
    for name, value in (("BLOCK", 16), ("LEAF", 5)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(3)
    centres, rows = rng.normal(size=(9, 6)), []
    for i in range(260):
        vector = centres[rng.integers(9)] + rng.normal(size=6) * rng.choice([0, 0.02, 0.2, 0.6])
        rows.append((1000 - i, vector.tolist(), int(rng.integers(3)) if i % 9 else 0))
    check_embeddings(spark, rows, similarity=similarity)


def test_embeddings_odd(spark):
    nan, inf = float("nan"), float("inf")
    check_embeddings(
        spark,
        [
            (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [5.0, 0.0, 0.0], 1), (13, [1.0, 0.0], 2), (13, [1.0, 0.0], 2),
            (15, [3.0], 4), (16, [4.0], 4), (17, [-4.0], 4), (18, [1e-30, 0.0], 1), (19, [1e30, 1e28], 1),
            (None, [1.0, 0.0], 1),
        ],
    )
    check_embeddings(spark, [(1, None, None)])
    docs = spark.createDataFrame([], VECTORS)
    assert embeddings.near_duplicates(docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 7), st.integers(1, 7), st.data())
def test_stars_connect_like_all_hits(n, m, data):
    hits = np.array(data.draw(st.lists(st.lists(st.booleans(), min_size=m, max_size=m), min_size=n, max_size=n)))
    few = list(embeddings._stars(hits))
    assert all(hits[i, j] for i, j in few) and len(few) <= n + m
    nodes = range(n + m)
    every = [(i, n + j) for i, j in zip(*np.nonzero(hits), strict=True)]
    assert smallest_reachable(nodes, [(i, n + j) for i, j in few]) == smallest_reachable(nodes, every)
