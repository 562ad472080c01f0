"""Conversation repair, source divergence and document fingerprints."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadkit.llm import conversations, divergence, fingerprints
from loadkit.llm.queries import QUERIES
from tests.llm.odd import ROWS, no_docs, odd_docs
from tests.oracle import TABLES

SF_DIR = f"{TABLES}/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\f\r"


# Conversations


def damaged(conv, turn, role, text):
    space = lambda x: " " if x is None else x
    role, text = space(role), space(text)
    draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
    if draw == 1:
        text = ""
    if draw == 2:
        text = re.sub("[.!?]", "", text)
    if draw == 4:
        role = "user"
    return [(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)


def brute_repair(rows):
    """Every cheapest edit by trying all, from the end; ties by the text of the edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, kinds = set(), []
    for turn, role, text in rows:
        if not text.strip(WHITE):
            kinds.append("blank")
        elif (role, text) in seen:
            kinds.append("duplicate")
        else:
            kinds.append("whole" if text.rstrip(WHITE)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # best[i][state]: cost and edits from row i on; states are the letters that went before.
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    nothing = (float("inf"), "")
    best = [{} for _ in range(len(rows) + 1)]
    for i in range(len(rows), -1, -1):
        here = {s: (0, "") if i == len(rows) and s in ("", "a") else nothing for s in after}
        if i < len(rows):
            role, extra = rows[i][1][:1], 5 if kinds[i] == "truncated" else 0
            for s in after:
                ways = [(2 + best[i + 1][s][0], "D" + best[i + 1][s][1])]
                if kinds[i] in ("whole", "truncated"):
                    nxt = best[i + 1][after[s]]
                    ways.append((1 + extra + nxt[0], "R" + nxt[1]))
                    if role == after[s] or role == "s" and s == "":
                        nxt = best[i + 1][role]
                        ways.append((extra + nxt[0], "K" + nxt[1]))
                here[s] = min(ways)
        for _ in range(3):
            for s in after:
                here[s] = min(here[s], (5 + here[after[s]][0], "I" + here[after[s]][1]))
        best[i] = here
    cost, edits = best[0][""]
    out, i, state = [], 0, ""
    for edit in edits:
        role, text = (None, "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = {"u": "user", "a": "assistant"}[after[state]]
        state = role[:1]
        out.append(f"{role}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    count = Counter(kinds)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": count["blank"], "duplicate": count["duplicate"], "truncated": count["truncated"],
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": edits,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def brute_audits(rows, damage=True):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv] += damaged(conv, turn, role, text) if damage else [(turn, role, text)]
    return {conv: brute_repair(found) for conv, found in groups.items()}


def as_dict(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def turns_of(rng, conv, n, texts=30):
    ends = [".", "!", "?", "", " ", ", and"]
    role = lambda i: rng.choice(["system", "user", "assistant", "tool", ""]) if rng.random() < 0.3 else ("user", "assistant")[i % 2]
    return [
        (conv, i + rng.randrange(2), role(i), rng.choice([f"text {rng.randrange(texts)}", "", " \t"]) + rng.choice(ends))
        for i in range(n)
    ]


def test_conversations_brute_force(spark):
    rng = random.Random(3)
    rows = [r for conv in range(60) for r in turns_of(rng, conv, rng.randrange(1, 14))]
    rows += [(None, None, None, None), (None, 3, "user", "One."), (500, None, None, "x."), (500, -2, "Assistant", "y?")]
    got = conversations.repair_turns(conversations.damage_turns(spark.createDataFrame(rows, TURNS).repartition(3)))
    assert as_dict(conversations.audits(got)) == brute_audits(rows)
    lines = got.count() and conversations.repaired_turns(got).filter("conv_id = 7").orderBy("slice", "at", "place").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
    assert hashlib.sha256(text.encode()).hexdigest() == brute_audits(rows)[7]["repaired_sha256"]


@pytest.mark.parametrize("block_rows, fan", [(1, 2), (3, 2), (7, 4), (64, 256)])
def test_conversations_in_blocks(spark, block_rows, fan):
    """Long conversations, one of them with most rows, cut into blocks that are combined in levels."""
    rng = random.Random(block_rows)
    rows = [r for conv, n in ((1, 150), (2, 40), (3, 9), (4, 1)) for r in turns_of(rng, conv, n, 400)]
    rows += [(1, 77, "user", "The same row.")] * 50
    given_rows = spark.createDataFrame(rows, TURNS).withColumn("copies", F.lit(1).cast("bigint"))
    got = conversations.audits(conversations.repair_turns(given_rows.repartition(4), block_rows, fan))
    assert as_dict(got) == brute_audits(rows, damage=False)


def test_conversations_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.audits(conversations.repair_turns(conversations.damage_turns(none))).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "A question?")], TURNS)
    (row,) = as_dict(QUERIES_AUDIT(one)).values()
    assert row == dict.fromkeys(conversations.COUNTS, 0) | {
        "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()
    }


def QUERIES_AUDIT(rows):
    return conversations.audits(conversations.repair_turns(conversations.damage_turns(rows)))


def test_conversations_odd_columns(spark):
    rows = [(1, 0, "user", "Where?"), (1, 1, "assistant", "There."), (2, 0, "user", "x" * 2_000_000 + ".")]
    docs = spark.createDataFrame(rows, TURNS)
    odd = docs.withColumns({c: F.lit("own") for c in ("copies", "rows", "at", "slice", "key", "first", "many", "digest", "last")})
    assert as_dict(QUERIES_AUDIT(odd)) == brute_audits(rows)


ITEM = st.one_of(st.integers(1, 3), st.tuples(st.sampled_from("sua?"), st.booleans()))


@settings(max_examples=60, deadline=None)
@given(st.lists(ITEM, max_size=7))
def test_auction_is_cheapest_and_first(items):
    """Of all paths, by listing them."""
    lattice = conversations.row_lattice(items, True)
    end = conversations.STATES * len(items)

    def paths(node, inserts):
        if node >= end and node - end in conversations.ENDS:
            yield 0, ""
        for label, cost, head in lattice.arcs[node]:
            if label != "I" or inserts:
                for more, rest in paths(head, inserts - 1 if label == "I" else 2):
                    yield cost + more, label + rest

    cost, taken = lattice.path(conversations.START, conversations.ENDS)
    assert (cost, "".join(arc[0] for arc in taken)) == min(paths(conversations.START, 2))


# Divergence


def brute_divergence(rows, least=3, most=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = {t for t, n in Counter(t for d in mine for t in set(d[2])).items() if n >= least}
        count = {None: Counter(t for d in mine for t in d[2] if t in kept)}
        for source in {d[1] for d in mine}:
            count[source] = Counter(t for d in mine if d[1] == source for t in d[2] if t in kept)
        p = {g: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for g, c in count.items()}
        price = lambda a, b: (a - b) ** 2 // b
        for source in count.keys() - {None}:
            pairs = [(other, sum(price(p[source][t], p[other][t]) for t in kept)) for other in count.keys() - {None, source}]
            terms = [(t, price(p[source][t], p[None][t])) for t in kept if count[source][t] and p[source][t] > p[None][t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(found[:top])]
    return sorted(out)


def test_divergence_odd(spark):
    got = divergence.divergence(odd_docs(spark))
    assert sorted(map(tuple, got.collect())) == brute_divergence(ROWS)
    assert divergence.divergence(no_docs(spark)).count() == 0


def test_divergence_brute_force(spark):
    """Frequent terms with levels of their own, more columns than a tile has, and the limit of terms."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    text = lambda: " ".join(rng.choices(words, [1 / (i + 1) for i in range(100)], k=rng.randrange(120)))
    rows = [(i, text() + " É Ωx", rng.choice(["en", "de", None]), rng.choice("abcdef")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string").repartition(3)
    got = divergence.divergence(docs, most_terms=20)
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, most=20)


def test_level_products_tiles(spark):
    rng = random.Random(5)
    lists = [[(s, rng.randrange(1, 9)) for s in "abcd" if rng.random() < 0.7] for _ in range(200)]
    rows = spark.createDataFrame(
        [("en", x, i % 3 + 1, i) for i, x in enumerate(lists)],
        "lang string, levels array<struct<source:string,count:bigint>>, weight bigint, total bigint",
    )
    want = Counter()
    for i, x in enumerate(lists):
        for a in x:
            for b in x:
                want[tuple(sorted([a, b]))] += (i % 3 + 1) / (1 if a == b else 2)
    got = divergence.level_products(rows, tile=5).collect()
    assert {tuple(sorted([(r[1], r[2]), (r[3], r[4])])): r["terms"] for r in got} == want


def test_smoothed_beyond_long(spark):
    row = spark.range(1).select(
        divergence.smoothed(F.lit(90_000_000_000), F.lit(10**12), F.lit(5 * 10**9)).alias("p")
    ).first()
    assert row["p"] == 1 + 10**9 * (90_000_000_001) // (10**12 + 5 * 10**9)


# Fingerprints


def hashes_of(text):
    """The shingle hashes of a text by another implementation."""
    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
        return seed

    words = [xxhash.xxh64_intdigest(w, 42) for w in (text or "").encode().split()]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    if 0 < len(words) < 5:
        a = 0
        for w in words:
            a = chain([a, w])
        return {signed(a)}
    return {signed(chain(words[i : i + 5])) for i in range(len(words) - 4)}


def written(hashes, size=128):
    return " ".join(f"{h & (1 << 64) - 1:x}" for h in sorted(hashes)[:size])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def check_fingerprints(rows, got):
    order = sorted(
        {(i, t or "") for i, t in rows},
        key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).digest()),
    )
    known = {}
    for n, (i, text) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        known[i, hashlib.sha256(edited.encode()).hexdigest()] = (text, edited, after)
    assert len(got) == len(rows)
    for r in got:
        text, edited, after = known[r["doc_id"], r["edited_sha256"]]
        own, changed, following = map(hashes_of, (text, edited, after))
        assert r["n_chars"] == len(text)
        assert r["fingerprint"] == written(own) and r["edited_fingerprint"] == written(changed)
        for value, other in ((r["near_edited"], changed), (r["near_next"], following)):
            exact = len(own | other) <= 128
            assert abs(value - jaccard(own, other)) < (1e-12 if exact else 0.2)
        assert abs(r["n_shingles"] / max(len(own), 1) - (len(own) > 0)) < 0.4


def test_fingerprints_odd(spark):
    got = fingerprints.fingerprints(odd_docs(spark)).collect()
    check_fingerprints([(i, t) for i, t, _, _ in ROWS], got)
    assert fingerprints.fingerprints(no_docs(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcdef")], "doc_id int, text string")
    (row,) = fingerprints.fingerprints(one).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_fingerprints_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_fingerprints"](spark, SF_DIR)
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = got.collect()
    check_fingerprints([tuple(r) for r in docs], rows)
    far = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert far > 0.9 * len(rows)


def test_sketches_merge(spark):
    """Sketches of parts merge into the sketch of the whole; estimates follow the sets."""
    rng = random.Random(9)
    words = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    texts = [words(400) for _ in range(6)]
    rows = [(i, "hot" if i < 4 else "cold" if i == 4 else None, t) for i, t in enumerate(texts)] + [(9, "none", "")]
    docs = spark.createDataFrame(rows, "id int, source string, text string").withColumn("s", fingerprints.sketch(F.col("text")))
    got = {r["source"]: r["sketch"] for r in fingerprints.merged_sketches(docs, "source", "s").collect()}
    hot = set().union(*map(hashes_of, texts[:4]))
    assert got["hot"] == sorted(hot)[:128] and got["none"] == []
    assert got[None] == sorted(hashes_of(texts[5]))[:128]
    a, b = spark.createDataFrame([(got["hot"], got["cold"])], "a array<bigint>, b array<bigint>").columns
    row = spark.createDataFrame([(got["hot"], sorted(hashes_of(texts[0]))[:128])], "a array<bigint>, b array<bigint>").select(
        fingerprints.distinct_count(F.col(a)).alias("n"),
        fingerprints.containment(F.col(b), F.col(a)).alias("inside"),
        fingerprints.resemblance(F.col(a), F.col(b)).alias("near"),
        fingerprints.from_text(fingerprints.as_text(F.col(a))).alias("again"),
    ).first()
    assert abs(row["n"] / len(hot) - 1) < 0.3 and row["inside"] > 0.7 and abs(row["near"] - 0.25) < 0.15
    assert row["again"] == got["hot"]
