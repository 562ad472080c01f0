"""A join of documents whose sets of word n-grams are similar, and the groups that links form.

N-grams have a global order, the rare before the frequent. Two similar sets share an n-gram near the
front of both, which gives candidates. The order is cut into fragments; the overlap of a candidate
pair is counted in each fragment on its own and summed per pair (vertical partitioning).

What keeps it small:
* Documents with the same set are one node from the start, however many they are.
* A first pass, in the order of hashes, takes a quarter of each set. Only nodes that share enough of
  that part with others are looked at again; by the prefix principle no link is lost.
* Among those, frequencies are exact, and n-grams of one node alone are dropped but keep their places.
* Of the nodes under one n-gram, each is first compared with a single leader. Pairs that the links
  found so far connect already are never compared, so a group of near copies does not cost a pair
  for every two members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import bounded_batches, free_name, kept_rows, row_key, texts
from loadkit.llm.components import components
from loadkit.llm.hashing import WordHasher, mixed, spaces_of
from loadkit.session import materialise, materialised

#: For near duplicates in general; a query may ask for others.
WORDS, PERCENT = 5, 80
#: The first pass takes this part of a set more than the prefix principle asks for, and then asks
#: for as many more shared n-grams.
MORE = 10
#: Suspects up to this number are sent to the tasks that read the texts; more of them are joined.
FEW = 1_000_000
#: Each range of frequencies is cut into so many fragments by hash.
CUTS = 4

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def shingles(text: str | None, words: int, hasher: WordHasher) -> np.ndarray:
    """The distinct hashes of a text's n-grams of words (A-Z in lower case), sorted.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    raw = np.frombuffer(b" " + (text or "").encode().lower() + b" ", np.uint8)
    _, found = hasher(raw, spaces_of(raw))
    if not len(found):
        return np.empty(0, np.int64)
    n = min(words, len(found))
    found, total = mixed(found), np.uint64(n)
    for i in range(n):
        # A different odd factor for each place, and a mix after each, so that order matters.
        part = found[i : len(found) - n + 1 + i]
        total = mixed((total + part) * np.uint64(_ODD[i % len(_ODD)]) + np.uint64(i))
    return np.unique(total.view(np.int64))


def least_overlap(n, percent: int):
    """The least overlap of a set of size n with any similar set; for integers and columns."""
    return _floor(percent * n + 99, 100)


def _floor(a, b: int):
    if isinstance(a, Column):
        return F.floor(a / b).cast("bigint")
    return a // b


def shingled(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: doc_id, digest, n_shingles, two hashes of the whole set, and its front in hash order.

    `digest` names the text of a row without an id, and is null for other rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sets = [shingles(t, words, hasher) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            fronts = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1 + sizes // MORE, 0)
            fronts = np.minimum(fronts, sizes)
            offsets = np.concatenate([[0], np.cumsum(fronts)])
            flat = [s[:k] for s, k in zip(sets, fronts, strict=True)]
            flat = np.concatenate(flat) if flat else np.empty(0, np.int64)
            front = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            one = np.array([mixed(s.view(np.uint64)).sum() for s in sets], np.uint64)
            two = np.array([mixed(s.view(np.uint64) + np.uint64(1)).sum() for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    *map(pa.array, (sizes, one.view(np.int64), two.view(np.int64))),
                    front,
                ],
                names=["doc_id", "digest", "n_shingles", "one", "two", "front"],
            )

    bounded_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, digest binary, n_shingles bigint, one bigint, two bigint, front array<bigint>"
    digest = F.when(F.col("doc_id").isNull(), _digest())
    return docs.withColumn("digest", digest).mapInArrow(scan, schema)


def _digest() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and gram: the whole sets of the nodes (node, first, digest, one), from their first documents.

    Nodes whose documents all lack an id take the text with the node's digest. Where every node has a
    first document, `digest` may be absent.
    """
    if "digest" not in nodes.columns:
        nodes = nodes.withColumn("digest", F.lit(None).cast("binary"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sets = [shingles(t, words, hasher) for t in batch.column("text").to_pylist()]
            one = batch.column("one").to_numpy().view(np.uint64)
            # A row under the same id with another text is not the node's document.
            own = [mixed(s.view(np.uint64)).sum() == o for s, o in zip(sets, one, strict=True)]
            sets = [s if ok else s[:0] for s, ok in zip(sets, own, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            grams = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("node"), grams], names=["node", "grams"])

    def sets_of(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
        if chosen.count() <= FEW:  # three short values each, so the texts need no shuffle
            chosen = F.broadcast(chosen)
        rows = rows.join(chosen, key).select("node", "one", "text")
        return rows.mapInArrow(scan, "node bigint, grams array<bigint>")

    named = nodes.filter("first IS NOT NULL").select("node", F.col("first").alias("doc_id"), "one")
    nameless = nodes.filter("first IS NULL").select("node", "digest", "one")
    copies = docs.filter("doc_id IS NULL").select("text", _digest().alias("digest"))
    # Many rows may hold that text; each task sends on one set of a node.
    once = sets_of(copies, nameless, "digest").groupBy("node").agg(F.max("grams").alias("grams"))
    found = sets_of(docs, named, "doc_id").unionAll(once)
    return found.select("node", F.explode("grams").alias("gram"))


def suspects(nodes: DataFrame, percent: int) -> DataFrame:
    """The nodes that share enough of their front with other nodes to be linked with one."""
    front = nodes.select("node", F.explode("front").alias("gram"))
    shared = front.groupBy("gram").count().filter("count > 1").select("gram")
    seen = front.join(shared, "gram", "left_semi").groupBy("node").agg(F.count("*").alias("seen"))
    # A similar set has at least `percent` of the size, so its front is at least so much longer.
    least = 1 + _floor(percent * F.col("n"), 100 * MORE)
    return nodes.drop("front").join(seen, "node").filter(F.col("seen") >= least)


def ordered_sets(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Per node that may be linked: n, lone (n-grams of no other node), and the others in order.

    The order is by the power of two of the frequency, then by hash. Lone n-grams come before all.
    """
    frequency = sets.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    band = F.floor(F.log2(F.col("df"))).cast("int").alias("band")
    shared = sets.join(frequency, "gram").groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct(band, "gram"))).alias("shared")
    )
    lone = (F.col("n") - F.size("shared")).alias("lone")
    found = nodes.select("node", "n").join(shared, "node").select("node", "n", lone, "shared")
    return found.filter(F.size("shared") >= least_overlap(F.col("n"), percent))


def overlaps(pairs: DataFrame, ordered: DataFrame) -> DataFrame:
    """Per pair (a, b): the overlap, counted fragment by fragment and summed."""
    fragments = (
        ordered.select("node", F.explode("shared").alias("s"))
        .select(
            "node",
            (F.col("s.band") * CUTS + F.pmod(F.shiftright("s.gram", 62), F.lit(CUTS))).alias("fragment"),
            "s.gram",
        )
        .groupBy("node", "fragment")
        .agg(F.collect_list("gram").alias("grams"))
    )
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("of_a"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("c"))
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("overlap"))


def links_of(pairs: DataFrame, ordered: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar, as u and v."""
    union = F.col("na") + F.col("nb") - F.col("overlap")
    similar = overlaps(pairs, ordered).filter(100 * F.col("overlap") >= percent * union)
    return similar.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _may_link(percent: int) -> Column:
    """Whether two nodes whose first common n-gram has these places can be similar."""
    na, nb = F.col("na"), F.col("nb")
    rest = F.least(na - F.col("pa"), nb - F.col("pb"))
    lengths = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return lengths & ((100 + percent) * rest >= percent * (na + nb))


def node_links(ordered: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between nodes: every component of similar nodes is connected by them."""
    ahead = F.col("n") - least_overlap(F.col("n"), percent) + 1 - F.col("lone")
    front = materialise(
        ordered.select("node", "n", "lone", F.slice("shared", F.lit(1), F.greatest(ahead, F.lit(0)).cast("int")).alias("s"))
        .select("node", "n", "lone", F.posexplode("s").alias("at", "s"))
        .select("node", "n", (F.col("lone") + F.col("at")).alias("place"), "s.gram"),
        "fronts",
    )
    side = lambda x, *more: front.select(
        "gram", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("place").alias(f"p{x}"), *more
    )
    # First, every node of an n-gram with the one that has it foremost.
    leader = front.groupBy("gram").agg(
        F.count("*").alias("many"), F.min(F.struct("place", "node", "n")).alias("lead")
    )
    leader = leader.filter("many > 1").select(
        "gram",
        F.col("lead.node").alias("a"),
        F.col("lead.n").alias("na"),
        F.col("lead.place").alias("pa"),
    )
    ends = [F.least("a", "b"), F.greatest("a", "b")]
    sizes = [F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)) for x, y in (("na", "nb"), ("nb", "na"))]
    pair = [c.alias(x) for c, x in zip([*ends, *sizes], ("a", "b", "na", "nb"), strict=True)]
    first = side("b").join(leader, "gram").filter((F.col("a") != F.col("b")) & _may_link(percent))
    first = materialise(first.select(*pair).distinct(), "pairs")
    found = materialise(links_of(first, ordered, percent), "links")
    # Then the pairs under one n-gram that these links do not connect.
    group = components(found).select(F.col("vertex").alias("node"), "component")
    front = materialise(
        front.join(group, "node", "left").withColumn("component", F.coalesce("component", "node")),
        "grouped",
    )
    several = front.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    front = materialise(front.join(several.filter("x < y").select("gram"), "gram", "left_semi"), "open")
    left, right = side("a", F.col("component").alias("ca")), side("b", F.col("component").alias("cb"))
    rest = left.join(right, "gram").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _may_link(percent))
    rest = rest.select("a", "b", "na", "nb").distinct().join(first, ["a", "b"], "left_anti")
    return found.unionAll(materialise(links_of(materialise(rest, "pairs"), ordered, percent), "links"))


def similar_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id.

    Two documents are linked when 100 * intersection >= percent * union of their sets of n-grams of
    `words` words. component_id is the smallest id that links reach, the row's own included. Null and
    empty texts and texts of white space have no n-grams and are linked with nothing; a text with
    fewer words has its whole sequence as one. Rows with equal sets are always linked. Rows without
    an id carry links like others, and get no component unless they are linked with rows that have one.
    Repeated rows get the same answer. An empty table gives an empty result; texts of any length are read
    whole, one at a time.
    """
    rows = texts(docs, id_col, text_col)
    # Fronts and sets are deleted as soon as they are used.
    with materialised(shingled(rows, words, percent), "shingled") as scanned:
        known = materialise(scanned.drop("front", "digest"), "known")
        # Partial aggregation: a set with a third of all rows sends one row per task.
        groups = scanned.filter("n_shingles > 0").groupBy("one", "two", F.col("n_shingles").alias("n"))
        groups = groups.agg(
            F.min("doc_id").alias("first"), F.min("digest").alias("digest"), F.any_value("front").alias("front")
        )
        with materialised(groups.withColumn("node", F.monotonically_increasing_id()), "nodes") as full:
            nodes = materialise(full.drop("front", "digest"), "sets-of-nodes")
            may = materialise(suspects(full, percent), "suspects")
    with materialised(full_sets(rows, may, words), "sets") as sets:
        ordered = materialise(ordered_sets(sets, may, percent), "ordered")
    member = components(node_links(ordered, percent)).withColumnRenamed("vertex", "node")
    named = nodes.select("node", "one", "two", "n", "first").join(member, "node", "left")
    smallest = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least"))
    of_set = named.join(smallest, "component", "left").select(
        "one", "two", F.col("n").alias("n_shingles"), F.coalesce("least", "first").alias("component")
    )
    return known.join(of_set, ["one", "two", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    without_id: bool = False,
) -> DataFrame:
    """The rows of `docs` with the smallest id of their group, with all their columns.

    Rows are grouped by key, so rows with different texts under one id are rows of their own. Rows
    without an id stay only if `without_id` is set, and then for groups of such rows alone. Texts
    without n-grams are groups of their own and stay.
    """
    key = free_name(docs, "_key")
    keyed = docs.select(row_key(id_col, text_col).alias(key), F.col(text_col))
    groups = similar_groups(keyed, key, text_col, words, percent)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    return kept_rows(docs, materialise(kept, "kept"), id_col, text_col, without_id)
