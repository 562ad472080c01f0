"""How far the sources of a language diverge in their use of terms.

A group is a source of a language. What a term contributes to the divergence of two groups depends on
its counts there alone, so terms are not compared one by one: an indicator column for every pair of
group and count level, multiplied by its transpose, says how many terms have one level in one group
and another level in the other. These joint tables are priced level by level. The products are exact:
integers in float64 below 2^53, in blocks of terms and tiles of columns, summed up by Spark. Terms with
the same counts everywhere are one row with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import bounded_batches
from loadkit.session import materialise

#: A term stays if this many documents of its language have it.
LEAST_DOCS = 3
#: Probabilities are whole numbers of this part; counts are smoothed by one.
SCALE = 1_000_000_000
#: Terms that a group lists at most.
MOST_TERMS = 200

#: Bytes of text that a task counts at a time, or one text if it has more, and columns of a tile.
HELD, TILE = 32 << 20, 512

#: Terms are runs of ASCII letters and characters beyond ASCII; only A-Z change their case. In UTF-8
#: those characters are bytes from 0x80 on, so bytes can be mapped one by one.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def count_terms(texts: Sequence[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of some documents, their occurrences, and the documents that have each.

    Terms are cut and numbered by whole arrays; sorted pairs of number and document tell the rest.
    """
    data = b" ".join(texts).translate(_TERM_BYTES)
    space = np.frombuffer(b" " + data + b" ", np.uint8) == 32
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[0::2], edge[1::2]
    # Without the blanks the terms stand side by side, which is how an array holds them.
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.replace(b" ", b""))]
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    last = np.cumsum([len(t) + 1 for t in texts])
    pairs = terms.indices.to_numpy().astype(np.int64) << 32 | np.searchsorted(last, starts, "right")
    pairs.sort()
    new_pair = np.diff(pairs, prepend=-1) != 0
    number = pairs >> 32
    return terms.dictionary, np.bincount(number), np.bincount(number[new_pair])


def term_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """lang, source, term, count, docs: partial sums, a few for each term and task.

    Every task counts the terms of its documents by group, `HELD` bytes of text at a time, so most
    repetitions end there.
    """
    rows = _groups(docs, lang_col, source_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[bytes]] = {}
        size = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            langs, sources = (batch.column(n).to_pylist() for n in ("lang", "source"))
            for lang, source, text in zip(langs, sources, texts, strict=True):
                held.setdefault((lang, source), []).append(text)
                size += len(text)
            if size >= HELD:
                yield from map(_as_batch, held, held.values())
                held, size = {}, 0
        yield from map(_as_batch, held, held.values())

    bounded_batches(docs.sparkSession)
    return rows.mapInArrow(count, "lang string, source string, term string, count bigint, docs bigint")


def _groups(docs: DataFrame, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    named = {"lang": lang_col, "source": source_col}
    empty = F.lit("")
    return docs.select(
        *[F.coalesce(F.col(c).cast("string"), empty).alias(n) for n, c in named.items()], *more
    )


def _as_batch(group: tuple[str, str], texts: list[bytes]) -> pa.RecordBatch:
    terms, counts, in_docs = count_terms(texts)
    columns = [
        pa.array([group[0]]).take(pa.array(np.zeros(len(terms), np.int32))),
        pa.array([group[1]]).take(pa.array(np.zeros(len(terms), np.int32))),
        terms.cast(pa.binary()).cast(pa.string()),
        pa.array(counts),
        pa.array(in_docs),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, levels (source and count, in order of the source) of the terms that stay.

    A term has a level for each of its sources. The counts are shuffled once, by language and term,
    and summed up by source and then by term where they are.
    """
    summed = (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    )
    rows = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("count").alias("total"),
        F.sort_array(F.collect_list(F.struct("source", "count"))).alias("levels"),
    )
    return rows.filter(F.col("docs") >= least_docs).drop("docs")


def level_products(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """Joint tables: lang, source, level, other, other_level, terms, for levels above 0.

    `rows` has lang, levels and weight. The product of indicators with their transpose is symmetric:
    only one half is kept, and its diagonal says how many terms have a level. Blocks hold rows of
    similar totals, so a block has few columns for its rows.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            weights = batch.column("weight").to_numpy().astype(np.float64)
            lists = batch.column("levels")
            edge = lists.offsets.to_numpy()
            flat = lists.values.slice(edge[0], edge[-1] - edge[0])
            sources, counts = flat.field("source").dictionary_encode(), flat.field("count").to_numpy()
            names, source_of = sources.dictionary.to_pylist(), sources.indices.to_numpy()
            row_of = np.repeat(np.arange(len(langs)), np.diff(edge))
            for lang in dict.fromkeys(langs):
                mine = (langs == lang)[row_of]
                yield from _product(
                    lang, names, row_of[mine], source_of[mine], counts[mine], weights, tile
                )

    bounded_batches(rows.sparkSession)
    in_order = rows.repartitionByRange("lang", "total").sortWithinPartitions("lang", "total")
    schema = "lang string, source string, level bigint, other string, other_level bigint, terms bigint"
    partial = in_order.select("lang", "levels", "weight").mapInArrow(multiply, schema)
    return partial.groupBy("lang", "source", "level", "other", "other_level").agg(
        F.sum("terms").alias("terms")
    )


def _product(
    lang: str,
    names: Sequence[str],
    row_of: np.ndarray,
    source_of: np.ndarray,
    counts: np.ndarray,
    weights: np.ndarray,
    tile: int,
) -> Iterator[pa.RecordBatch]:
    """Multiply the indicators of a block by their transpose, a pair of tiles at a time.

    Rows go to tiles in parts of `tile`, so a dense part of the indicators has tile x tile numbers.
    """
    rows, row_at = np.unique(row_of, return_inverse=True)
    for start in range(0, len(rows), 4 * tile):
        part = (row_at >= start) & (row_at < start + 4 * tile)
        columns, column_at = np.unique(
            np.stack([source_of[part], counts[part]]), axis=1, return_inverse=True
        )
        column_at, at, n = column_at.ravel(), row_at[part] - start, columns.shape[1]
        height = min(4 * tile, len(rows) - start)
        weight = weights[rows[start : start + height]][:, None]

        def indicator(first: int) -> np.ndarray:
            inside = (column_at >= first) & (column_at < first + tile)
            dense = np.zeros((height, min(tile, n - first)))
            dense[at[inside], column_at[inside] - first] = 1.0
            return dense

        for i in range(0, n, tile):
            left = indicator(i) * weight
            for j in range(i, n, tile):
                product = left.T @ (indicator(j))
                if i == j:
                    product = np.triu(product)
                a, b = np.nonzero(product)
                one, two = columns[:, a + i], columns[:, b + j]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(a), pa.string()),
                        pa.array([names[k] for k in one[0]], pa.string()),
                        pa.array(one[1], pa.int64()),
                        pa.array([names[k] for k in two[0]], pa.string()),
                        pa.array(two[1], pa.int64()),
                        pa.array(product[a, b].astype(np.int64)),
                    ],
                    ["lang", "source", "level", "other", "other_level", "terms"],
                )


#: Counts whose product with `SCALE` is below 2^63, so that long integers do.
_NARROW = 9_000_000_000


def smoothed(count: Column, words: Column, terms: Column) -> Column:
    """The smoothed probability of a count in parts of `SCALE`; exact for any count."""
    narrow = F.call_function("div", (count + 1) * SCALE, words + terms)
    top = (count.cast("decimal(25,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    wide = F.call_function("div", top, (words + terms).cast("decimal(25,0)"))
    return F.when(count < _NARROW, narrow).otherwise(wide) + 1


def price(p: Column, q: Column) -> Column:
    """What a term adds to the divergence of p from q; below 2^63 as both are at most `SCALE` + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank of every group.

    Part `pair` has the divergence of the group from every other source of its language, part `term`
    the terms that it uses more than its language does and that add most. Values fall with the rank;
    equal ones are in the order of the bytes of the item. Null texts, languages and sources count as
    empty text. A language without a term that stays has only pairs, of value 0; a group without a term
    has pairs alone. Repeated rows count as often as they come; an empty table gives no rows. Texts of
    any length are counted whole.
    """
    counts = term_counts(docs, text_col, lang_col, source_col)
    kept = materialise(kept_terms(counts, least_docs), "terms")
    langs = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("total").alias("lang_words")
    )
    words = kept.select("lang", F.explode("levels").alias("l")).groupBy("lang", "l.source").agg(
        F.sum("l.count").alias("words")
    )
    # A row per group, which is far less than the pairs that are returned.
    groups = materialise(
        _groups(docs, lang_col, source_col)
        .distinct()
        .join(words, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["words", "terms", "lang_words"]),
        "groups",
    )
    return _pairs(groups, kept).unionByName(_terms(groups, kept, most_terms))


def _ranked(rows: DataFrame) -> Column:
    best_first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return F.row_number().over(best_first)


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """The divergence of every ordered pair of groups of a language.

    For levels a of the group and b of the other, the sum over all terms of f(a, b) is the sum over
    terms where both are above 0 of f(a, b) - f(a, 0) - f(0, b) + f(0, 0), plus what each side adds
    alone against level 0, plus f(0, 0) for all terms. Probabilities are computed once for each level
    that a group has; a row of a joint table gives both directions.
    """
    rows = kept.groupBy("lang", "levels").agg(
        F.count("*").alias("weight"), F.first("total").alias("total")
    )
    half = materialise(level_products(rows), "products")
    same = F.col("source") == F.col("other")
    zero = F.lit(0).cast("bigint")
    # Without terms there is nothing to price.
    named = groups.filter("terms > 0").select(
        "lang", "source", "words", "terms", smoothed(zero, F.col("words"), F.col("terms")).alias("p0")
    )
    levels = (
        half.filter(same)
        .select("lang", "source", "level", F.col("terms").alias("n"))
        .join(named, ["lang", "source"])
        .withColumn("p", smoothed(F.col("level"), F.col("words"), F.col("terms")))
    )
    levels = materialise(levels.select("lang", "source", "level", "n", "p", "p0"), "levels")

    def wide(value: Column, times: str) -> Column:
        return F.sum(value.cast("decimal(20,0)") * F.col(times).cast("decimal(18,0)"))

    one = levels.drop("n")
    two = levels.select(
        "lang", F.col("source").alias("other"), F.col("level").alias("other_level"),
        F.col("p").alias("q"), F.col("p0").alias("q0"),
    )
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    joint = (
        half.filter(~same)
        .join(one, ["lang", "source", "level"])
        .join(two, ["lang", "other", "other_level"])
        .groupBy("lang", "source", "other")
        .agg(
            wide(price(p, q) - price(p, q0) - price(p0, q) + price(p0, q0), "terms").alias("there"),
            wide(price(q, p) - price(q, p0) - price(q0, p) + price(q0, p0), "terms").alias("back"),
        )
    )
    joint = materialise(joint, "joint")
    pairs = named.select("lang", "source", "p0", F.col("terms").alias("n")).join(
        named.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0")), "lang"
    ).filter(~same)
    alone = levels.drop("p0", "level")
    left = pairs.drop("n").join(alone, ["lang", "source"]).groupBy("lang", "source", "other").agg(
        wide(price(p, q0) - price(p0, q0), "n").alias("sum")
    )
    alone = alone.withColumnsRenamed({"source": "other", "p": "q"})
    right = pairs.drop("n").join(alone, ["lang", "other"]).groupBy("lang", "source", "other").agg(
        wide(price(p0, q) - price(p0, q0), "n").alias("sum")
    )
    none = pairs.groupBy("lang", "source", "other").agg(wide(price(p0, q0), "n").alias("sum"))
    parts = [
        joint.select("lang", "source", "other", F.col("there").alias("sum")),
        joint.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("back").alias("sum")),
        left, right, none,
    ]
    sums = reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "other").agg(F.sum("sum").alias("sum"))
    every = groups.select("lang", "source").join(
        groups.select("lang", F.col("source").alias("other")), "lang"
    ).filter(~same)
    valued = every.join(sums, ["lang", "source", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
        F.coalesce(F.col("sum").cast("bigint"), zero).alias("value"),
    )
    return valued.withColumn("rank", _ranked(valued))


def _terms(groups: DataFrame, kept: DataFrame, most: int) -> DataFrame:
    """The terms that a group uses more than its language, best first."""
    used = kept.select("lang", "term", "total", F.explode("levels").alias("l")).select(
        "lang", "term", "total", "l.source", "l.count"
    )
    known = used.join(groups, ["lang", "source"])
    p = smoothed(F.col("count"), F.col("words"), F.col("terms"))
    q = smoothed(F.col("total"), F.col("lang_words"), F.col("terms"))
    valued = known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter(
        "p > q"
    ).select("lang", "source", F.lit("term").alias("part"), "item", price(F.col("p"), F.col("q")).alias("value"))
    return valued.withColumn("rank", _ranked(valued)).filter(F.col("rank") <= most)
