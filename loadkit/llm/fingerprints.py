"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame functions only.

A sketch holds the `k` smallest hashes of the distinct shingles of a text, in order. Hashes of a set
spread evenly, so the smallest ones of two sets say how much they share. Sketches merge: the smallest
hashes of several sketches are the sketch of all of it, whether the parts are texts, files or tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.functions.sequence import number_rows
from loadkit.llm.common import WHITE, row_key
from loadkit.session import materialise

#: Hashes of a sketch, and words of a shingle.
SIZE, SHINGLE = 128, 5
#: Hashes are 64 bits, signed; the smallest sketch value stands for share 0 of all.
_LOWEST, _ALL = -(2.0**63), 2.0**64

_WORD_END = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """The hashes of all shingles of a text, repeats included; null counts as empty.

    Words are parted by white space. A text of fewer words is one shingle, one without words has none.
    """
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    hashes = F.transform(F.split(trimmed, _WORD_END), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        full = F.transform(
            F.sequence(F.lit(1), F.size(h) - (words - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(words)]),
        )
        short = F.array(F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x)))
        return F.when(F.size(h) >= words, full).otherwise(short)

    # One element, so that the hashes of words are computed once and named.
    made = F.get(F.transform(F.array(hashes), shingles), F.lit(0))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(made)


def smallest(hashes: Column, size: int = SIZE) -> Column:
    """The sketch of an array of hashes: the smallest distinct ones in order."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def sketch(text: Column, size: int = SIZE, words: int = SHINGLE) -> Column:
    """The sketch of a whole text."""
    return smallest(shingle_hashes(text, words), size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of all that two sketches stand for."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """The share of shingles in both of two sets among those in either, estimated from 0 to 1.

    Exact while both sets together have at most `size` shingles. Two sets without shingles are alike.
    """
    both = F.size(F.array_intersect(a, b))
    union = F.array_union(a, b)

    def share(u: Column) -> Column:
        lowest = F.slice(F.array_sort(u), 1, size)
        shared = F.size(F.array_intersect(F.array_intersect(lowest, a), b))
        return shared / F.size(lowest)

    sampled = F.get(F.transform(F.array(union), share), F.lit(0))
    exact = both / F.size(union)
    return (
        F.when(F.size(union) == 0, F.lit(1.0))
        .when(both == 0, F.lit(0.0))
        .when(F.size(union) <= size, exact)
        .otherwise(sampled)
    )


def distinct_count(a: Column, size: int = SIZE) -> Column:
    """The number of distinct shingles; exact below `size`."""
    share = (F.element_at(a, -1).cast("double") - F.lit(_LOWEST)) / F.lit(_ALL)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """The share of the shingles of `a` that `b` has too, estimated from 0 to 1."""
    shared = resemblance(a, b, size) * distinct_count(merged(a, b, size), size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), shared / distinct_count(a, size))
    )


def merged_sketches(rows: DataFrame, by: str, sketch_col: str, size: int = SIZE) -> DataFrame:
    """One sketch per value of `by`, merged from those of its rows: by, sketch.

    Hashes above the `size` smallest of a value leave before the shuffle too, so a value that a third
    of all rows share costs each task `size` hashes. Rows without a sketch or with an empty one add
    nothing; a value that has no other rows has an empty sketch.
    """
    given = rows.select(F.col(by).alias("by"), F.col(sketch_col).alias("sketch"))
    least = Window.partitionBy("by").orderBy(F.col("hash").asc_nulls_last())
    # Equal hashes have one rank, so distinct ones are counted without a shuffle of their own.
    ranked = given.select("by", F.explode_outer("sketch").alias("hash")).withColumn(
        "rank", F.dense_rank().over(least)
    )
    return (
        ranked.filter(F.col("rank") <= size)
        .groupBy("by")
        .agg(F.array_sort(F.collect_set("hash")).alias("sketch"))
        .select(F.col("by").alias(by), "sketch")
    )


def as_text(a: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal digits."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.hex(x))), " ")


def from_text(text: Column) -> Column:
    """The sketch that `as_text` wrote."""
    signed = lambda x: F.conv(x, 16, -10).cast("bigint")
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(text, " "), signed)
    )


def with_neighbour(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, text, n_chars of every row, and of the next document its `start` (as many code points as a
    third of the text has, or all) and `sketch`.

    Next is the document that follows in descending order of ids, ties in the order of the SHA-256 of
    the text, rows without an id last; the first follows the last. Rows repeated under one id and text
    are one document. Ids and lengths are ordered by ranges first. Whole texts are shuffled once, by
    their keys; from there the start goes to the one document that needs it.
    """
    keyed = docs.select(
        row_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    order = [F.col("key.absent"), F.col("key.id").desc(), F.col("key.digest")]
    lengths = keyed.groupBy("key").agg(F.max(F.char_length("text")).alias("n_chars"))
    places = materialise(number_rows(lengths, order, "no"), "places")
    n = places.count()
    wanted = places.select(
        F.col("key").alias("to"), F.expr("n_chars div 3").alias("take"),
        ((F.col("no") + 1) % F.lit(max(n, 1))).alias("no"),
    ).join(places.select(F.col("key").alias("from"), "no"), "no")
    wanted = materialise(wanted.select("from", "to", "take"), "wanted")
    given = (
        keyed.join(wanted, F.col("key") == F.col("from"))
        .groupBy("from", "to", "take")
        .agg(F.max("text").alias("text"))
        .select("to", F.expr("left(text, cast(take AS int))").alias("start"), sketch(F.col("text")).alias("next"))
    )
    return keyed.join(given, F.col("key") == F.col("to")).select(
        "key", "text", F.char_length("text").cast("bigint").alias("n_chars"), "start", F.col("next").alias("sketch")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketches of every text and of its edited text, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_shingles and kept_in_edited (the share of the text's shingles that the edited text has). In the
    edited text the last third gives way to the start of the next document, see `with_neighbour`. Null
    texts are empty and have no shingles. A document alone is next to itself; an empty table gives no
    rows. Very long texts are sketched whole; only their hashes are sorted.
    """
    rows = with_neighbour(docs, id_col, text_col)
    edited = F.concat(F.expr("left(text, cast(n_chars - n_chars div 3 AS int))"), F.col("start"))
    rows = rows.select("key", "text", "n_chars", "sketch", edited.alias("edited"))
    sketched = rows.select(
        F.col("key.id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"), "sketch",
    )
    own, changed = F.col("own"), F.col("changed")
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        resemblance(own, changed).alias("near_edited"),
        resemblance(own, F.col("sketch")).alias("near_next"),
        distinct_count(own).alias("n_shingles"),
        containment(own, changed).alias("kept_in_edited"),
    )
