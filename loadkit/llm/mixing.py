"""Mix sources to target weights along a curriculum, with DataFrame functions only.

Every source gets a target number of words by its weight. Its documents, in a fixed shuffled order,
are repeated until the target is met, and a running total of words gives each copy a place in the
source's demand. The weight of a source changes over training; inverting the integral of its
schedule turns that place into a training position, and documents are range-sorted by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.functions.sequence import running_total
from loadkit.llm.common import WORD, free_name, row_key
from loadkit.session import materialise

#: No document is taken more often than this.
MOST_COPIES = 3
#: The weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: How a source's weight changes over equal phases of training, by its weight class: the first class
#: fades out, the second is level, the third fades in.
SCHEDULE = ((4.0, 2.0, 1.0, 1.0), (2.0, 2.0, 2.0, 2.0), (1.0, 1.0, 2.0, 4.0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Per source of `sizes` (source, size): rank, weight, source_size, before (words of the sources
    ranked before it) and target (words).

    Targets share all words by weight and stop at `most` times the source's size; what is over goes
    to the others by weight. Sources are filled in the order of what each weight can take: those
    that come before the first one that its share does not fill are full, the others share the rest.
    The windows here run over a row per source.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    earlier = ranked.rowsBetween(Window.unboundedPreceding, -1)
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source",
        "source_size",
        F.row_number().over(ranked).alias("rank"),
        F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).alias("before"),
    )
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    sources = sources.select(
        "*",
        F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    filled = fill.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.select(
        "*",
        F.row_number().over(fill).alias("turn"),
        (
            F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(filled), F.lit(0))
        ).cast("double").alias("words_left"),
        (
            F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
        ).alias("weight_left"),
    )
    share = F.col("words_left") * F.col("weight") / F.col("weight_left")
    sources = sources.withColumn("open", F.when(share < F.col("cap"), F.col("turn")))
    sources = sources.withColumn("first_open", F.min("open").over(whole))
    at_first = F.col("turn") == F.col("first_open")
    words = F.max(F.when(at_first, F.col("words_left"))).over(whole)
    weight = F.max(F.when(at_first, F.col("weight_left"))).over(whole)
    full = F.col("first_open").isNull() | (F.col("turn") < F.col("first_open"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(
        words * F.col("weight") / weight
    )
    return sources.select("source", "rank", "weight", "source_size", "before", target.alias("target"))


def inverse_demand(share: Column, rank: Column, schedule: Sequence[Sequence[float]]) -> Column:
    """The time in [0, 1] at which a source's schedule has demanded `share` of its words."""
    by_class = F.lit(None).cast("double")
    for turn, phases in reversed(list(enumerate(schedule))):
        total, done, out = sum(phases), 0.0, F.lit(1.0)
        pieces = []
        for i, height in enumerate(phases):
            pieces.append((done, height / total, i))
            done += height / total
        for start, width, i in reversed(pieces):
            inside = (F.lit(float(i)) + (share - start) / width) / float(len(phases))
            out = F.when(share < start + width, inside).otherwise(out)
        by_class = F.when((rank - 1) % len(schedule) == turn, out).otherwise(by_class)
    return by_class


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    schedule: Sequence[Sequence[float]] = SCHEDULE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, copies, taken (words), offset
    (words of its source before it), and position (of its first copy; null if it is not taken).

    Null and empty texts have size 0, are never taken and have no copies. Documents without a source
    form a source of their own, the last. The order within a source is that of a hash of the id, so
    reruns agree; rows repeated under one id each count. With no words at all, targets are 0. The
    columns of `carry` come along and order rows of one id and size.
    """
    sizes = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
            *carry,
        ),
        "sizes",
    )
    targets = materialise(source_targets(sizes, weights, most), "targets")
    known = sizes.withColumnRenamed("source", "_source").join(
        targets, F.col("_source").eqNullSafe(F.col("source"))
    ).drop("_source")
    keyed = known.withColumn("key", F.md5(F.col("doc_id").cast("string").cast("binary")))
    placed = running_total(keyed, ["rank", "key", "doc_id", "size", *carry], F.col("size"), "at")
    offset = F.col("at") - F.col("before")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    passes = F.coalesce(passes, F.lit(0)).cast("bigint")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    # Ever larger along the order, so the last, partial pass takes a prefix of the source's documents.
    middle = 2 * F.col("offset") + F.col("size")
    extra = (middle.cast("double") <= 2.0 * rest).cast("bigint")
    copies = F.when(F.col("size") > 0, F.col("passes") + extra).otherwise(F.lit(0))
    placed = placed.withColumn("offset", offset).withColumn("passes", passes)
    return (
        placed.withColumn("copies", copies.cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn(
            "position",
            F.when(F.col("copies") > 0, _position(F.lit(0), schedule)),
        )
        .select(
            "doc_id", "source", "rank", "size", "source_size", "target", "copies", "taken", "offset",
            "position", *carry,
        )
    )


def _position(copy: Column, schedule: Sequence[Sequence[float]]) -> Column:
    """The training position of a copy, by the middle of its words in the demand of its source."""
    middle = (copy * F.col("source_size") + F.col("offset")) * 2 + F.col("size")
    share = middle.cast("double") / (2.0 * F.col("target"))
    return inverse_demand(share, F.col("rank"), schedule)


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    schedule: Sequence[Sequence[float]] = SCHEDULE,
    **options,
) -> DataFrame:
    """The rows of `docs` in training order: each as often as it is taken, range-sorted by position.

    Rows are told apart by id, text and source, so rows without an id and rows repeated under one each
    come as often as they are taken. Columns are those of `docs`; its names cannot clash with the
    operator's own.
    """
    name = free_name(docs, "_mix")
    key, turn = f"{name}_key", f"{name}_turn"
    source = F.col(source_col).cast("string").alias("source")
    keyed = docs.withColumn(key, F.struct(row_key(id_col, text_col).alias("row"), source))
    plan = mix(keyed, id_col, text_col, source_col, schedule=schedule, carry=[key], **options)
    # Rows of one key are the same but for other columns: the first of them takes the first place.
    same = Window.partitionBy(key).orderBy("offset")
    plan = plan.filter("copies > 0").withColumn("turn", F.row_number().over(same))
    plan = plan.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    ).select(
        F.struct(
            F.col(key).alias("key"),
            "turn",
            _position(F.col("copy"), schedule).alias("position"),
            "copy",
        ).alias(name)
    )
    plan = materialise(plan, "mix")
    twice = plan.filter(F.col(f"{name}.turn") > 1).select(F.col(f"{name}.key").alias(name)).distinct()
    twice = materialise(twice, "twice")
    repeated = F.col(key) == F.col(name)
    numbered = keyed.join(twice, repeated, "left_anti").withColumn(turn, F.lit(1)).unionByName(
        keyed.join(twice, repeated, "left_semi").withColumn(
            turn, F.row_number().over(Window.partitionBy(key).orderBy(key))
        )
    )
    match = (F.col(key) == F.col(f"{name}.key")) & (F.col(turn) == F.col(f"{name}.turn"))
    order = [F.col(f"{name}.position"), F.col(f"{name}.key"), F.col(f"{name}.copy")]
    joined = numbered.join(plan, match)
    return joined.repartitionByRange(*order).sortWithinPartitions(*order).drop(name, key, turn)
