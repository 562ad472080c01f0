"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: U+0020 and U+0009 to U+000D. `bytes.split()` uses the same.
WHITE = " \t\n\x0b\f\r"
#: A word, for Java's and RE2's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Bounds of an Arrow batch, so that a Python worker holds a few long texts at a time.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20

#: Keys of a `Recent` cache up to this many characters are kept, so its entries bound its bytes.
KEPT_CHARS = 64


class Recent(dict):
    """Answers for short keys; what is missing is computed, what was not used lately is dropped.

    The cache holds two generations of at most `entries` each: the younger one is this dictionary, and
    what is found in the older one moves here. Longer keys are computed every time.
    """

    def __init__(self, compute: Callable, entries: int) -> None:
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.compute(key)
            if len(key) > KEPT_CHARS:
                return found
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found

    def keep(self, key, found) -> None:
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = found

    def absent(self, keys):
        """The distinct keys that neither generation has."""
        return {k for k in keys if k not in self and k not in self.older}


def chunks(items, size: int):
    """Lists of at most `size` items."""
    items = iter(items)
    while part := list(islice(items, size)):
        yield part


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python stages by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that no other column can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def fold(key: Column, folds: int) -> Column:
    """The remainder that assigns a row to a fold; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def held_out(key: Column, folds: int, remainder: int) -> Column:
    """Whether a row is kept from training; a row without a key is not held out."""
    return F.coalesce(fold(key, folds) == remainder, F.lit(False))


def may_learn(key: Column, folds: int, remainder: int) -> Column:
    """Whether a model may learn from a row; a row without a key is not learned from."""
    return F.coalesce(fold(key, folds) != remainder, F.lit(False))


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one that `docs` does not have in any letter case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells a row from others: its id, null or not, and the digest of its text.

    Never null, so that joins match rows without an id as well; in order, the rows without one are
    last. Rows of one key are the same row repeated.
    """
    return F.struct(
        F.col(id_col).isNull().alias("absent"),
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"),
    )


def rows_of(
    docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "_id"
) -> DataFrame:
    """The rows of `docs` whose `row_key` is in the one column of `keys`, with their keys as `name`.

    The keys to find go under a name that `docs` does not have, so no column of `docs` can clash.
    """
    keyed = docs.withColumn(name, row_key(id_col, text_col))
    key = free_name(keyed, "_found")
    return keyed.join(keys.toDF(key), F.col(name) == F.col(key), "left_semi")


def one_row_per_key(docs: DataFrame, name: str) -> DataFrame:
    """Leave one of several rows that have the same key; other rows are not shuffled by content."""
    key, number = free_name(docs, "_twice"), free_name(docs, "_number")
    counted = docs.groupBy(name).agg(F.count("*").alias(number))
    twice = counted.filter(F.col(number) > 1).select(name).toDF(key)
    match = F.col(name) == F.col(key)
    return docs.join(twice, match, "left_anti").unionByName(
        docs.join(twice, match, "left_semi").dropDuplicates([name])
    )


def kept_rows(
    docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text", without_id: bool = False
) -> DataFrame:
    """One row of `docs` for every key in `keys`, with the columns of `docs` alone."""
    name = free_name(docs, "_id")
    found = one_row_per_key(rows_of(docs, keys, id_col, text_col, name), name).drop(name)
    return found if without_id else found.filter(F.col(id_col).isNotNull())
