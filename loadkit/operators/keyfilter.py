"""What a scan can rule out by itself: ranges and a Bloom filter of the keys that a join looks for.

Ranges are plain comparisons, so they reach the files. The Bloom filter is a row of bits in long integers,
which every task of the scan tests with built-in functions. Rows that pass may have a match; rows that do
not have none, and need no shuffle to find that out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.session import materialise

#: Bits a key, hash functions, and the most bits of a filter: 8 MB in a task.
BITS_A_KEY, HASHES, MOST_BITS = 10, 3, 1 << 26
#: From so many keys on a filter is built; fewer are broadcast by the planner, which needs no shuffle.
FILTER_FROM = 100_000

# Types whose equal values have equal hashes, and those whose order Python values keep.
_HASHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampType)
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


@dataclass(frozen=True)
class KeyFilter:
    """The keys of a staged frame in short: their number, ranges, and bits if there are any."""

    n: int
    ranges: dict[str, tuple]
    keys: Sequence[str]
    kinds: dict[str, T.DataType]
    size: int = 0
    words: DataFrame | None = None

    def narrow(self, rows: DataFrame) -> DataFrame:
        """The rows that may have one of the keys; comparisons with the ranges reach the files."""
        return reduce(DataFrame.filter, self._tests(), rows)

    def may_match(self) -> Column:
        """Whether a row may have one of the keys; false for a row with a null key."""
        return F.coalesce(reduce(lambda a, b: a & b, self._tests()), F.lit(False))

    def _tests(self) -> list[Column]:
        tests = [F.lit(self.n > 0)]
        for key, (least, greatest) in self.ranges.items():
            column, kind = F.col(f"`{key}`"), self.kinds[key]
            tests.append(column.between(F.lit(least).cast(kind), F.lit(greatest).cast(kind)))
        if self.words is not None:
            bits = self.words.scalar()
            for at in _positions([F.col(f"`{k}`") for k in self.keys], self.size):
                word = F.get(bits, F.shiftright(at, 6).cast("int"))
                tests.append(F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return tests


def _positions(keys: Sequence[Column], size: int) -> list[Column]:
    """The bits of a key, by two hashes; `size` is a power of two."""
    one, two = F.xxhash64(*keys), F.xxhash64(*keys, F.lit(1))
    odd = two.bitwiseOR(F.lit(1))
    # Masked first, so that sums of long integers cannot overflow.
    mask = F.lit(size - 1).cast("bigint")
    one, odd = one.bitwiseAND(mask), odd.bitwiseAND(mask)
    return [(one + odd * i).bitwiseAND(mask) for i in range(HASHES)]


def key_filter(
    staged: DataFrame, keys: Sequence[str], schema: T.StructType, filter_from: int = FILTER_FROM
) -> KeyFilter:
    """Sum up the keys of `staged` for scans of rows with the given schema.

    Keys are cast to the types that the scanned rows have; those that do not fit match nothing there. A
    Bloom filter is built from `filter_from` keys on, and up to as many as `MOST_BITS` can tell apart;
    beyond that, or with keys of other types, ranges alone are used. The driver gets a row of ranges.
    """
    kinds = {k: schema[k].dataType for k in keys}
    typed = staged.select(*[F.col(f"`{k}`").try_cast(kinds[k]).alias(k) for k in keys]).dropna()
    ranged = [k for k in keys if isinstance(kinds[k], _RANGED)]
    ends = [f(f"`{k}`").alias(f"{i}_{name}") for i, k in enumerate(ranged) for name, f in (("a", F.min), ("b", F.max))]
    found = typed.agg(F.count("*").alias("n"), *ends).first()
    n = found["n"]
    ranges = {k: (found[f"{i}_a"], found[f"{i}_b"]) for i, k in enumerate(ranged)} if n else {}
    plain = KeyFilter(n, ranges, keys, kinds)
    size = 1 << max(6, (n * BITS_A_KEY - 1).bit_length()) if n else 64
    if n < filter_from or size > MOST_BITS or not all(isinstance(k, _HASHED) for k in kinds.values()):
        return plain
    return KeyFilter(n, ranges, keys, kinds, size, _bits(typed, keys, size))


def _bits(typed: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """The bits of all keys as one array of 64-bit words: at most 2^20 words, whatever is staged."""
    at = F.explode(F.array(*_positions([F.col(f"`{k}`") for k in keys], size))).alias("at")
    one = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    words = typed.select(at).select(F.shiftright("at", 6).alias("word"), one.alias("bits"))
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = words.unionByName(typed.sparkSession.range(size // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")))
    dense = every.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all"))
    return materialise(row.select(F.transform("all", lambda x: x["bits"]).alias("words")), "keys")
