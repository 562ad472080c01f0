"""Token ids as Parquet lists, and selective reads of them.

A token store is a folder of Parquet files in ascending order of document ids, a shard per file. Ids
are a dictionary-encoded list column, numbers beside them are delta-encoded, and small pages with
page indexes let a reader take some documents, or the metadata without the ids. Starts are stored
relative to the shard; a shard table holds what comes before each shard.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import KEPT_CHARS, Recent, bounded_batches, chunks, texts

#: How the files are laid out. A vocabulary below 65,536 fits its dictionary page.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(64 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#shard_start": "false",
}
SCHEMA = "doc_id {id}, n_tokens bigint, shard_start bigint, tokens array<int>, shard int"

#: Entries of each of the two generations of a worker's caches of words.
CACHE = 150_000
#: Parts of words that a worker keeps with their ids, those of the latest batches.
KEPT_PARTS = 200_000
#: Parts of letters that the tokenizer's model encodes at once.
TOGETHER = 16_384
#: Texts are encoded in groups of about so many bytes, which bounds what their words take.
GROUP_BYTES = 2 << 20

#: Characters that one side takes for white space and the other does not.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Texts of ASCII and these letters only change their case when they are normalised.
_PLAIN_TEXT = re.compile(r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: The pre-tokens of such a text in lower case.
_PRE_TOKEN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+"
)
#: Most words: letters, and then signs other than the apostrophe, which may belong to letters.
_SIMPLE = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]+)([^\sa-z0-9\xdf-\xf6\xf8-\xff']+)?")
_LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
#: These letters and signs, to trim words.
LETTERS = string.ascii_lowercase + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIGNS = "".join(c for c in map(chr, range(128)) if not (c.isalnum() or c.isspace() or c == "'"))


def _lists(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Lists of so many numbers each, one after the other."""
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _from_bytes(encoded: list[bytes]) -> pa.ListArray:
    counts = np.array([len(e) // 4 for e in encoded], np.int64)
    return _lists(np.frombuffer(b"".join(encoded), "<u4").astype(np.int32), counts)


def _joined(lists: pa.ListArray, edges: np.ndarray) -> pa.ListArray:
    """The lists from each edge to the next as one list; `lists` is no slice."""
    return pa.ListArray.from_arrays(lists.offsets.take(pa.array(edges)), lists.values)


class WordTokenizer:
    """A tokenizer whose pre-tokens never contain white space, so that words are encoded once.

    Texts of plain letters are cut into pre-tokens here, and pre-tokens of letters go to the tokenizer's
    model directly, in its alphabet of bytes, if both give what the whole tokenizer gives for a sample.
    Arrow cuts such texts of a batch together and finds equal words, so that the steps in Python are
    for its distinct words that were not met lately. Other texts are cut at white space; those with
    characters that count as white space on one side only are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {i: written(chr(i))[0][0] for i in range(0xC0, 0x100)}
        self.parts = Recent(self._part, CACHE)
        self.plain_words = Recent(self._plain_word, CACHE)
        self.words = Recent(self._library, CACHE // 2)
        vocabulary, suffix = self.tokenizer.get_vocab(), getattr(self.model, "end_of_word_suffix", None)
        #: By id, whether a token ends a word, if the model marks that.
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.kept, self.kept_ids = pa.array([], pa.string()), _lists([], [])
        sample = "The house's \xe9t\xe9, stra\xdfe 1234; don't you'LL (\xd1o) - internationalisation?!"
        together = self._plain_together(pa.array([sample])).values.to_numpy().astype("<u4").tobytes()
        self.plain = self._plain(sample) == self._library(sample) == together
        # Special tokens keep their meaning only in the whole tokenizer.
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        return self._letters(part) if _LETTERS.fullmatch(part) else self._library(part)

    def _letters(self, part: str) -> bytes:
        found = self.model.tokenize(part if part.isascii() else part.translate(self.alphabet))
        return struct.pack(f"<{len(found)}I", *[token.id for token in found])

    def _plain_word(self, word: str) -> bytes:
        if simple := _SIMPLE.fullmatch(word):
            letters, signs = simple.groups()
            # Letters are kept once, whether signs follow them or not.
            return self.plain_words[letters] + self.parts[signs] if signs else self._letters(letters)
        return b"".join(map(self.parts.__getitem__, _PRE_TOKEN.findall(word)))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.plain_words.__getitem__, text.lower().split()))

    def _is_plain(self, text: str) -> bool:
        return (
            self.plain
            and not any(c in text for c in _ODD)
            and _PLAIN_TEXT.fullmatch(text) is not None
            and not any(s in text for s in self.special)
        )

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._is_plain(text):
            return self._plain(text)
        if any(c in text for c in _ODD):
            return self._library(text)
        return b"".join(map(self.words.__getitem__, text.split()))

    def _letters_together(self, parts: list[str]) -> pa.ListArray:
        """The ids of parts of letters, from the model."""
        values, counts = [np.array([], np.int32)], [np.array([], np.int64)]
        for some in chunks(parts, TOGETHER):
            written = [p if p.isascii() else p.translate(self.alphabet) for p in some]
            options = {"is_pretokenized": True, "add_special_tokens": False}
            ids = np.array(self.bare.encode_batch_fast([written], **options)[0].ids, np.int32)
            # The fast call does not say which part a token is of, but each part has one end.
            number = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(number) != len(some) or number.sum() != len(ids):
                found = self.bare.encode(written, **options)
                ids = np.array(found.ids, np.int32)
                number = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            values.append(ids)
            counts.append(number)
        return _lists(np.concatenate(values), np.concatenate(counts))

    def _parts_together(self, parts: pa.StringArray) -> pa.ListArray:
        """The ids of distinct parts of words. Those of the latest batches are kept."""
        at = pc.index_in(parts, value_set=self.kept)
        absent = pc.is_null(at)
        places, fresh = at.fill_null(0).to_numpy().copy(), parts.filter(absent)
        # Long ones go one at a time, so that what is encoded together is bounded in characters.
        letters = pc.and_(pc.utf8_is_alpha(fresh), pc.less_equal(pc.utf8_length(fresh), KEPT_CHARS))
        others = pc.invert(letters)
        encoded = [
            self.kept_ids,
            self._letters_together(fresh.filter(letters).to_pylist()),
            _from_bytes([self._plain_word(part) for part in fresh.filter(others).to_pylist()]),
        ]
        # Where the new ones are: behind the kept ones, letters first.
        first = np.argsort(others.to_numpy(zero_copy_only=False), kind="stable")
        new = np.empty(len(fresh), places.dtype)
        new[first] = len(self.kept) + np.arange(len(fresh))
        absent = absent.to_numpy(zero_copy_only=False)
        places[absent] = new
        found = pa.concat_arrays(encoded).take(pa.array(places))
        short = pc.less_equal(pc.utf8_length(parts), KEPT_CHARS)
        unused = np.ones(len(self.kept), bool)
        unused[places[~absent]] = False
        unused = pa.array(unused)
        kept = pa.concat_arrays([parts.filter(short), self.kept.filter(unused)])
        kept_ids = pa.concat_arrays([found.filter(short), self.kept_ids.filter(unused)])
        self.kept, self.kept_ids = kept[:KEPT_PARTS], kept_ids[:KEPT_PARTS]
        return found

    def _plain_together(self, texts: pa.Array) -> pa.ListArray:
        """The ids of every text of plain letters."""
        cut = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        found = cut.flatten().dictionary_encode()
        distinct = found.dictionary.cast(pa.string())
        # Most words are letters and then signs, so that trimming either leaves the other.
        letters, signs = pc.utf8_rtrim(distinct, SIGNS), pc.utf8_ltrim(distinct, LETTERS)
        both = pc.add(pc.binary_length(letters), pc.binary_length(signs))
        simple = pc.equal(both, pc.binary_length(distinct))
        halves = [pc.if_else(simple, letters, distinct), pc.if_else(simple, signs, "")]
        parts = pa.concat_arrays(halves).dictionary_encode()
        in_turn = parts.indices.to_numpy().reshape(2, -1).T.ravel()
        lists = self._parts_together(parts.dictionary).take(pa.array(in_turn))
        words = _joined(lists, np.arange(0, len(in_turn) + 1, 2)).take(found.indices)
        return _joined(words, cut.offsets.to_numpy() - cut.offsets[0].as_py())

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of every text of a batch, as `encode` gives them; null texts have none."""
        texts = pc.fill_null(texts, "")
        listed = texts.to_pylist()
        plain = np.array([self._is_plain(text) for text in listed], bool)
        if plain.all():
            return self._plain_together(texts)
        others = _from_bytes([self.encode(t) for t, p in zip(listed, plain, strict=True) if not p])
        both = pa.concat_arrays([self._plain_together(texts.filter(pa.array(plain))), others])
        places = np.empty(len(plain), np.int64)
        places[np.argsort(~plain, kind="stable")] = np.arange(len(plain))
        return both.take(pa.array(places))


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, with its caches; a Python worker keeps it from task to task."""
    return WordTokenizer(path)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of texts of about GROUP_BYTES, or one longer text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        ends = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // GROUP_BYTES)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(size)], strict=True):
            yield batch.slice(a, b - a)


def tokenize(batches: Iterator[pa.RecordBatch], tokenizer: WordTokenizer, end_id: int | None):
    """Batches of doc_id, n_tokens, shard_start, tokens from sorted batches of doc_id, text."""
    start = 0
    for batch in _groups(batches):
        encoded = tokenizer.encode_all(batch.column("text"))
        counts = np.diff(encoded.offsets.to_numpy()).astype(np.int64)
        flat = encoded.flatten().to_numpy()
        if end_id is not None:
            flat = np.insert(flat, np.cumsum(counts), end_id)
            counts += 1
        offsets, tokens = np.concatenate([[0], np.cumsum(counts)]), _lists(flat, counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts), pa.array(start + offsets[:-1]), tokens],
            names=["doc_id", "n_tokens", "shard_start", "tokens"],
        )
        start += int(offsets[-1])


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode the whole text of every row and write a token store to `path`.

    Null texts count as empty; an empty text has only the end id, if there is one. Rows without an id
    come first; rows with the same id are ordered by text. An empty table gives an empty store. The
    texts are range-partitioned before they are encoded, so no text is encoded twice.
    """
    rows = texts(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions(
        "doc_id", "text"
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return tokenize(batches, word_tokenizer(vocabulary), end_id)

    bounded_batches(docs.sparkSession)
    schema = SCHEMA.format(id=id_type).rpartition(",")[0]
    encoded = rows.mapInArrow(encode, schema).withColumn("shard", F.spark_partition_id())
    encoded.write.options(**LAYOUT).parquet(path)


class TokenStore:
    """Reads of a folder that `write_tokens` wrote."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint") -> None:
        self.rows = spark.read.schema(SCHEMA.format(id=id_type)).parquet(path)

    def shards(self) -> DataFrame:
        """Per shard: its documents, its ids and the ids before it. Reads no ids."""
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        totals = self.rows.groupBy("shard").agg(
            F.count("*").alias("n_docs"), F.sum("n_tokens").alias("shard_tokens")
        )
        # A row per file, however many documents there are.
        return totals.withColumn("before", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)))

    def documents(self, where: Column | None = None, tokens: bool = False) -> DataFrame:
        """doc_id, start (ids of all documents before it), n_tokens, and the ids when asked for.

        A condition on doc_id reaches the files: other row groups and pages are skipped.
        """
        rows = self.rows if where is None else self.rows.filter(where)
        shards = F.broadcast(self.shards().select("shard", "before"))
        start = (F.col("before") + F.col("shard_start")).alias("start")
        more = ["tokens"] if tokens else []
        return rows.join(shards, "shard").select("doc_id", start, "n_tokens", *more)


def with_checksums(rows: DataFrame) -> DataFrame:
    """Replace `tokens` by `ids_crc32`, the checksum of the ids as little-endian 32-bit integers."""

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            edge = lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            columns = [batch.column(n) for n in batch.schema.names if n != "tokens"]
            names = [n for n in batch.schema.names if n != "tokens"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], [*names, "ids_crc32"])

    bounded_batches(rows.sparkSession)
    schema = rows.drop("tokens").withColumn("ids_crc32", F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(checksum, schema)
