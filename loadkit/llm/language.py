"""Language identification by compression.

A text belongs to the language whose dictionary compresses it best. Each language has a zstandard
raw-content dictionary cut from a bounded sample of labelled documents; every text is compressed in
pieces with each of them, and a prediction is rejected when two languages do almost equally well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import bounded_batches, free_name, held_out, may_learn

#: The fit sees at most this many different texts of each language, in the order of a hash of them, and
#: this many characters of each: all of a shorter text, or pieces at hashed places of the whole text.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_PIECES = 96, 1_000, 4
#: Bytes of a text compressed at a time. Short enough that what a piece says about itself does not
#: drown what the dictionary says about it.
PIECE = 2_048
#: Short matches are let in, because a language shows in its syllables and endings.
PARAMETERS = zstandard.ZstdCompressionParameters(
    window_log=17,
    hash_log=16,
    chain_log=16,
    search_log=3,
    min_match=4,
    target_length=1,
    strategy=zstandard.STRATEGY_GREEDY,
    write_content_size=False,
    write_dict_id=False,
)
#: Short texts often tie: they hold no match that long, and a few bytes are not worth a code of their
#: own. Ties are measured again with these, by the bytes that the text adds to samples of the language.
SAMPLES, SAMPLE = 16, 256
FINE_PARAMETERS = zstandard.ZstdCompressionParameters(
    window_log=17,
    hash_log=16,
    chain_log=16,
    search_log=4,
    min_match=4,
    target_length=8,
    strategy=zstandard.STRATEGY_BTLAZY2,
    write_content_size=False,
    write_dict_id=False,
)
#: How sharply the score follows a difference in bits per character.
SHARPNESS = 4.0
#: A prediction is rejected when the second language needs less than this share of bytes more.
NARROW = 0.002
#: The prediction for a text without any letter.
UNKNOWN = "und"

LEARN_FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class LanguageModel:
    """A raw-content dictionary per language, in the order of the language names."""

    names: tuple[str, ...]
    contents: tuple[bytes, ...]

    def compressors(self, fine: bool = False) -> list[zstandard.ZstdCompressor]:
        parameters, made = FINE_PARAMETERS if fine else PARAMETERS, []
        for content in self.contents:
            if fine and len(content) > 2 * SAMPLES * SAMPLE:
                content = content[SAMPLES * SAMPLE :]
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=parameters)
            made.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=parameters))
        return made


_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text in lower case with every run of other characters as one space."""
    return _NO_LETTERS.sub(" ", text.lower()).encode()


class AddedSizes:
    """The bytes that a whole text, in pieces, adds to samples of each language."""

    def __init__(self, model: LanguageModel) -> None:
        self.compressors = model.compressors(fine=True)
        starts = range(0, SAMPLES * SAMPLE, SAMPLE)
        self.samples = [[c[i : i + SAMPLE] for i in starts] for c in model.contents]
        self.alone = [
            sum(len(c.compress(s)) for s in samples)
            for c, samples in zip(self.compressors, self.samples, strict=True)
        ]

    def __call__(self, text: str) -> np.ndarray:
        data = letters(text)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return np.array(
            [
                sum(len(c.compress(s + b" " + p)) for p in pieces for s in samples)
                - len(pieces) * alone
                for c, samples, alone in zip(self.compressors, self.samples, self.alone, strict=True)
            ],
            float,
        )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sampled_text(text: Column, chars: int) -> Column:
    """A text, or `chars` characters of it in pieces at places that a hash of text and piece gives."""
    size = max(1, chars // SAMPLE_PIECES)
    places = [
        F.pmod(F.xxhash64(text, F.lit(i)), F.char_length(text) - size + 1).cast("int") + 1
        for i in range(SAMPLE_PIECES)
    ]
    pieces = F.concat_ws("\n", *[F.substring(text, at, F.lit(size)) for at in places])
    return F.when(F.char_length(text) <= chars, text).otherwise(pieces)


def fit_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> LanguageModel:
    """Fit on documents with a language and a letter; the driver gets the bounded sample only.

    Copies of a text count once, so no group of copies fills the sample; nor does a passage that all
    texts begin with, because pieces are taken from everywhere in a text.
    """
    keyed = docs.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("key"),
    ).filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    by_hash = Window.partitionBy("lang").orderBy("key")
    distinct = keyed.select("lang", "key").distinct()
    # The limit on the rank works before the shuffle too: a task sends `sample_docs` rows a language.
    chosen = distinct.withColumn("turn", F.row_number().over(by_hash)).filter(
        F.col("turn") <= sample_docs
    )
    pieces = keyed.join(F.broadcast(chosen), ["lang", "key"]).select(
        "lang", "key", sampled_text(F.col("text"), sample_chars).alias("piece")
    )
    sample = pieces.groupBy("lang", "key").agg(F.max("piece").alias("piece"))
    found: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", F.desc("key")).select("lang", "piece").collect():
        found.setdefault(row["lang"], []).append(row["piece"])
    names = sorted(found)
    return LanguageModel(tuple(names), tuple(letters("\n".join(found[n])) for n in names))


def compressed_sizes(text: str, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """The bytes that each compressor needs for the whole text, in pieces."""
    data = letters(text)
    pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
    return np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors], float)


def is_narrow(sizes: np.ndarray) -> bool:
    """Whether the second language needs hardly more bytes than the first."""
    if len(sizes) < 2:
        return False
    first, second = np.partition(sizes, 1)[:2]
    return bool(second - first < NARROW * second)


def identify(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "language"
) -> DataFrame:
    """Add a struct column `name`: lang_pred, score, rejected.

    `score` is the softmax over the bits per character of the languages, so it is 1 / (number of
    languages) when all compress alike. Null and empty texts, and texts without a letter, give
    `und`, 0.0, rejected; so does every text when nothing could be learned. Ties go to the first
    language name and are rejected. Rows repeated get the same answer; other columns stay as they are,
    and a column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded dictionary per language

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = shared.value.names
        compressors = shared.value.compressors()
        added = AddedSizes(shared.value)
        for batch in batches:
            rows = []
            for text in batch:
                sizes = compressed_sizes(text, compressors)
                if is_narrow(sizes):
                    sizes = added(text)
                best = int(sizes.argmin())
                weights = np.exp2((sizes[best] - sizes) * 8 * SHARPNESS / len(text))
                rows.append((names[best], 1 / weights.sum(), is_narrow(sizes)))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    bounded_batches(docs.sparkSession)
    text = F.col(text_col)
    unknown = F.struct(
        F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
    )
    if not model.names:
        return docs.withColumn(name, unknown)
    # The UDF sees every row; a text that needs no answer is handed over as one letter.
    usable = has_letter(text)
    found = predict(F.when(usable, text).otherwise(F.lit("x")))
    return docs.withColumn(name, F.when(usable, found).otherwise(unknown))


def predict_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from three of four folds and predict every row: doc_id, held_out, lang_pred, score, rejected."""
    learn = docs.filter(may_learn(F.col(id_col), LEARN_FOLDS, HELD_OUT))
    model = fit_languages(learn, text_col, lang_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col), LEARN_FOLDS, HELD_OUT).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    return identify(rows, model).select("doc_id", "held_out", "language.*")


def known_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows of `docs` whose language is not rejected, with their columns."""
    learn = docs.filter(may_learn(F.col(id_col), LEARN_FOLDS, HELD_OUT))
    name = free_name(docs, "_language")
    found = identify(docs, fit_languages(learn, text_col, lang_col), text_col, name)
    return found.filter(~F.col(f"{name}.rejected")).drop(name)
