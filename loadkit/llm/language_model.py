"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation in numpy.

Words of all training documents are counted by Spark. Every word that is counted often enough has
vectors of its own; the others share one, inside which a word has its smoothed share. Words are
predicted in two levels, the class and then the word in its class, by linear combinations of the
vectors of the two tokens before. Classes go by frequency: a frequent word is a class of its own, the
others are cut into classes that grow with the root of the rank. Each task trains on its part of the documents by
minibatches, and Spark averages the tasks' rows, weighted by how often each was trained. Matrix
products over all classes, and over all words of the token's class, give the normalisers, so every
token probability is exact.

The parts are made by a hash of the row, and their number follows the root of the number of tokens, so
parts and their sizes grow alike, and scores do not depend on how the input is cut into files. Counts of
words of the model, whose number is bounded by their share of the tokens, go to the tasks; all others
are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.llm.common import bounded_batches, held_out, may_learn, texts
from loadkit.session import materialise

#: Words of the model: counted at least so often, and at least this share of all training tokens, so
#: there are at most as many. Words longer than `LONGEST` bytes are no words of the model.
LEAST_COUNT, FREQUENT, LONGEST = 5, 1 << 20, 64
#: The first tokens of the model: the shared one and the end of a document.
SHARED, END = 0, 1
#: Tokens that are classes of their own; a class of others has so many words times the root of its first
#: word's rank, which by Zipf's law keeps the numbers under a token's two normalisers few.
HEAD, MEMBERS = 128, 4
DIMENSIONS = 16
#: Noise of the classes for a batch and of a class for each token.
NOISE, INNER_NOISE, BATCH, RATE = 64, 2, 2_048, 0.15
#: Parts of n tokens: the root of n by this number.
PART = 50_000
#: Tokens that are scored at a time, and rows of a product, whose numbers fit a processor's cache.
SCORED, ROWS = 1 << 18, 256

LEARN_FOLDS, HELD_OUT = 7, 2


@dataclass(frozen=True)
class Words:
    """The words of several texts in lower case (A-Z only), cut at U+0020 and U+0009 to U+000D."""

    #: The distinct words, and of every word its place among them.
    distinct: pa.Array
    index: np.ndarray
    #: The first word of each text.
    first: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """The words of a column of texts, null ones empty; equal words are found by Arrow."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = cut.flatten()
    # White space at the ends of a text leaves empty strings, which are no words.
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    edge = cut.offsets.to_numpy() - cut.offsets[0].as_py()
    first = np.concatenate([[0], np.cumsum(full)])[edge[:-1]]
    found = flat.filter(pa.array(full)).cast(pa.binary()).dictionary_encode()
    return Words(found.dictionary, found.indices.to_numpy(), first)


def count_words(docs: DataFrame) -> DataFrame:
    """word (bytes) and c, over the whole texts of all rows of `docs` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words_of(batch.column("text"))
            times = np.bincount(found.index, minlength=len(found.distinct))
            yield pa.RecordBatch.from_arrays([found.distinct, pa.array(times, pa.int64())], names=["word", "c"])

    bounded_batches(docs.sparkSession)
    found = docs.select("text").mapInArrow(count, "word binary, c bigint")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """The tokens of the model by frequency, their classes, and how often they are expected.

    The words of `listed` are the tokens behind the shared one and the end.
    """

    listed: pa.Array
    #: Per token one more than its count, and the sums of these over classes.
    mass: np.ndarray
    class_mass: np.ndarray
    #: Per token its class, and the first token of each class with the number of all tokens behind.
    of: np.ndarray
    starts: np.ndarray

    @property
    def words(self) -> list[bytes]:
        return self.listed.to_pylist()

    @property
    def size(self) -> int:
        return len(self.mass)

    def places(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of several documents with their ends, and where the documents start."""
        known = pc.fill_null(pc.index_in(found.distinct, self.listed), SHARED - 2).to_numpy() + 2
        first = found.first + np.arange(len(found.first))
        out = np.full(len(found.index) + len(first), END, np.int32)
        own = np.ones(len(out), bool)
        own[np.append(first[1:], len(out)) - 1] = False
        out[own] = known[found.index]
        return out, first


def vocabulary_of(words: list[bytes], counts: np.ndarray, shared: int, ends: int) -> Vocabulary:
    """The vocabulary of `words` by falling count; `shared` tokens are other words."""
    mass = np.concatenate([[shared, ends], counts]).astype(float) + 1
    mass = np.append(mass, np.zeros(max(0, HEAD - len(mass))))
    starts = list(range(HEAD))
    at = HEAD
    while at < len(mass):
        starts.append(at)
        at += int(MEMBERS * math.sqrt(at))
    starts = np.append(starts, len(mass))
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return Vocabulary(pa.array(words, pa.binary()), mass, np.add.reduceat(mass, starts[:-1]), of, starts)


@dataclass(frozen=True)
class Parameters:
    """Vectors of context tokens, and vectors with a bias of classes and of words in their classes."""

    context: np.ndarray
    outer: np.ndarray
    inner: np.ndarray
    places: np.ndarray


def first_parameters(words: Vocabulary, seed: int = 11) -> Parameters:
    """Small random context vectors, and biases that make the model the unigram distribution."""
    rng = np.random.default_rng(seed)
    start = lambda mass: np.column_stack(
        [np.zeros((len(mass), DIMENSIONS)), np.log(np.maximum(mass, 1e-9))]
    ).astype(np.float32)
    return Parameters(
        rng.normal(0, 0.1, (words.size, DIMENSIONS)).astype(np.float32),
        start(words.class_mass / words.class_mass.sum()),
        start(words.mass[HEAD:] / words.class_mass[words.of[HEAD:]]),
        np.stack([np.eye(DIMENSIONS), np.eye(DIMENSIONS) * 0.5]).astype(np.float32),
    )


def contexts(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token and the one before that; `first` marks the starts of documents."""
    one, two = np.roll(tokens, 1), np.roll(tokens, 2)
    one[first] = END
    two[first] = END
    second = first + 1
    two[second[second < len(tokens)]] = END
    return one, two


class Trainer:
    """Noise-contrastive estimation of both levels, with a rate that falls for every parameter."""

    def __init__(self, start: Parameters, words: Vocabulary, seed: int) -> None:
        # Behind its numbers each row has the mean square of its vector's slopes, and that of its bias's.
        self.rows = [_with_squares(x) for x in (start.context, start.outer, start.inner, start.places)]
        self.words, self.rng = words, np.random.default_rng(seed)
        self.class_sums = np.cumsum(words.class_mass)
        self.class_share = (words.class_mass / self.class_sums[-1]).astype(np.float32)
        self.tail_sums = np.concatenate([[0], np.cumsum(words.mass[HEAD:])])
        # Per class its first word, its last one, and the sums of mass before it and in it.
        starts = np.maximum(words.starts - HEAD, 0)
        self.low, self.high = starts[:-1], starts[1:] - 1
        self.bottom = self.tail_sums[starts[:-1]]
        self.span = self.tail_sums[starts[1:]] - self.bottom
        self.log_class = start.outer[:, -1] + np.float32(np.log(NOISE))
        self.log_inner = start.inner[:, -1] + np.float32(np.log(INNER_NOISE))
        self.seen = [np.zeros(len(rows), np.int64) for rows in self.rows[:3]]
        self.tokens = 0

    def parameters(self) -> Parameters:
        context, outer, inner, places = self.rows
        n = DIMENSIONS
        return Parameters(context[:, :n], outer[:, : n + 1], inner[:, : n + 1], places[..., :n])

    def _climb(self, value: np.ndarray, rows, slope: np.ndarray) -> None:
        found, n = value[rows], slope.shape[-1]
        vectors, biases = slope[..., :DIMENSIONS], slope[..., DIMENSIONS:]
        found[..., n] += np.einsum("...d,...d->...", vectors, vectors) / DIMENSIONS
        found[..., n + 1 :] += biases**2
        rate = RATE / np.sqrt(found[..., n:])
        found[..., :DIMENSIONS] += vectors * rate[..., :1]
        found[..., DIMENSIONS:n] += biases * rate[..., 1:]
        value[rows] = found

    def _climb_rows(self, value: np.ndarray, rows: np.ndarray, slopes: np.ndarray, of: int = 1) -> None:
        """One step along the mean slope of each row; each of `slopes` is the sum of so many."""
        rows, sums, many = _summed(rows, slopes)
        self._climb(value, rows, sums / (many[:, None] * of))

    def step(self, one: np.ndarray, two: np.ndarray, token: np.ndarray) -> None:
        """One minibatch: raise the tokens over noise, of classes for the batch, of words for each token."""
        context, outer, _, places = self.rows
        n = DIMENSIONS
        a, b, p = context[one][:, :n], context[two][:, :n], places[..., :n].copy()
        hidden = np.ones((len(token), n + 1), np.float32)  # ends with a one for the bias
        np.add(a @ p[0], b @ p[1], out=hidden[:, :-1])
        of = self.words.of[token]
        drawn = np.searchsorted(self.class_sums, self.rng.random(NOISE) * self.class_sums[-1], "right")
        drawn = np.minimum(drawn, len(self.class_sums) - 1)
        target, others = outer[of][:, : n + 1], outer[drawn][:, : n + 1]
        up = 1 - _sigmoid(np.einsum("nd,nd->n", hidden, target) - self.log_class[of])
        biased = others.copy()
        biased[:, -1] -= self.log_class[drawn]
        down = _sigmoid(hidden @ biased.T)
        back = up[:, None] * target[:, :-1]
        back -= down @ others[:, :-1]
        # Over the tokens of a class that a batch should have, at least one.
        slope = np.zeros((len(outer), n + 1), np.float32)
        rows, sums, _ = _summed(of, up[:, None] * hidden)
        slope[rows] = sums
        np.subtract.at(slope, drawn, down.T @ hidden)
        rows = np.flatnonzero(slope[:, -1])
        expected = np.maximum(len(token) * self.class_share[rows], 1)
        self._climb(outer, rows, slope[rows] / expected[:, None])
        if (tail := np.flatnonzero(token >= HEAD)).size:
            back[tail] += self._inner_step(hidden[tail], token[tail] - HEAD, of[tail])
        # The token two before is the one before of the token before; at the start of a document both are
        # the same. So a row of slopes for each token is enough, and one for the first of the batch.
        near, far = back @ p[0].T, back @ p[1].T
        first = np.flatnonzero(two[1:] != one[:-1]) + 1
        near[first] += far[first]
        far[first] = 0
        near[:-1] += far[1:]
        self._climb_rows(context, np.append(one, two[0]), np.concatenate([near, far[:1]]), 2)
        self._climb(places, slice(None), np.stack([a.T @ back, b.T @ back]) / len(token))

    def _inner_step(self, hidden: np.ndarray, word: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Raise words over others of their classes; the slopes of the hidden vectors."""
        at = self.bottom[of, None] + self.rng.random((len(word), INNER_NOISE)) * self.span[of, None]
        drawn = np.searchsorted(self.tail_sums, at, "right") - 1
        drawn = np.clip(drawn, self.low[of, None], self.high[of, None])
        both = np.column_stack([word, drawn])
        inner = self.rows[2]
        found = inner[both][:, :, : DIMENSIONS + 1]
        up = -_sigmoid(np.einsum("nkd,nd->nk", found, hidden) - self.log_inner[both])
        up[:, 0] += 1
        slopes = (up[:, :, None] * hidden[:, None]).reshape(-1, DIMENSIONS + 1)
        self._climb_rows(inner, both.ravel(), slopes)
        return np.einsum("nk,nkd->nd", up, found[:, :, :-1])

    def learn(self, tokens: np.ndarray, first: np.ndarray) -> None:
        one, two = contexts(tokens, first)
        for at in range(0, len(tokens), BATCH):
            part = slice(at, at + BATCH)
            with np.errstate(over="ignore"):
                self.step(one[part], two[part], tokens[part])
        self.seen[0] += np.bincount(one, minlength=len(self.seen[0]))
        self.seen[1] += np.bincount(self.words.of[tokens], minlength=len(self.seen[1]))
        self.seen[2] += np.bincount(tokens[tokens >= HEAD] - HEAD, minlength=len(self.seen[2]))
        self.tokens += len(tokens)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, rows of `DIMENSIONS` + 1 numbers, and how often each was trained, if ever."""
        found = self.parameters()
        places = found.places.reshape(-1, DIMENSIONS)
        rows = [np.pad(found.context, ((0, 0), (0, 1))), found.outer, found.inner, np.pad(places, ((0, 0), (0, 1)))]
        seen = np.concatenate([*self.seen, np.full(len(places), self.tokens)])
        found = np.flatnonzero(seen)
        return found, np.concatenate(rows)[found], seen[found].astype(float)


def _with_squares(rows: np.ndarray) -> np.ndarray:
    more = 1 + rows.shape[-1] - DIMENSIONS
    return np.concatenate([rows, np.full((*rows.shape[:-1], more), 1e-3, np.float32)], axis=-1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.exp(np.negative(x, out=x), out=x)  # infinite where the result is 0
    x += 1
    return np.reciprocal(x, out=x)


def _summed(rows: np.ndarray, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, their sums, and how many slopes each has."""
    # The places go into the keys, so that a plain sort keeps their order.
    keys = np.sort((rows.astype(np.int64) << 32) + np.arange(len(rows)))
    order, rows = keys & 0xFFFFFFFF, keys >> 32
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    many = np.diff(np.append(starts, len(rows))).astype(np.float32)
    return rows[starts], np.add.reduceat(slopes[order], starts), many


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Per row of `docs` (doc_id, text): a hash of the row and the whole text's tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(words)  # at most FREQUENT words

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tokens, first = shared.value.places(words_of(batch.column("text")))
                offsets = pa.array(np.append(first, len(tokens)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(tokens))
                yield pa.RecordBatch.from_arrays([batch.column("row"), lists], names=["row", "tokens"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")
    return rows.mapInArrow(encode, "row bigint, tokens array<int>")


def train(docs: DataFrame, words: Vocabulary, n_tokens: int) -> Parameters:
    """Train on the whole texts of all rows of `docs` (doc_id, text) and average over the parts.

    The driver gets the average alone, whose rows are bounded, however many parts there are.
    """
    start = first_parameters(words)
    shared = docs.sparkSession.sparkContext.broadcast((start, words))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, waiting, size = Trainer(*shared.value, 5), [], 0

        def flush() -> None:
            lengths = np.array([len(t) for t in waiting])
            trainer.learn(np.concatenate(waiting), np.cumsum(lengths) - lengths)
            waiting.clear()

        for batch in batches:
            for tokens in batch.column("tokens"):
                waiting.append(tokens.values.to_numpy())
                size += len(waiting[-1])
                if size >= 32 * BATCH:
                    flush()
                    size = 0
        if waiting:
            flush()
        found, rows, seen = trainer.result()
        for at in range(0, len(found), 1 << 14):
            part = slice(at, at + (1 << 14))
            flat = pa.array(rows[part].ravel(), pa.float32())
            offsets = pa.array(np.arange(len(found[part]) + 1) * rows.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[part]), pa.ListArray.from_arrays(offsets, flat), pa.array(seen[part])],
                names=["row", "numbers", "weight"],
            )

    parts = math.isqrt(n_tokens // PART) + 1
    cut = encoded(docs, words).repartition(parts, "row").sortWithinPartitions("row", "tokens")
    trained = cut.mapInArrow(learn, "row bigint, numbers array<float>, weight double")
    mean = [
        (F.sum(F.col("numbers")[i] * F.col("weight")) / F.sum("weight")).cast("float").alias(f"n{i}")
        for i in range(DIMENSIONS + 1)
    ]
    rows = trained.groupBy("row").agg(*mean).toArrow()
    sizes = [len(start.context), len(start.outer), len(start.inner)]
    places = start.places.reshape(-1, DIMENSIONS)
    pad = lambda x: np.pad(x, ((0, 0), (0, 1)))
    every = np.concatenate([pad(start.context), start.outer, start.inner, pad(places)])
    every[rows.column("row").to_numpy()] = np.column_stack([c.to_numpy() for c in rows.columns[1:]])
    context, outer, inner, places = np.split(every, np.cumsum(sizes))
    return Parameters(
        context[:, :-1], outer, inner, places[:, :-1].reshape(2, DIMENSIONS, DIMENSIONS)
    )


@dataclass(frozen=True)
class LanguageModel:
    """What tasks need to score: counts, words and the vectors of the log-bilinear model."""

    tokens: int
    distinct: int
    end_count: int
    shared_mass: float
    words: Vocabulary
    #: Per token the logarithm of its count plus one; 0 for the shared one and the end.
    log_counts: np.ndarray
    #: Context vectors moved by their place, and vectors and biases of classes and of words.
    near: np.ndarray
    far: np.ndarray
    outer: np.ndarray
    inner: np.ndarray

    def log10(self, one: np.ndarray, two: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The exact log10 probability of each token behind the two tokens before it."""
        # The places go into the keys, as in `_summed`: 40 bits of two words and 18 of a place at most.
        key = np.sort(((one.astype(np.int64) * self.words.size + two) << 18) + np.arange(len(token)))
        place, key = key & (SCORED - 1), key >> 18
        new = np.flatnonzero(np.diff(key, prepend=-1))
        pair, back = key[new], np.empty(len(token), np.int64)
        back[place] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(key))))
        hidden = np.empty((len(pair), DIMENSIONS + 1), np.float32)
        np.add(self.near[pair // self.words.size], self.far[pair % self.words.size], out=hidden[:, :-1])
        hidden[:, -1] = 1
        # A normaliser of the classes for each pair of words before, however many tokens follow it.
        total = np.empty(len(pair))
        for at in range(0, len(pair), ROWS):
            total[at : at + ROWS] = _log_total(hidden[at : at + ROWS], self.outer)
        hidden, of = hidden[back], self.words.of[token]
        value = np.einsum("nd,nd->n", hidden, self.outer[of]) - total[back]
        tail = np.flatnonzero(token >= HEAD)
        tail = tail[np.argsort(of[tail], kind="stable")]
        hidden, word, of = hidden[tail], token[tail] - HEAD, of[tail]
        inside = np.einsum("nd,nd->n", hidden, self.inner[word])
        edge = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
        for start, end in zip(edge[:-1], edge[1:], strict=True):
            low, high = self.words.starts[of[start] :][:2] - HEAD
            for at in range(start, end, ROWS):
                part = slice(at, min(at + ROWS, end))
                inside[part] -= _log_total(hidden[part], self.inner[low:high])
        value[tail] += inside
        return value * np.log10(np.e)


def _log_total(hidden: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The log of the sum over all rows of `vectors`; `hidden` ends with ones."""
    scores = hidden @ vectors.T
    with np.errstate(over="ignore"):
        total = np.exp(scores, out=scores) @ np.ones(len(vectors), np.float32)
    total = np.log(total, where=total > 0, out=np.full(len(total), -np.inf, np.float32))
    if len(far := np.flatnonzero(~np.isfinite(total))):  # beyond the range of the numbers
        scores = (hidden[far] @ vectors.T).astype(float)
        top = scores.max(1)
        total[far] = top + np.log(np.exp(scores - top[:, None]).sum(1))
    return total


def fit_language_model(docs: DataFrame, counts: DataFrame) -> LanguageModel:
    """Fit on the rows of `docs` (doc_id, text), whose words are counted in `counts`."""
    n_docs = docs.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = total["n"] + n_docs, total["v"] + bool(n_docs)
    often = (F.col("c") >= LEAST_COUNT) & (F.col("c") * FREQUENT >= tokens)
    found = counts.filter((F.length("word") <= LONGEST) & often).select("word", "c").toArrow()
    found = sorted(zip(*(found.column(n).to_pylist() for n in ("word", "c"))), key=lambda x: (-x[1], x[0]))
    number = np.array([c for _, c in found], np.int64)
    shared = total["n"] - int(number.sum())
    words = vocabulary_of([w for w, _ in found], number, shared, n_docs)
    fitted = train(docs, words, tokens) if n_docs else first_parameters(words)
    fitted.outer[words.class_mass == 0, -1] = -np.inf  # there are no such classes
    logs = np.log10(np.maximum(words.mass, 1))
    logs[[SHARED, END]] = 0.0
    return LanguageModel(
        tokens,
        distinct,
        n_docs,
        # Other words by one more than their count, and one for all that were never counted.
        float(shared + total["v"] - len(found) + 1),
        words,
        logs,
        fitted.context @ fitted.places[0],
        fitted.context @ fitted.places[1],
        fitted.outer,
        fitted.inner,
    )


def score_batch(found: Words, model: LanguageModel) -> tuple[np.ndarray, ...]:
    """Per document: n_tokens, tokens of model words, sums of their log counts, the model's sum over
    tokens, tokens of the shared one; and the place of every word."""
    places, first = model.words.places(found)
    one, two = contexts(places, first)
    value = np.empty(len(places))
    for at in range(0, len(places), SCORED):
        part = slice(at, at + SCORED)
        value[part] = model.log10(one[part], two[part], places[part])
    total = lambda x: np.add.reduceat(x, first)
    return (
        np.diff(np.append(first, len(places))),
        total((places > END).astype(np.int64)),
        total(model.log_counts[places]),
        total(value),
        total((places == SHARED).astype(np.int64)),
        places,
    )


def score_texts(docs: DataFrame, model: LanguageModel, counts: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, held_out, text): n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FREQUENT words
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, known bigint, logs double,"
        " value double, n_shared bigint, rare array<binary>, times array<bigint>"
    )
    names = T.StructType.fromDDL(schema).fieldNames()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = words_of(batch.column("text"))
            *sums, places = score_batch(found, model)
            # Per document its distinct words that are no words of the model, and how often each occurs.
            ends = np.cumsum(sums[0])
            at = np.flatnonzero(places == SHARED)
            doc = np.searchsorted(ends, at, "right")
            key, times = np.unique(doc * len(found.distinct) + found.index[at - doc], return_counts=True)
            edge = np.searchsorted(key, np.arange(len(ends) + 1) * len(found.distinct))
            edge = pa.array(edge, pa.int32())
            rare = found.distinct.take(pa.array(key % max(len(found.distinct), 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in ("row", "doc_id", "held_out")],
                    *map(pa.array, sums),
                    pa.ListArray.from_arrays(edge, rare),
                    pa.ListArray.from_arrays(edge, pa.array(times, pa.int64())),
                ],
                names=names,
            )

    bounded_batches(docs.sparkSession)
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    # Written once, so that the row numbers stay the same for both readers.
    scored = materialise(rows.mapInArrow(score, schema), "scores")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")
    )
    log_count = F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1.0)
    of_rare = (
        rare.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * log_count).alias("rare_logs"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    rare_logs = F.coalesce(F.col("rare_logs"), F.lit(0.0))
    end_log, end_known = float(np.log10(model.end_count + 1)), int(model.end_count > 0)
    mass = float(np.log10(model.tokens + model.distinct + 1))
    return scored.join(of_rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + end_known).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + rare_logs + end_log - F.col("n_tokens") * mass).alias("base_score"),
        (
            F.col("value")
            + rare_logs
            - F.col("n_shared") * float(np.log10(model.shared_mass))
        ).alias("score"),
    )


def model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from six of seven folds and score the whole text of every row.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null and empty
    texts have the end as their only token. Rows without an id are scored and not learned from; rows
    repeated get the same score. With nothing to learn from, base scores are 0 and the model knows the
    shared token and the end alone, each with half of the mass. Texts of any length are scored whole, a
    stretch at a time; an empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col)
    learn = rows.filter(may_learn(F.col("doc_id"), LEARN_FOLDS, HELD_OUT)).select("doc_id", "text")
    counts = materialise(count_words(learn), "word-counts")
    model = fit_language_model(learn, counts)
    rows = rows.withColumn("held_out", held_out(F.col("doc_id"), LEARN_FOLDS, HELD_OUT))
    return score_texts(rows, model, counts)
