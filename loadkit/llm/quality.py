"""A quality classifier on supervised subword embeddings.

Words, pairs of words and character n-grams are hashed into buckets, each bucket has a learned vector, a document is
the average of the vectors of its features, and a softmax over two classes gives the score. The
vectors and the output layer are trained together by stochastic gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import bounded_batches, held_out, may_learn
from loadkit.llm.hashing import WordHasher, spaces_of

#: The fit sees at most this many labelled documents, in the order of a hash of their ids.
SAMPLE_DOCS = 4_000
BUCKET_BITS = 15
DIMENSIONS = 16
#: Lengths of character n-grams in bytes. White space may only be their first or last character.
GRAMS = (3, 4)
EPOCHS, RATE = 12, 0.6
#: Below this score a document is taken for one of low quality.
THRESHOLD = 0.3

LEARN_FOLDS, HELD_OUT = 5, 0

#: Bytes worked on at a time; longer texts are cut at white space, at the cost of one pair of words.
PIECE = 1 << 19

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKET_BITS)


def pieces_of(data: bytes) -> Iterator[bytes]:
    """Cut a text at white space into pieces; a word longer than a piece is cut where it must be."""
    start = 0
    while len(data) - start > PIECE:
        cut = max(data.rfind(sep, start + 1, start + PIECE) for sep in (b" ", b"\n", b"\t"))
        cut = cut if cut > start else start + PIECE
        yield data[start:cut]
        start = cut
    yield data[start:]


class Features:
    """Bucket numbers of the features of byte strings, vectorised over a whole buffer."""

    def __init__(self) -> None:
        self.hasher = WordHasher()

    def __call__(
        self, buffer: bytes, begins: np.ndarray | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions in `buffer` and buckets, one pair for each kind of feature.

        `buffer` must begin and end with white space. `begins` says where its documents begin, so
        that no pair of words spans two of them.
        """
        raw = np.frombuffer(buffer, np.uint8)
        space = spaces_of(raw)
        code = raw.astype(np.uint64)
        code[space] = 32
        found = []
        starts, words = self.hasher(raw, space)
        found.append((starts, (words ^ (words >> np.uint64(29))) * _MULTIPLIER >> _SHIFT))
        # Pairs of words, by the difference of their hashes: any word repeated is the same feature.
        pairs = (words[1:] - words[:-1]) * np.uint64(3)
        pairs = (pairs ^ (pairs >> np.uint64(31))) * _MULTIPLIER >> _SHIFT
        own = np.zeros(len(starts), np.int64)
        if begins is not None:
            own = np.searchsorted(begins, starts, "right")
        inside = own[1:] == own[:-1]
        found.append((starts[1:][inside], pairs[inside]))
        # Character n-grams as whole numbers.
        spaces = np.concatenate([[0], np.cumsum(space)])
        for n in GRAMS:
            size = len(raw) - n + 1
            if size < 1:
                continue
            gram = code[:size].copy()
            for k in range(1, n):
                gram = (gram << np.uint64(8)) | code[k : size + k]
            inner = spaces[n - 1 : n - 1 + size] - spaces[1 : 1 + size]
            at = np.flatnonzero(inner == 0)
            gram = gram[at] + np.uint64(n << 40)
            found.append((at, (gram ^ (gram >> np.uint64(21))) * _MULTIPLIER >> _SHIFT))
        return found


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """What each bucket adds to the difference of the two outputs: averaging is linear."""
        return self.vectors @ (self.output[1] - self.output[0])

    def prior(self) -> float:
        return float(self.bias[1] - self.bias[0])


def counted_features(text: str | None, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and how often each occurs."""
    counts = np.zeros(1 << BUCKET_BITS, np.uint32)
    for piece in pieces_of((text or "").encode()):
        for _, buckets in features(b" " + piece + b" "):
            counts += np.bincount(buckets.astype(np.int64), minlength=len(counts)).astype(np.uint32)
    ids = np.flatnonzero(counts)
    return ids.astype(np.uint16), counts[ids]


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> QualityModel:
    """Fit on (buckets, counts, label) by stochastic gradient descent with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    samples = [s for s in samples if len(s[0])]
    done, steps = 0, max(1, EPOCHS * len(samples))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            ids, counts, label = samples[i]
            share = (counts / counts.sum()).astype(np.float32)
            rate = RATE * (1 - done / steps)
            done += 1
            rows = vectors[ids]
            hidden = share @ rows
            scores = output @ hidden + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= rate * error
            # A feature that is a small share of its document still has to learn.
            vectors[ids] = rows - rate * np.sqrt(share)[:, None] * back
    return QualityModel(vectors, output, bias)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
) -> QualityModel:
    """Fit on a bounded sample of the labelled documents; labels other than 0 and 1 are left out.

    The driver gets the counted features of the sample, at most 6 bytes for each bucket and document.
    """
    known = labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    key = F.md5(F.col("key").cast("string").cast("binary"))
    known = known.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    chosen = known.groupBy("key").agg(F.max("label").alias("label")).orderBy(key).limit(sample_docs)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            found = [counted_features(text, features) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "key": batch["key"],
                    "label": batch["label"],
                    "ids": [ids.tobytes() for ids, _ in found],
                    "counts": [counts.tobytes() for _, counts in found],
                }
            )

    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    rows = (
        texts.join(chosen, "key")
        .select(F.col("key").cast("string").alias("key"), "label", "text")
        .mapInPandas(count, "key string, label int, ids binary, counts binary")
        .collect()
    )
    samples = [
        (np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["counts"], np.uint32), r["label"])
        for r in sorted(rows, key=lambda r: (r["key"], bytes(r["ids"])))
    ]
    return train(samples)


def score_quality(
    docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score"
) -> DataFrame:
    """Add the probability that a document is of good quality.

    Null and empty texts, and texts of white space only, have no features and get the score of the
    bias alone. Every text is read whole. Rows repeated get the same score; other columns stay, and a
    column of that name is replaced.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.margins(), model.prior()))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        margins, prior = shared.value
        features = Features()
        for batch in batches:
            yield pd.Series(document_margins(batch, features, margins)).map(
                lambda m: 1 / (1 + np.exp(-(m + prior)))
            )

    return docs.withColumn(name, score(F.col(text_col)))


def document_margins(texts: pd.Series, features: Features, margins: np.ndarray) -> np.ndarray:
    """The average margin of the features of each text; 0 without features."""
    total, number = np.zeros(len(texts)), np.zeros(len(texts))
    buffer, owners, starts, size = [b" "], [], [], 1

    def flush() -> None:
        nonlocal buffer, owners, starts, size
        if owners:
            begin = np.array(starts)
            for at, buckets in features(b"".join(buffer), begin):
                values = margins[buckets]
                row = np.array(owners)[np.searchsorted(begin, at, "right") - 1]
                total[:] += np.bincount(row, values, len(total))
                number[:] += np.bincount(row, minlength=len(total))
        buffer, owners, starts, size = [b" "], [], [], 1

    for i, text in enumerate(texts):
        for piece in pieces_of((text or "").encode()):
            if not piece:
                continue
            # Two spaces apart, so that no n-gram sees two documents.
            starts.append(size - 1)
            owners.append(i)
            buffer.append(piece + b"  ")
            size += len(piece) + 2
            if size >= PIECE:
                flush()
    flush()
    return np.divide(total, number, out=np.zeros(len(total)), where=number > 0)


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from four of five folds and score every row: doc_id, held_out, score, predicted."""
    learn = labels.filter(may_learn(F.col("doc_id"), LEARN_FOLDS, HELD_OUT))
    model = fit_quality(docs, learn)
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id"), LEARN_FOLDS, HELD_OUT).alias("held_out"), "text"
    )
    return score_quality(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
