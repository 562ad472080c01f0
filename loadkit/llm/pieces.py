"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three machines: a normaliser that writes the dummy prefix and the mark
of white space, a lexicon whose arcs read the characters of a piece and write its id, and a fallback
that writes an unknown character as bytes. A text is an acceptor; composed with the machines it gives
an acyclic lattice, and its shortest path in the tropical semiring is the encoding.

Arc weights follow the model. In a unigram model an arc weighs minus the score of its piece. In a
merge model (BPE) the lexicon is composed with an acceptor of piece pairs: a pair weighs 0 if merging
its characters in the order of the scores ends in exactly these two pieces, and infinity if not.
Merges on both sides of a boundary do not see each other until one crosses it, so a path of weight 0
is the result of all merges, and each prefix of a text has exactly one. A state is therefore a
position, and the shortest path takes one pass over it.

The machines are arrays. The lexicon's states are the reversed beginnings of pieces; it is composed with
many words at once, which gives the arcs that end at each position, and one relaxation by position
finds the shortest paths of all words. Between two characters that no piece has side by side the
lattice is cut: every path meets there. Words are composed once and kept in a bounded cache, which a
Python worker keeps from task to task. Long words take the same steps one at a time.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loadkit.llm.common import KEPT_CHARS, Recent, bounded_batches, chunks

SPACE = "▁"
# Fixed values of the model format: model types and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: How much worse than the worst piece an unknown character is in a unigram model.
UNKNOWN_PENALTY = 10.0

#: Entries of each of the two generations of a worker's cache of words; the other caches have a part of it.
CACHE = 160_000
#: Words that are composed with the machines at once.
TOGETHER = 16_384
#: Texts are encoded in groups of about so many characters, whose words the cache can hold.
GROUP_CHARS = 1 << 20
#: Places of the table of pairs of pieces; of two pairs with the same place the later one is kept.
PLACES = 1 << 20
#: A code point, or the number of a piece or state, fits so many bits.
BITS = 21


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield number, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    """What a model file says: pieces with scores and types, and the normaliser's settings."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Read a model file; one whose rules are not compiled here raises."""
        with open(path, "rb") as file:
            data = file.read()
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                rules = dict(_fields(value))
                model.dummy_prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only the identity normaliser with escaped spaces is compiled")
        if model.kind not in (UNIGRAM, BPE) or not model.byte_fallback:
            raise ValueError("only unigram and merge models with byte fallback are compiled")
        if any(kind == USER_DEFINED for _, _, kind in model.pieces):
            raise ValueError("user-defined pieces are not compiled")
        return model


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted numbers are in sorted keys; -1 for those that are absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class PieceTransducer:
    """The compiled machines of a model."""

    _PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        usable = [(p, s, i) for i, (p, s, kind) in enumerate(model.pieces) if kind == NORMAL]
        self.ids = {p: i for p, _, i in usable}
        self.scores = {p: s for p, s, _ in usable}
        self.longest = max((len(p) for p in self.ids), default=1)
        # By the last two characters, how long the arcs that read them can be.
        found: dict[str, set[int]] = {}
        for piece in self.ids:
            found.setdefault(piece[-2:], {1}).add(len(piece))
        self.lengths = {ending: tuple(sorted(n)) for ending, n in found.items()}
        self.glued = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        # Spaces start parts only if no piece has one behind another character.
        self.by_space = not any(pair[1] == SPACE != pair[0] for pair in self.glued)
        self.worst = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.stable: dict[tuple[str, str], bool] = {}
        self.lattices = Recent(self._shortest_path, CACHE // 8)
        self.parts = Recent(self._encode_part, CACHE // 8)
        self.words = Recent(lambda word: self._encode_part(SPACE + word), CACHE)
        self.written = [self._write(p, kind) for p, _, kind in model.pieces]
        self._compile()

    def _compile(self) -> None:
        """The machines as arrays: transitions of the lexicon, the pieces its states end, and weights."""
        self.texts = [p for p, _, _ in self.model.pieces]
        self.start = len(self.texts) + (1 << BITS) - 1  # no piece yet; below it, unknown characters
        states: dict[int, int] = {}
        ends = {0: -1}
        for piece, number in self.ids.items():
            state = 0
            for char in reversed(piece):
                state = states.setdefault(state << BITS | ord(char), len(states) + 1)
            ends[state] = number
        self.arcs = np.array(sorted(states), np.int64)
        self.targets = np.array([states[key] for key in self.arcs.tolist()], np.int64)
        self.ends = np.array([ends.get(state, -1) for state in range(len(states) + 1)], np.int64)
        self.side_by_side = np.array(sorted(ord(p[0]) << BITS | ord(p[1]) for p in self.glued), np.int64)
        self.costs = np.array([-self.scores.get(p, self.worst) for p in self.texts] or [0.0])
        self.pairs = np.full(PLACES, -1, np.int64)

    @staticmethod
    def _write(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else piece.replace(SPACE, " ").encode()

    def _merge(self, text: str) -> list[str]:
        """Merge characters by the highest score, the leftmost first."""
        parts, score, none = list(text), self.scores.get, -np.inf
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _stable(self, pair: tuple[str, str]) -> bool:
        """Whether the acceptor of pairs has an arc of weight 0 from one piece to the next."""
        known = self.stable.get(pair)
        if known is None:
            if len(self.stable) >= 2 * CACHE:
                self.stable.clear()
            known = self.stable[pair] = self._merge(pair[0] + pair[1]) == [p for p in pair if p]
        return known

    def _text(self, number: int) -> str:
        """The characters of a piece, or of an unknown character, by its number."""
        if number < len(self.texts):
            return self.texts[number]
        return "" if number == self.start else chr(number - len(self.texts))

    def _pass(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Whether the acceptor of pairs has arcs of weight 0 from one piece to the next."""
        keys = before << BITS + 1 | pieces
        places = (keys * np.int64(0x9E3779B97F4A7C1 | 1) >> np.int64(20)) & (PLACES - 1)
        held = self.pairs[places]
        answer = (held & 1).astype(bool)
        other = np.flatnonzero(held >> 1 != keys)
        if len(other):
            _, one, every = np.unique(keys[other], return_index=True, return_inverse=True)
            one = other[one]
            pairs = zip(before[one].tolist(), pieces[one].tolist(), strict=True)
            found = np.array([self._stable((self._text(a), self._text(b))) for a, b in pairs])
            self.pairs[places[one]] = keys[one] << 1 | found
            answer[other] = found[every]
        return answer

    def _compose(self, codes: np.ndarray, local: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Compose characters with the lexicon: per length, the positions where arcs end, by their place
        in the part, and the pieces that they write. Every single character has an arc."""
        order = np.argsort(local, kind="stable")
        state, found = np.zeros(len(codes), np.int64), []
        for length in range(1, self.longest + 1):
            order = order[local[order] >= length]
            at = _places(self.arcs, state[order] << BITS | codes[order - length + 1])
            if length == 1:
                piece = np.where(at < 0, -1, self.ends[self.targets[at]])
                piece = np.where(piece < 0, codes[order] + len(self.texts), piece)
                found.append((order, piece))
                order, at = order[at >= 0], at[at >= 0]
            else:
                order, at = order[at >= 0], at[at >= 0]
            state[order] = self.targets[at]
            if length > 1:
                piece = self.ends[state[order]]
                found.append((order[piece >= 0], piece[piece >= 0]))
        return found

    def shortest_paths(self, words: list[str]) -> list[bytes]:
        """The ids of the shortest paths of many words, none of them empty."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        last = np.cumsum([len(w) for w in words])
        cut = np.append(_places(self.side_by_side, codes[:-1] << BITS | codes[1:]) < 0, True)
        cut[last - 1] = True
        place = np.arange(len(codes))
        first = np.append(0, np.flatnonzero(cut)[:-1] + 1)
        local = place - np.repeat(first, np.diff(np.append(first, len(codes)))) + 1
        arcs = self._compose(codes, local)
        bounds = [np.searchsorted(local[at], np.arange(1, local.max() + 2)) for at, _ in arcs]
        best, size = np.full(len(codes), np.inf), np.zeros(len(codes), np.int64)
        via, merging = np.full(len(codes), self.start), self.model.kind == BPE
        # A merge model has one path, so short arcs, the most, go first; else the longest of ties wins.
        lengths = range(1, len(arcs) + 1) if merging else range(len(arcs), 0, -1)
        for step in range(1, len(bounds[0])):
            for length in lengths:
                if length > step:
                    continue
                ends, pieces = arcs[length - 1]
                part = slice(bounds[length - 1][step - 1], bounds[length - 1][step])
                at, piece = ends[part], pieces[part]
                if merging:
                    open_ = np.isinf(best[at])
                    at, piece = at[open_], piece[open_]
                if not len(at):
                    continue
                before = at - length
                if merging:
                    ok = self._pass(via[before] if step > length else np.full(len(at), self.start), piece)
                    weight = np.zeros(len(at))
                else:
                    known = np.minimum(piece, len(self.costs) - 1)
                    cost = np.where(piece < len(self.texts), self.costs[known], -self.worst)
                    weight = (best[before] if step > length else 0.0) + cost
                    ok = weight < best[at]
                at = at[ok]
                best[at], size[at], via[at] = weight[ok], length, piece[ok]
        if np.isinf(best).any():
            raise ValueError(f"no path reads {words!r}"[:200])
        # Back along the paths, of all parts at once.
        on_path, at = np.zeros(len(codes), bool), np.flatnonzero(cut)
        while len(at):
            on_path[at] = True
            at = (at - size[at])[local[at] > size[at]]
        return self._written_ids(via, np.flatnonzero(on_path), last)

    def _written_ids(self, via: np.ndarray, path: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The ids that the arcs on the paths write, cut behind the last character of each word."""
        piece = via[path]
        number = np.ones(len(piece), np.int64)
        unknown = np.flatnonzero(piece >= len(self.texts))
        fallback = [self._text(p).encode() for p in piece[unknown].tolist()]
        number[unknown] = [len(f) for f in fallback]
        ids = np.repeat(piece, number)
        for at, f in zip((np.cumsum(number) - number)[unknown].tolist(), fallback, strict=True):
            ids[at : at + len(f)] = [self.byte_ids[b] for b in f]
        edges = np.append(0, np.cumsum(number))[np.searchsorted(path, last)] * 4
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(np.append(0, edges[:-1]).tolist(), edges.tolist(), strict=True)]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text; the new words of about a million characters are composed together."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                self._learn(group)
                out += map(self.encode, group)
                group, size = [], 0
        self._learn(group)
        return out + list(map(self.encode, group))

    def _learn(self, texts: list[str | None]) -> None:
        """Compose the words of texts that the cache does not have, many at once."""
        if not (self.model.dummy_prefix and self.by_space):
            return
        words = {w for t in texts if t and SPACE not in t for w in self.words.absent(t.split(" "))}
        for part in chunks((w for w in words if len(w) <= KEPT_CHARS), TOGETHER):
            for word, ids in zip(part, self.shortest_paths([SPACE + w for w in part]), strict=True):
                self.words.keep(word, ids)

    def _zero_path(self, text: str) -> list[str]:
        """The path of weight 0 in a merge model: of all arcs into a position exactly one is on it."""
        via, ids, known, lengths = [""], self.ids, self.stable.get, self.lengths
        for end in range(1, len(text) + 1):
            # Short pieces are tried first, for they are the most.
            for length in lengths.get(text[end - 2 : end], (1,)) if end > 1 else (1,):
                if length > end:
                    continue
                piece = text[end - length : end]
                if length > 1 and piece not in ids:
                    continue
                pair = (via[end - length], piece)
                stable = known(pair)
                if stable or stable is None and self._stable(pair):
                    via.append(piece)
                    break
            else:
                raise ValueError(f"no path reads {text[:end]!r}")
        return via

    def _least_path(self, text: str) -> list[str]:
        """The last arcs of the least weights to all positions in a unigram model."""
        best, via, scores = [0.0] + [np.inf] * len(text), [""] * (len(text) + 1), self.scores
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                piece = text[start:end]
                if piece in scores or end - start == 1:
                    weight = best[start] - scores.get(piece, self.worst)
                    if weight < best[end]:
                        best[end], via[end] = weight, piece
        return via

    def _shortest_path(self, text: str) -> bytes:
        """Compose a part with the machines and write the ids of the shortest path."""
        via = self._zero_path(text) if self.model.kind == BPE else self._least_path(text)
        path, end = [], len(text)
        while end:
            path.append(via[end])
            end -= len(via[end])
        ids: list[int] = []
        for piece in reversed(path):
            known = self.ids.get(piece)
            ids += [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_part(self, text: str) -> bytes:
        """Cut a part where every path must pass, and join the shortest paths."""
        out, start = [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in self.glued:
                out.append(self.lattices[text[start:i]])
                start = i
        out.append(self.lattices[text[start:]])
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; nothing for an empty text."""
        if not text:
            return b""
        if self.model.dummy_prefix and self.by_space and SPACE not in text:
            words = text.split(" ")
            if "" not in words:
                return b"".join(map(self.words.__getitem__, words))
        text = (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)
        parts = self._PARTS.findall(text) if self.by_space else [text]
        return b"".join(map(self.parts.__getitem__, parts))

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no characters become U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        data = b"".join(map(self.written.__getitem__, numbers))
        if self.model.dummy_prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode(errors="replace")


@lru_cache(maxsize=1)
def transducer(path: str) -> PieceTransducer:
    """The machines of a model file; a Python worker keeps them, with their caches, from task to task."""
    return PieceTransducer(PieceModel.load(path))


def _added(docs: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*docs.schema.fields, *fields])


def encode_pieces(
    docs: DataFrame, model_path: str, text_col: str = "text", name: str = "ids"
) -> DataFrame:
    """Add the ids of the whole text as an array of integers; other columns stay as they are.

    Null and empty texts have no ids. Rows repeated get the same ids. A column of that name is
    replaced.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_path)
        for batch in batches:
            encoded = machine.encode_all(batch.column(text_col).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])])
            flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, name])

    bounded_batches(docs.sparkSession)
    docs = docs.drop(name)
    schema = _added(docs, T.StructField(name, T.ArrayType(T.IntegerType())))
    return docs.mapInArrow(encode, schema)


def decode_pieces(
    rows: DataFrame, model_path: str, ids_col: str = "ids", name: str = "decoded"
) -> DataFrame:
    """Add the text of an array of ids; null ids give null, no ids the empty text.

    A column of that name is replaced.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_path)
        for batch in batches:
            lists = batch.column(ids_col)
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            edge = lists.offsets.to_numpy()
            found = [machine.decode(flat[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])]
            found = pa.array(found, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    bounded_batches(rows.sparkSession)
    rows = rows.drop(name)
    return rows.mapInArrow(decode, _added(rows, T.StructField(name, T.StringType())))
