"""Hashes of the words in a buffer of bytes, vectorised."""

from __future__ import annotations

import numpy as np

#: Odd, so that it has an inverse modulo 2^64.
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spaces_of(raw: np.ndarray) -> np.ndarray:
    """Where U+0020 and U+0009 to U+000D are."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread unsigned 64-bit integers over all bits; different values stay different."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class WordHasher:
    """Polynomial hashes of words, as differences of one running sum over the buffer."""

    def __init__(self) -> None:
        self.power, self.inverse = _powers(_BASE, 2), _powers(_INVERSE, 2)

    def __call__(self, raw: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The starts of the words and their hashes; the buffer begins and ends with white space."""
        if len(raw) >= len(self.power):
            self.power, self.inverse = _powers(_BASE, len(raw) + 1), _powers(_INVERSE, len(raw) + 1)
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edge[0::2], edge[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        code = raw.astype(np.uint64) + np.uint64(1)
        np.cumsum(code * self.power[: len(raw)], out=total[1:])
        return starts, (total[ends] - total[starts]) * self.inverse[starts]
