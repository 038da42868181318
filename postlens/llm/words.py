"""Words of a batch of texts as 64-bit hashes, without a Python object per word.

A batch's UTF-8 bytes are looked at as one array. A word's hash is a difference of running sums of a polynomial over
its bytes (modulo 2**64, odd base), so the cost is a few array passes whatever the lengths; runs of words are hashed
the same way from the hashes of the words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


class Words(NamedTuple):
    """Words of a batch: `hashes` in text order, those of text i between `first[i]` and `first[i + 1]`."""

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as far as batches need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", self.base), ("down", self.inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Running sums of value * base ** position, with a 0 in front."""
        if len(values) >= len(self.up):
            self._grow(len(values))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.multiply(values, self.up[: len(values)], out=out[1:])
        np.cumsum(out, out=out)
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Polynomial hash of each range, independent of where it starts."""
        return (sums[ends] - sums[starts]) * self.down[starts]


_bytes, _words = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column and the offset of each text in them; NULL has none."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array, lower: bool, separators: np.ndarray = WHITE) -> Words:
    """Words between separators (by default white space, [\\x20\\x09-\\x0D]) of each text; `lower` folds A-Z first."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = mix(_bytes.between(_bytes.sums(_BYTE_VALUES[data]), starts, ends) ^ (ends - starts).astype(np.uint64))
    return Words(hashes, np.searchsorted(starts, offsets), data, starts, ends)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` consecutive words; one for every position where a run fits in the array."""
    if len(hashes) < length:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(len(hashes) - length + 1)
    return mix(_words.between(_words.sums(hashes), starts, starts + length))


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words of each range [start, end)."""
    return mix(_words.between(_words.sums(hashes), starts, ends) ^ (ends - starts).astype(np.uint64))
