"""Numpy views of whole texts: their UTF-8 bytes, words and 64-bit hashes of byte ranges.

Everything works on a chunk: several whole texts laid end to end, about a megabyte, or one longer text
alone. Words are maximal runs of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2^64, made once in a process."""
    if len(_powers[0]) <= n:
        for i, b in enumerate((_BASE, _STEP)):
            row = np.full(max(n, CHUNK) + 1, b, _U)
            row[0] = 1
            _powers[i] = np.cumprod(row, dtype=_U)
    return _powers[0][:n + 1], _powers[1][:n + 1]


@dataclass
class Chunk:
    """``data`` holds the bytes of texts ``first`` to ``first + n - 1``; text i is data[off[i]:off[i + 1]]."""

    first: int
    data: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each word."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        blank = SPACE[self.data]
        left, right = np.empty(n, bool), np.empty(n, bool)
        left[0] = right[-1] = True
        left[1:], right[:-1] = blank[:-1], blank[1:]
        left[self.off[:-1][self.off[:-1] < n]] = True
        right[self.off[1:][self.off[1:] > 0] - 1] = True
        start = np.flatnonzero(left & ~blank)
        return start, np.flatnonzero(right & ~blank) + 1, self.text_of(start)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1

    @cached_property
    def prefix(self) -> np.ndarray:
        up, _ = powers(len(self.data))
        out = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE[self.data] * up[:-1], out=out[1:])
        return out

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[start:end]; equal bytes have equal hashes in every chunk."""
        _, down = powers(len(self.data))
        return mix((self.prefix[end] - self.prefix[start]) * down[start] + (end - start).astype(_U))

    @cached_property
    def word_hash(self) -> np.ndarray:
        start, end, _ = self.words
        return self.hashes(start, end)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each text."""
        total = np.zeros(len(self.data) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]


def columns(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[Chunk]:
    """Whole texts in chunks of about ``size`` bytes, in order."""
    data, off = columns(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield Chunk(i, data[off[i]:off[j]], off[i:j + 1] - off[i])
        i = j


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether an equal one stands earlier, and whether another one is equal at all."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return later, any_
