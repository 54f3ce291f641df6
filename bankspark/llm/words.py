"""Words, hashes and pieces of a column of texts, as arrays.

A column of texts in Arrow form is one run of UTF-8 bytes.  Words are told from
blanks by a table over the 256 byte values, which is exact for classes in
which all bytes from 0x80 on fall on the same side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # of text worked on at once; a longer text is a slice of its own
PIECE_BYTES = 1 << 20  # of text hashed at once
BLANKS = bytes([0x20, *range(0x09, 0x0E)])

NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[list(BLANKS)] = False

ALPHANUMERIC = np.zeros(256, dtype=bool)  # digits, lower-case a-z and all beyond ASCII
for _low, _high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    ALPHANUMERIC[_low : _high + 1] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power_table(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        table = np.full(max(n, PIECE_BYTES + 1), _BASE if kind == "up" else _INVERSE, dtype=np.uint64)
        table[0] = 1
        table = np.cumprod(table)
        if n > PIECE_BYTES + 1:  # an odd giant word: not kept
            return table
        _powers[kind] = table
    return _powers[kind]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take at most ``limit`` bytes, or are a single longer text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (and the last ends); NULL is empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts: byte spans, the number of words before each text, and 64-bit hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            low = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, low + PIECE_BYTES, side="right")))
            high = self.ends[j - 1]
            n = int(high - low)
            sums = np.empty(n + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE_VALUE[self.data[low:high]] * _power_table("up", n)[:n], out=sums[1:])
            a, b = self.starts[i:j] - low, self.ends[i:j] - low
            out[i:j] = mixed((sums[b] - sums[a]) * _power_table("down", n)[a] + (b - a).astype(np.uint64) * _STEP)
            i = j
        return out


def words_of(column: pa.Array, is_word: np.ndarray, lower: bool) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbours (runs across texts included)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total, factor = np.zeros(n, dtype=np.uint64), 1
    for k in range(size):
        total += hashes[k : k + n] * _U(factor)
        factor = factor * int(_STEP) % (1 << 64)
    return mixed(total + _U(size))


_KIND = np.zeros(256, dtype=np.uint8)  # 0: blank or beyond ASCII, 1: letter, 2: digit, 3: sign
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1


def kind_cuts(data: np.ndarray) -> np.ndarray:
    """Whether letters, digits and signs meet before each byte but the first.

    Letters are those of ASCII and of the code points C0 to FF (hex).  An
    apostrophe is not parted from a letter after it, nor anything from a
    character whose kind is not told here.
    """
    kind = _KIND[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    at = at[(data[at + 1] != 0x97) & (data[at + 1] != 0xB7)]
    kind[at] = kind[at + 1] = 1
    before, here = kind[:-1], kind[1:]
    return (before != here) & (before > 0) & (here > 0) & ~((data[:-1] == 0x27) & (here == 1))


def pieces(data: np.ndarray, boundaries: np.ndarray) -> pa.DictionaryArray:
    """The texts between neighbouring boundaries (the first 0, the last the end), by distinct value."""
    offsets = boundaries.astype(np.int32) if len(data) < 1 << 31 else boundaries
    kind = pa.string() if offsets.dtype == np.int32 else pa.large_string()
    array = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return array.dictionary_encode()
