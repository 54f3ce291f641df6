"""Runs of letters in a column of texts, by distinct value, as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from bankspark.llm.words import LOWER, Words, pieces, utf8

LETTER_OR_BEYOND = np.zeros(256, dtype=bool)  # ASCII letters and all beyond ASCII
LETTER_OR_BEYOND[0x41:0x5B] = LETTER_OR_BEYOND[0x61:0x7B] = True
_ASCII_LETTER = LETTER_OR_BEYOND.copy()
LETTER_OR_BEYOND[0x80:] = True


def _cut(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """The maximal runs of bytes that are ``inside``; a run ends with its text."""
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def letter_runs(column: pa.Array, lower: bool = True) -> Words:
    """Runs of ASCII letters and characters beyond ASCII; with ``lower``, A-Z become a-z."""
    data, offsets = utf8(column)
    return _cut(LOWER[data] if lower else data, offsets, LETTER_OR_BEYOND[data])


def western_runs(column: pa.Array) -> Words:
    """Runs of ASCII letters and the code points C0 to FF (hex), with A-Z in lower case.

    These code points are the byte C3 and one more, and no other character has the byte C3.
    """
    data, offsets = utf8(column)
    inside = _ASCII_LETTER[data]
    lead = data == 0xC3
    inside |= lead
    if len(data):
        inside[1:] |= lead[:-1]
    return _cut(LOWER[data], offsets, inside)


def coded(words: Words) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the texts by number; some texts may be what stands between words."""
    if not len(words.starts):
        return np.empty(0, dtype=np.int64), pa.array([], pa.string())
    bounds = np.empty(2 * len(words.starts), dtype=np.int64)
    bounds[0::2], bounds[1::2] = words.starts, words.ends
    found = pieces(words.data, bounds)
    return found.indices.to_numpy()[0::2].astype(np.int64), found.dictionary
