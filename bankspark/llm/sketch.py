"""Bit sets of a fixed size over 64-bit hashes, built on the executors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28  # 32 MB, whatever the number of keys
FETCHES = 4  # parts in which the words come to the driver


def bits_for(keys: int, per_key: int = 64, least: int = 1 << 20) -> int:
    """A power of two with room for the keys, within a fixed bound."""
    return min(MOST_BITS, max(least, 1 << (max(1, keys) * per_key - 1).bit_length()))


def _places(key: Column, bits: int) -> list[Column]:
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def bit_set(frame: DataFrame, key: str, bits: int) -> np.ndarray:
    """The set of ``key`` as words of 64 bits; keys it lacks may seem to be in it, at a small rate.

    Bits are joined per word on the executors; at most ``bits`` / 64 words come to the driver.
    """
    places = frame.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("held")
    )
    out = np.zeros(bits >> 6, dtype=np.uint64)
    for row in words.coalesce(FETCHES).toLocalIterator():
        out[row.word] = row.held & 0xFFFFFFFFFFFFFFFF
    return out


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (uint64) seem to be in the set."""
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(keys), dtype=bool)
    for place in (keys & mask, (keys >> np.uint64(32)) & mask):
        found &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return found
