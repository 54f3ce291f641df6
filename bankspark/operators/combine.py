"""Joins for hot keys; unions.

No operator forces a broadcast on a table that grows: Spark broadcasts a side
on its own when its size allows it, before the run or during it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(big: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Inner join of a large frame, in which one key may own much of the rows, to one with few rows per key.

    Adaptive execution splits the tasks of a hot key, but only where both sides
    get an exchange for the join.  A side that is already placed by the key, as
    an aggregate is, would get none; a second key column, always 0, sees to it.
    """
    second = F.pmod(F.xxhash64(key), F.lit(1))
    return big.withColumn("_zero", second).join(other.withColumn("_zero", second), [key, "_zero"]).drop("_zero")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
