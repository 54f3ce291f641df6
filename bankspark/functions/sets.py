from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 63  # of a BIGINT that are used


def count_distinct_known(column: str, known: Sequence[str]) -> Column:
    """Exact distinct count of a column whose values mostly come from a list.

    Each listed value is one bit of a BIGINT (of several, for a longer list), so
    rows collapse to one per group before the shuffle instead of one per group
    and value.  Values off the list are gathered in a set beside the bits, so
    that no second shuffle by value is planned.
    """
    count = F.size(F.collect_set(F.when(~F.col(column).isin(list(known)), F.col(column)))).cast("bigint")
    for start in range(0, len(known), BITS):
        bit = F.lit(None).cast("bigint")
        for position, value in enumerate(known[start : start + BITS]):
            bit = F.when(F.col(column) == value, F.lit(1 << position).cast("bigint")).otherwise(bit)
        count = count + F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0))
    return count
