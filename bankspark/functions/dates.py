from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_months(later: dt.date | Column, earlier: Column | str) -> Column:
    """Months from ``earlier`` to ``later``, truncated toward zero (a future date gives a negative count)."""
    later = later if isinstance(later, Column) else F.lit(later)
    return F.months_between(later, earlier).cast("int")
