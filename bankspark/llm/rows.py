"""How rows are told apart across passes, and how they are carried whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key() -> Column:
    """A hash of a document's id and text; wholly repeated rows share it."""
    return F.xxhash64("doc_id", "text")


def wrapped(docs: DataFrame, **extra: Column) -> DataFrame:
    """The rows as one column ``doc``, so that no other column can clash, with ``extra`` columns beside it."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    return docs.select(whole, *(column.alias(name) for name, column in extra.items()))


def unwrapped(frame: DataFrame, *beside: str) -> DataFrame:
    """The rows again; columns ``beside`` them take the place of theirs of the same name."""
    names = [f.name for f in frame.schema["doc"].dataType.fields if f.name.lower() not in {b.lower() for b in beside}]
    return frame.select(*(F.col("doc").getField(n).alias(n) for n in names), *beside)
