"""Tokenising and small parsers over document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE_PATTERN = r"([0-9]+(?:\.[0-9]+)?)\s*% per annum"
AMOUNT_PATTERN = r"RM([0-9][0-9,]*(?:\.[0-9]+)?)"


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order, of the whole text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def words(text: Column | str) -> Column:
    """Blank-separated words, in order, of the whole text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(text, r"[ \t\n\r]+"), "")


def rate_pct(value: Column | str) -> Column:
    """The number before the first '% per annum', NULL when there is none."""
    value = F.col(value) if isinstance(value, str) else value
    found = F.regexp_extract(value, RATE_PATTERN, 1)
    return F.nullif(found, F.lit("")).cast("double")


def amount_myr(value: Column | str) -> Column:
    """The first 'RM1,000' style amount as a number, NULL when there is none."""
    value = F.col(value) if isinstance(value, str) else value
    found = F.regexp_extract(value, AMOUNT_PATTERN, 1)
    return F.nullif(F.replace(found, F.lit(","), F.lit("")), F.lit("")).cast("double")
