"""Mergeable states of checks: what a report needs of each stored part, kept so that old parts need not be read again.

A part's state holds how many rows break each rule, its row count, the range of its keys and how many keys repeat
within it.  Rules and counts of parts add up.  Keys are unique overall if they are in every part and the ranges do not
meet; only parts whose ranges meet are read again, and of these only the key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankspark.operators.combine import union_all

STATE_COLUMNS = ["table_name", "part", "row_count", "least", "most", "repeated", "broken"]
#: Reads the rows (part, key) of some parts of a table.
ReadKeys = Callable[[str, Sequence[str]], DataFrame]


def part_states(df: DataFrame, table: str, part: Column, rules: Mapping[str, Column], key: str) -> DataFrame:
    """The states (``STATE_COLUMNS``) of all parts of a frame: one pass for the rules, one count of keys."""
    parted = df.withColumn("_part", part.cast("string"))
    checks = list(rules)
    counted = parted.groupBy("_part").agg(
        F.count(F.lit(1)).alias("row_count"), F.min(key).cast("string").alias("least"), F.max(key).cast("string").alias("most"),
        *(F.count_if(rules[c]).alias(f"_rule_{i}") for i, c in enumerate(checks)),
    )
    per_key = parted.groupBy("_part", F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = per_key.groupBy("_part").agg(F.count(F.lit(1)).alias("repeated"))
    broken = F.array(*(
        F.struct(F.lit(c).alias("check_name"), F.col(f"_rule_{i}").alias("violations")) for i, c in enumerate(checks)
    )) if checks else F.array().cast("array<struct<check_name: string, violations: bigint>>")
    return counted.join(repeats, counted["_part"].eqNullSafe(repeats["_part"]), "left").select(
        F.lit(table).alias("table_name"), counted["_part"].alias("part"), "row_count", "least", "most",
        F.coalesce("repeated", F.lit(0)).alias("repeated"), broken.alias("broken"),
    )


def _groups(states: DataFrame) -> DataFrame:
    """Parts with the number of their group: ranges of a group meet, those of different groups do not."""
    by_range = Window.partitionBy("table_name").orderBy(F.col("least").asc_nulls_first(), "most", "part")
    earlier = F.max("most").over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("least") <= earlier, 0).otherwise(1)
    return states.withColumn("opens", opens).withColumn("group", F.sum("opens").over(by_range))


def report(states: DataFrame, keys: Mapping[str, str], read_keys: ReadKeys) -> DataFrame:
    """(check_name, table_name, violations) over all parts: the rules, and ``pk_unique`` for the tables in ``keys``.

    ``read_keys`` is asked for the parts whose key ranges meet, and for nothing else.
    """
    rules = states.select("table_name", F.inline("broken")).groupBy("check_name", "table_name").agg(
        F.sum("violations").alias("violations")
    )
    grouped = _groups(states.filter(F.col("table_name").isin(list(keys))))
    per_group = grouped.groupBy("table_name", "group").agg(F.count(F.lit(1)).alias("parts"), F.sum("repeated").alias("repeated"))
    found = [per_group.filter("parts = 1").groupBy("table_name").agg(F.sum("repeated").alias("violations"))]
    met = grouped.join(per_group.filter("parts > 1").select("table_name", "group"), ["table_name", "group"])
    parts: dict[str, list[str]] = {}
    for row in met.select("table_name", "part").collect():  # names of parts
        parts.setdefault(row["table_name"], []).append(row["part"])
    for table, names in parts.items():
        per_key = read_keys(table, names).groupBy(keys[table]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found.append(per_key.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(table).alias("table_name"), "violations"))
    unique = union_all(found).groupBy("table_name").agg(F.sum("violations").alias("violations")).select(
        F.lit("pk_unique").alias("check_name"), "table_name", "violations"
    )
    return rules.unionByName(unique)


def row_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
