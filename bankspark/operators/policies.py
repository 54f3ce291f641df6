"""Policies that hold without the caller's help: kept as a table, applied by generated views.

Who reads the view's name gets what the user of the session may see.  A policy names a tag, not a column: after a
column is tagged or a policy added, ``protect`` writes the view anew, without new code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bankspark.operators.governance import TEAM_PREFIX, MaskPolicy, Policy
from bankspark.schemas import MASKED
from bankspark.sources.tags import columns_with_tag, scan_tagged

POLICY_SCHEMA = "policy string, kind string, tag_key string, tag_value string"
MASK, ROWS = "mask", "row_filter"


def policy_rows(spark: SparkSession, policies: Sequence[Policy]) -> DataFrame:
    """Policies as a table: (policy, kind, tag_key, tag_value)."""
    kind = lambda p: MASK if isinstance(p, MaskPolicy) else ROWS
    return spark.createDataFrame([(p.name, kind(p), p.tag_key, p.tag_value) for p in policies], POLICY_SCHEMA)


def protect(spark: SparkSession, base: str, view: str, policies: str, members: str) -> None:
    """Write the view of a base table: its columns masked and its rows filtered as its tags and the policies ask.

    ``policies`` names the table of policies and ``members`` that of groups (principal string, group_name).  A row
    filter looks the groups of ``current_user()`` up when the view is read; it sees the raw values.
    """
    tagged = scan_tagged(spark, base)
    masked, filtered = set(), set()
    for rule in spark.table(policies).collect():
        columns = columns_with_tag(tagged, rule["tag_key"], rule["tag_value"])
        (masked if rule["kind"] == MASK else filtered).update(columns)
    if len(filtered) > 1:
        raise ValueError(f"more than one row filter matches {base}: {', '.join(sorted(filtered))}")
    for column in masked:
        if not isinstance(tagged.schema[column].dataType, T.StringType):
            raise TypeError(f"only text can be masked, {column} is {tagged.schema[column].dataType}")
    listed = ", ".join(f"'{MASKED}' AS `{c}`" if c in masked else f"b.`{c}`" for c in tagged.columns)
    where = "".join(
        f" WHERE concat('{TEAM_PREFIX}', lower(replace(b.`{c}`, ' ', '_')))"
        f" IN (SELECT group_name FROM {members} WHERE principal = current_user())"
        for c in filtered
    )
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {base} b{where}")
