"""Column masks and row filters, driven by column tags.

``enforce`` belongs right after the scan: it filters on the raw values, masks,
and only then hands the frame on, so whatever a job derives from a protected
column is derived from the masked one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark.schemas import MASKED
from bankspark.sources.tags import columns_with_tag

TEAM_PREFIX = "team_"


@dataclass(frozen=True)
class MaskPolicy:
    """Mask every column that carries the tag."""

    name: str
    tag_key: str = "pii"
    tag_value: str = "true"


@dataclass(frozen=True)
class RowFilterPolicy:
    """Keep rows whose tagged region belongs to one of the reader's groups."""

    name: str
    tag_key: str = "region_filter"
    tag_value: str = "true"


Policy = MaskPolicy | RowFilterPolicy


def mask_value() -> Column:
    """The mask ignores its input, so NULL turns into the literal as well."""
    return F.lit(MASKED)


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for column in columns:
        if not isinstance(df.schema[column].dataType, T.StringType):
            raise TypeError(f"only text can be masked, {column} is {df.schema[column].dataType}")
    return df.withColumns({
        c: mask_value().alias(c, metadata=df.schema[c].metadata) for c in columns
    }) if columns else df


def mask_by_tag(df: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    tagged = {
        column: None
        for policy in policies
        if isinstance(policy, MaskPolicy)
        for column in columns_with_tag(df, policy.tag_key, policy.tag_value)
    }
    return mask_columns(df, list(tagged))


def region_group(region: Column | str) -> Column:
    """'East Coast' -> 'team_east_coast'."""
    region = F.col(region) if isinstance(region, str) else region
    return F.concat(F.lit(TEAM_PREFIX), F.lower(F.replace(region, F.lit(" "), F.lit("_"))))


def groups_of(group_members: DataFrame, principal: int) -> DataFrame:
    return (
        group_members.filter((F.col("principal") == principal) & F.col("group_name").isNotNull())
        .select(F.col("group_name").alias("_group"))
        .distinct()
    )


def register_functions(spark: SparkSession, group_members: DataFrame, principal: int) -> None:
    """The mask and the row filter for SQL text: ``mask_pii(text)`` and ``filter_by_region(region)``.

    Both are temporary SQL functions of the session.  The row filter looks the
    reader's groups up when a statement runs; Spark makes a semi-join of it.
    """
    groups_of(group_members, principal).createOrReplaceTempView("reader_groups")
    group = f"concat('{TEAM_PREFIX}', lower(replace(region, ' ', '_')))"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_pii(input_value STRING) RETURNS STRING "
        f"RETURN '{MASKED}'"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION filter_by_region(region STRING) RETURNS BOOLEAN "
        f"RETURN {group} IN (SELECT _group FROM reader_groups)"
    )


def filter_rows(df: DataFrame, region_column: str, group_members: DataFrame, principal: int) -> DataFrame:
    """Rows whose region team the principal belongs to, by a semi-join with the principal's groups.

    A NULL region matches no group, and a reader in no group sees no row.
    """
    own = groups_of(group_members, principal)
    return df.join(own, region_group(region_column) == F.col("_group"), "left_semi")


def enforce(df: DataFrame, policies: Sequence[Policy], group_members: DataFrame, principal: int) -> DataFrame:
    """What the principal may see of a table: row filter on raw values, then masks."""
    filters = [
        (policy, column)
        for policy in policies
        if isinstance(policy, RowFilterPolicy)
        for column in columns_with_tag(df, policy.tag_key, policy.tag_value)
    ]
    if len(filters) > 1:
        names = sorted({policy.name for policy, _ in filters})
        raise ValueError(f"more than one row filter matches the table: {', '.join(names)}")
    for _, column in filters:
        df = filter_rows(df, column, group_members, principal)
    return mask_by_tag(df, policies)


def group_coverage(principals: DataFrame, group_members: DataFrame) -> DataFrame:
    """Principals that are in no region team or in more than one, with the number of teams."""
    teams = (
        group_members.filter(F.col("group_name").startswith(TEAM_PREFIX))
        .groupBy("principal")
        .agg(F.count_distinct("group_name").alias("n"))
    )
    return (
        principals.join(teams, "principal", "left")
        .select("principal", F.coalesce("n", F.lit(0)).alias("region_groups"))
        .filter(F.col("region_groups") != 1)
    )


def branch_visibility(branches: DataFrame) -> DataFrame:
    """Branches that each region team can see."""
    return (
        branches.filter(F.col("region").isNotNull())
        .groupBy(region_group("region").alias("group_name"))
        .agg(F.count(F.lit(1)).alias("branches"))
    )
