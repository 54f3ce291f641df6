"""Column tags, kept in the schema metadata of a DataFrame or stored table.

Tags survive select, filter, join and a stored table; an expression over a
tagged column yields an untagged one.  Policies are therefore enforced right
after the scan, see ``operators.governance``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TAGS = "tags"


def tags_of(field: T.StructField) -> dict[str, str]:
    return dict((field.metadata or {}).get(TAGS, {}))


def set_tag(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    field = df.schema[column]
    metadata = dict(field.metadata or {})
    metadata[TAGS] = {**tags_of(field), key: value}
    return df.withMetadata(column, metadata)


def columns_with_tag(df: DataFrame, key: str, value: str) -> list[str]:
    return [f.name for f in df.schema.fields if tags_of(f).get(key) == value]


PROPERTY = "tag"


def tag_table(spark: SparkSession, name: str, column: str, key: str, value: str) -> None:
    """Tag a column of a stored table or view in its properties; no row is touched, and every session sees it."""
    if column not in spark.table(name).columns:
        raise ValueError(f"{name} has no column {column}")
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    quoted = [x.replace("\\", "\\\\").replace("'", "\\'") for x in (f"{PROPERTY}.{key}.{column}", value)]
    spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ('{quoted[0]}' = '{quoted[1]}')")


def scan_tagged(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name, with the tags of its properties on its columns."""
    df = spark.table(name)
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        kind, _, rest = row["key"].partition(".")
        key, _, column = rest.partition(".")
        if kind == PROPERTY and column in df.columns:
            df = set_tag(df, column, key, row["value"])
    return df


def tag_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per tagged column: table, column, key, value.  Reads schemas only."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (table, field.name, key, value)
        for table, df in tables.items()
        for field in df.schema.fields
        for key, value in sorted(tags_of(field).items())
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, tag_key string, tag_value string"
    )
