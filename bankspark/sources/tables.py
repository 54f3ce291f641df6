"""Managed and path-based tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark.sources.files import REJECTED, read_csv, read_csv_with_rejects


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A table by its one-, two- or three-part name."""
    return spark.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to SQL text under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Replace a table together with its schema."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def attach(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Give existing files a table name; no row is read or copied."""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{place}'")
    return spark.table(name)


def create_or_replace(spark: SparkSession, name: str, query: DataFrame, path: str | None = None) -> DataFrame:
    """Store the result of a query as a table and return the stored table."""
    write_table(query, name, path)
    return spark.table(name)


def write_counted(df: DataFrame, name: str, path: str | None = None, rejects: str | None = None) -> tuple[int, int]:
    """Write a table; returns the rows written and rejected, counted while they pass to the writer.

    Rows with a text in ``REJECTED`` do not belong to the table: they are left out, and kept whole in a table of the
    name ``rejects`` if there are any.
    """
    seen = Observation()
    bad = F.col(REJECTED).isNotNull() if REJECTED in df.columns else F.lit(False)
    counted = df.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    write_table(counted.filter(~bad).drop(REJECTED), name, path)
    rows, rejected = seen.get["rows"], seen.get["rejected"]
    if rejected and rejects:
        write_table(df.filter(bad), rejects, None if path is None else f"{path}_rejected")
    return rows, rejected


def ingest(
    spark: SparkSession,
    files: Mapping[str, str],
    schemas: Mapping[str, T.StructType] | None = None,
    root: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """Load a table-name -> CSV-path map; returns (table_name, rows, rejected), one pass over each file.

    With a declared schema, a line with a cell that is not of its type, or with too few or too many cells, is rejected:
    it goes to the table's ``_rejected`` companion, which a second pass over that file writes.
    ``root`` places each table below that folder instead of the warehouse and
    ``prefix`` goes in front of the stored table names.
    """
    counts = []
    for table, path in files.items():
        schema = (schemas or {}).get(table)
        df = read_csv(spark, path) if schema is None else read_csv_with_rejects(spark, path, schema)
        name = prefix + table
        counts.append((table, *write_counted(df, name, None if root is None else f"{root}/{name}", f"{name}_rejected")))
    return spark.createDataFrame(counts, "table_name string, rows bigint, rejected bigint")


def comment_on(spark: SparkSession, name: str, text: str) -> None:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{escaped}'")


def comment_of(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).description
