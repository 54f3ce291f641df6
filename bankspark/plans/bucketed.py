"""Stored tables in buckets of the customer, so that joins and totals per customer need no exchange.

A bucket is read by one task, so a customer who owns more rows than a bucket should hold is kept apart, in tables
without buckets: there aggregates are combined before their shuffle and joins can be split.  Few customers can be that
large, so the list of them is small.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.operators.combine import union_all
from bankspark.sources.scratch import store
from bankspark.sources.tables import write_table

KEY = "customer_id"
BUCKETS = 64


@dataclass(frozen=True)
class CustomerTables:
    """The same tables twice: the customers of ordinary size in buckets, and the large ones."""

    bulk: Mapping[str, DataFrame]
    large: Mapping[str, DataFrame]

    def per_customer(self, job: Callable[[Mapping[str, DataFrame]], DataFrame]) -> DataFrame:
        """A job whose rows each come from the rows of one customer, over all customers."""
        return job(self.bulk).unionByName(job(self.large))


def large_customers(tables: Mapping[str, DataFrame], buckets: int) -> DataFrame:
    """Customers with more rows in a table than a bucket holds on average: at most ``buckets`` for each table."""
    found = []
    for df in tables.values():
        per_customer = df.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
        most = df.agg((F.count(F.lit(1)) / buckets).alias("most")).first()["most"]
        found.append(per_customer.filter(F.col("n") > max(1.0, most)).select(KEY))
    return union_all(found).distinct()


def store_by_customer(
    spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str, root: str | None = None, buckets: int = BUCKETS
) -> CustomerTables:
    """Write tables that have a ``customer_id``; read them back for jobs per customer."""
    large = F.broadcast(store(large_customers(tables, buckets)))
    stored: dict[str, dict[str, DataFrame]] = {"bulk": {}, "large": {}}
    for name, df in tables.items():
        parts = {"bulk": df.join(large, KEY, "left_anti"), "large": df.join(large, KEY, "left_semi")}
        for kind, part in parts.items():
            table = f"{prefix}{name}_{kind}"
            path = None if root is None else f"{root}/{table}"
            if kind == "bulk":
                write_table(part.repartition(buckets, KEY), table, path, bucket_by=(buckets, KEY))
            else:
                write_table(part, table, path)
            stored[kind][name] = spark.table(table)
    return CustomerTables(stored["bulk"], stored["large"])
