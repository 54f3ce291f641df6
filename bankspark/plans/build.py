"""Build the silver, gold and feature tables from the bronze ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from bankspark.operators import features as E
from bankspark.operators import medallion as M
from bankspark.sources.tables import create_or_replace


def build_tables(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    as_of: dt.date,
    root: str | None = None,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Store each table and build the next one from what is stored, so nothing is computed twice.

    ``bronze`` holds customers, accounts, transactions and branches; pass frames
    that went through ``governance.enforce`` to build what one reader may see.
    ``root`` places the tables below that folder instead of the warehouse.
    """

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = None if root is None else f"{root}/{prefix}{name}"
        return create_or_replace(spark, prefix + name, df, path)

    customers, accounts, transactions = bronze["customers"], bronze["accounts"], bronze["transactions"]
    dim = stored("silver_customer_dim", M.silver_customer_dim(customers, bronze["branches"], accounts))
    txn = stored("silver_transactions", M.silver_transactions(transactions))
    gold = stored("gold_customer_360", M.gold_customer_360(dim, txn))
    return {
        "silver_customer_dim": dim,
        "silver_transactions": txn,
        "gold_customer_360": gold,
        "gold_top_customers": stored("gold_top_customers", M.gold_top_customers(gold)),
        "customer_360_features": stored(
            "customer_360_features", E.customer_360_features(customers, accounts, transactions, as_of)
        ),
    }
