"""Silver and gold tables.

``state`` and ``region`` of the silver dimension belong to the home branch, not
to the customer's address; the feature table uses the customer's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.functions.money import avg_money, units, sum_money

LARGE_AMOUNT = 1000
TOP_SPEND = 5000


def join_customer_branch(customers: DataFrame, branches: DataFrame) -> DataFrame:
    """Each customer with its home branch; an unknown branch leaves NULLs."""
    home = branches.select(
        F.col("branch_id").alias("home_branch_id"), "branch_name", "state", "region"
    )
    return customers.drop("state", "region").join(home, "home_branch_id", "left")


def agg_accounts_per_customer(accounts: DataFrame) -> DataFrame:
    """Accounts and signed balance per customer; every status counts."""
    return accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("products_held"),
        sum_money("balance_myr").alias("total_balance_myr"),
    )


def agg_avg_balance_per_customer(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("customer_id").agg(avg_money("balance_myr").alias("avg_balance_myr"))


def silver_customer_dim(
    customers: DataFrame,
    branches: DataFrame,
    accounts: DataFrame,
    with_join_date: bool = False,
    with_has_balance: bool = False,
) -> DataFrame:
    """One row per customer.  Without accounts the count is 0 and the balance NULL."""
    columns = [
        "customer_id", "name", "age", "segment", "income_band", "branch_name", "state", "region",
        F.coalesce("products_held", F.lit(0)).alias("products_held"),
        "total_balance_myr",
    ]
    if with_join_date:
        columns.append("join_date")
    if with_has_balance:
        columns.append((F.col("total_balance_myr") > 0).alias("has_balance"))
    return (
        join_customer_branch(customers, branches)
        .join(agg_accounts_per_customer(accounts), "customer_id", "left")
        .select(*columns)
    )


def silver_transactions(
    transactions: DataFrame,
    with_is_large: bool = False,
    with_dayname: bool = False,
) -> DataFrame:
    """Transactions with a positive amount, a real date and the month they fall in."""
    day = F.to_date("txn_date")
    columns = [
        "txn_id", "customer_id", "amount_myr", "channel", "category", "merchant",
        day.alias("txn_date"),
        F.date_trunc("month", day).alias("txn_month"),
    ]
    if with_is_large:
        columns.append((F.col("amount_myr") > LARGE_AMOUNT).alias("is_large"))
    if with_dayname:
        columns.append(F.date_format(day, "EEEE").alias("txn_weekday"))
    return transactions.filter(F.col("amount_myr") > 0).select(*columns)


def agg_txn_per_customer(silver_txn: DataFrame) -> DataFrame:
    return silver_txn.groupBy("customer_id").agg(
        F.count("txn_id").alias("txn_count"),
        sum_money("amount_myr").alias("total_spend_myr"),
        avg_money("amount_myr").alias("avg_txn_myr"),
        F.max("txn_date").alias("last_txn_date"),
    )


def gold_customer_360(dim: DataFrame, silver_txn: DataFrame, with_spend_per_product: bool = False) -> DataFrame:
    """The customer dimension with a spend summary; customers without transactions keep NULLs.

    Transactions are aggregated before the join, so accounts and transactions
    never multiply each other and a busy customer costs one row in the join.
    """
    gold = dim.join(agg_txn_per_customer(silver_txn), "customer_id", "left")
    if with_spend_per_product:
        gold = gold.withColumn(
            "spend_per_product",
            F.col("total_spend_myr") / F.nullif(F.col("products_held"), F.lit(0)),
        )
    return gold


def gold_top_customers(gold: DataFrame, above: float = TOP_SPEND) -> DataFrame:
    return gold.filter(F.col("total_spend_myr") > above)


def topk_gold_spend(gold: DataFrame, n: int = 10) -> DataFrame:
    """The biggest spenders; equal spend is ordered by customer id."""
    return gold.orderBy(F.desc_nulls_last("total_spend_myr"), "customer_id").limit(n)


def spend_in_units(transactions: DataFrame, *dims: str) -> DataFrame:
    """Transaction units (see ``functions.money``) and counts per customer and further columns: the form joins should take."""
    in_units = units("amount_myr")
    return transactions.groupBy("customer_id", *dims).agg(
        F.sum(in_units).alias("spend_units"), F.count(in_units).alias("txns")
    )
