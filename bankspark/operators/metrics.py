"""Exploration, dashboard and analyst-question datasets.

Aggregates that need customer attributes first add up the transactions per
customer (a map-side combine) and join the result, one small row per customer
and dimension value.  A customer that owns a third of all transactions is then
no heavier in the join than any other.  Only ``dash_dataset``, which returns
the transactions themselves, joins row by row, and it salts the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.functions.money import avg_money, avg_of_units, units, from_units, half_up, sum_money
from bankspark.operators.combine import splittable_join
from bankspark.operators.medallion import spend_in_units
from bankspark.schemas import INCOME_BANDS, SEGMENTS

# The two channels of the analyst term "digital customer", which
# differs from the three channels of the engagement score.
DIGITAL_CUSTOMER_CHANNELS = ["Mobile App", "Internet Banking"]
FINANCING = "Financing"


# Exploration


def agg_segment_profile(customers: DataFrame) -> DataFrame:
    """Customers and average age, one decimal, per segment."""
    avg_age = half_up(F.sum("age") * 10, F.count("age")) / F.lit(10.0)
    return (
        customers.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"), avg_age.alias("avg_age"))
        .orderBy(F.desc("customers"), "segment")
    )


def agg_spend_by_category(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("category")
        .agg(sum_money("amount_myr").alias("total_amount"), F.count(F.lit(1)).alias("txns"))
        .orderBy(F.desc("total_amount"), "category")
    )


def join_spend_by_segment(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Total spend per segment, over customers that have transactions."""
    per_customer = spend_in_units(transactions)
    return (
        customers.select("customer_id", "segment")
        .join(per_customer, "customer_id")
        .groupBy("segment")
        .agg(from_units(F.sum("spend_units")).alias("total_spend"))
    )


def agg_segment_spend(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Total spend, distinct customers and spend per customer for each segment."""
    per_customer = spend_in_units(transactions)
    spend, buyers = F.sum("spend_units"), F.count("customer_id")  # one row per customer
    return (
        customers.select("customer_id", "segment")
        .join(per_customer, "customer_id")
        .groupBy("segment")
        .agg(
            from_units(spend).alias("total_spend"),
            buyers.alias("customers"),
            avg_of_units(spend, buyers).alias("spend_per_customer"),
        )
        .orderBy(F.desc("total_spend"), "segment")
    )


def eda_age_filter_by_segment(customers: DataFrame, older_than: int = 30) -> DataFrame:
    return (
        customers.filter(F.col("age") > older_than)
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("cust"))
        .orderBy(F.desc("cust"), "segment")
    )


def agg_channel_stats(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("channel")
        .agg(avg_money("amount_myr").alias("avg_txn"), F.count(F.lit(1)).alias("txns"))
        .orderBy(F.desc("txns"), "channel")
    )


# Dashboard


def dash_dataset(gold: DataFrame, transactions: DataFrame) -> DataFrame:
    """Each transaction of a known customer with that customer's profile."""
    profile = gold.select(
        "customer_id", "segment", "state", "region",
        "products_held", "total_balance_myr", "total_spend_myr",
    )
    facts = transactions.select("txn_id", "customer_id", "category", "channel", "amount_myr", "txn_date")
    return splittable_join(facts, profile, "customer_id").select(
        *profile.columns, "category", "channel", "amount_myr", "txn_date"
    )


def apply_filters(df: DataFrame, chosen: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep rows that match every filter widget; an empty choice does not filter."""
    for column, values in chosen.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def _charted(gold: DataFrame, transactions: DataFrame, profile: str | None, *dims: str) -> DataFrame:
    members = gold.select("customer_id", *([profile] if profile else []))
    return members.join(spend_in_units(transactions, *dims), "customer_id")


def dash_spend_by_category(gold: DataFrame, transactions: DataFrame) -> DataFrame:
    return (
        _charted(gold, transactions, None, "category")
        .groupBy("category")
        .agg(from_units(F.sum("spend_units")).alias("total_amount"))
    )


def dash_customers_by_state(gold: DataFrame, transactions: DataFrame) -> DataFrame:
    return (
        _charted(gold, transactions, "state")
        .groupBy("state")
        .agg(
            F.count("customer_id").alias("customers"),  # one row per customer
            from_units(F.sum("spend_units")).alias("total_amount"),
        )
    )


def dash_spend_by_month(gold: DataFrame, transactions: DataFrame) -> DataFrame:
    monthly = transactions.withColumn("txn_month", F.date_trunc("month", "txn_date"))
    return (
        _charted(gold, monthly, None, "txn_month")
        .groupBy("txn_month")
        .agg(from_units(F.sum("spend_units")).alias("total_amount"))
        .orderBy("txn_month")
    )


def dash_avg_txn_by_channel(gold: DataFrame, transactions: DataFrame) -> DataFrame:
    return (
        _charted(gold, transactions, None, "channel")
        .groupBy("channel")
        .agg(avg_of_units(F.sum("spend_units"), F.sum("txns")).alias("avg_amount"))
    )


def dash_kpis(gold: DataFrame) -> DataFrame:
    """The number tiles, over customers: the transaction dataset would count balances many times."""
    return gold.agg(
        F.count(F.lit(1)).alias("customers"),
        sum_money("total_spend_myr").alias("total_spend"),
        avg_money("total_balance_myr").alias("avg_balance"),
        F.sum("products_held").alias("products_held"),
    )


# Analyst questions


def qa_customers_in_state(gold: DataFrame, state: str) -> DataFrame:
    return gold.filter(F.col("state") == state).agg(F.count(F.lit(1)).alias("customers"))


def qa_customers_by_state(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("state")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "state")
    )


def qa_certified_values(gold: DataFrame) -> DataFrame:
    """Customers per segment and income band, within the stated values."""
    return (
        gold.filter(F.col("segment").isin(SEGMENTS) & F.col("income_band").isin(INCOME_BANDS))
        .groupBy("segment", "income_band")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def qa_top_segment_avg_spend(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("segment")
        .agg(avg_money("total_spend_myr").alias("avg_total_spend"))
        .orderBy(F.desc_nulls_last("avg_total_spend"), "segment")
        .limit(1)
    )


def qa_top_segment_total_spend(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("segment")
        .agg(sum_money("total_spend_myr").alias("total_spend"))
        .orderBy(F.desc_nulls_last("total_spend"), "segment")
        .limit(1)
    )


def qa_avg_balance_by_segment(gold: DataFrame) -> DataFrame:
    return gold.groupBy("segment").agg(avg_money("total_balance_myr").alias("avg_balance"))


def qa_compare_segments(gold: DataFrame, first: str, second: str) -> DataFrame:
    return (
        gold.filter(F.col("segment").isin(first, second))
        .groupBy("segment")
        .agg(sum_money("total_spend_myr").alias("total_spend"))
    )


def qa_avg_balance_by_product_type(accounts: DataFrame, products: DataFrame) -> DataFrame:
    """Average balance by product type; accounts are added up per product before the join."""
    in_units = units("balance_myr")
    per_product = accounts.groupBy("product_id").agg(
        F.sum(in_units).alias("balance_units"), F.count(in_units).alias("accounts")
    )
    return (
        per_product.join(products.select("product_id", "product_type"), "product_id")
        .groupBy("product_type")
        .agg(avg_of_units(F.sum("balance_units"), F.sum("accounts")).alias("avg_balance"))
    )


def qa_spend_segment_category(gold: DataFrame, transactions: DataFrame, category: str) -> DataFrame:
    """Spend on one category by segment, highest first."""
    return (
        _charted(gold, transactions.filter(F.col("category") == category), "segment")
        .groupBy("segment")
        .agg(from_units(F.sum("spend_units")).alias("total_amount"))
        .orderBy(F.desc("total_amount"), "segment")
    )


def qa_digital_customers(transactions: DataFrame) -> DataFrame:
    """How many customers make more than half of their transactions on the two digital channels."""
    digital = F.count_if(F.col("channel").isin(DIGITAL_CUSTOMER_CHANNELS))
    return (
        transactions.groupBy("customer_id")
        .agg(digital.alias("digital"), F.count(F.lit(1)).alias("txns"))
        .filter(F.col("digital") * 2 > F.col("txns"))
        .agg(F.count(F.lit(1)).alias("digital_customers"))
    )


def qa_segment_fewest_financing(customers: DataFrame, accounts: DataFrame, products: DataFrame) -> DataFrame:
    """The segment with the fewest financing accounts; a segment without any counts as 0."""
    financing = products.filter(F.col("product_type") == FINANCING).select("product_id")
    held = (
        accounts.groupBy("customer_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(financing, "product_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.sum("n").alias("n"))
    )
    return (
        customers.select("customer_id", "segment")
        .join(held, "customer_id", "left")
        .groupBy("segment")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("financing_accounts"))
        .orderBy("financing_accounts", "segment")
        .limit(1)
    )


def offer_segment_action(features: DataFrame, products: DataFrame) -> DataFrame:
    """Per segment: total spend and the financing product offered most often.

    Equal counts go to the offer that is last by name; a segment without any
    financing offer keeps NULL.
    """
    financing = (
        products.filter(F.col("product_type") == FINANCING)
        .select(F.col("product_name").alias("next_best_offer"), F.lit(True).alias("is_financing"))
    )
    per_offer = features.groupBy("segment", "next_best_offer").agg(
        F.count(F.lit(1)).alias("n"), F.sum(units("total_spend")).alias("spend_units")
    )
    ranked = F.when(F.col("is_financing"), F.struct("n", "next_best_offer"))
    return (
        per_offer.join(financing, "next_best_offer", "left")
        .groupBy("segment")
        .agg(
            from_units(F.sum("spend_units")).alias("total_spend"),
            F.max(ranked).alias("best"),
        )
        .select(
            "segment", "total_spend",
            F.col("best.next_best_offer").alias("top_offer"),
            F.col("best.n").alias("offered_to"),
        )
        .orderBy(F.desc("total_spend"), "segment")
    )
