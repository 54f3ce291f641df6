"""The customer feature table and its rule-based next best offer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.functions.dates import whole_months
from bankspark.functions.money import avg_money, units, from_units, ratio2, sum_money
from bankspark.functions.sets import count_distinct_known
from bankspark.schemas import CATEGORIES, INCOME_BANDS

# The channels that count as digital in the engagement score, and
# the product behind each holding flag.
DIGITAL_CHANNELS = ["Mobile App", "Internet Banking", "QR Pay"]
FLAG_PRODUCTS = {
    "has_home": "P05",
    "has_vehicle": "P06",
    "has_personal": "P04",
    "has_term_deposit": "P02",
    "has_card": "P10",
    "has_investment": "P11",
}
NO_OFFER = "None"

FEATURE_COLUMNS = [
    "customer_id", "age", "gender", "state", "region", "segment", "income_band", "tenure_months",
    "num_products_held", "total_balance", *FLAG_PRODUCTS, "txn_count_90d", "avg_txn_amount",
    "total_spend", "category_variety", "digital_engagement_score", "income_rank", "next_best_offer",
]


def feat_txn(transactions: DataFrame, as_of: dt.date | None = None, window_days: int | None = None) -> DataFrame:
    """Spend behaviour per customer.

    ``txn_count_90d`` counts every transaction, as its definition has no date
    condition; pass ``window_days`` and ``as_of`` for a true window.
    """
    if window_days is not None:
        if as_of is None:
            raise ValueError("window_days needs as_of")
        first = as_of - dt.timedelta(days=window_days)
        transactions = transactions.filter((F.col("txn_date") > first) & (F.col("txn_date") <= as_of))
    return transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("txn_count_90d"),
        avg_money("amount_myr").alias("avg_txn_amount"),
        sum_money("amount_myr").alias("total_spend"),
        count_distinct_known("category", CATEGORIES).alias("category_variety"),
        F.count_if(F.col("channel").isin(DIGITAL_CHANNELS)).alias("digital_txns"),
    )


def feat_acct(accounts: DataFrame) -> DataFrame:
    """Holdings per customer, closed and dormant accounts included; only positive balances add up."""
    positive = F.when(F.col("balance_myr") > 0, units("balance_myr")).otherwise(F.lit(0))
    flags = [
        F.max(F.when(F.col("product_id") == product, 1).otherwise(0)).alias(flag)
        for flag, product in FLAG_PRODUCTS.items()
    ]
    return accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("num_products_held"),
        from_units(F.sum(positive)).alias("total_balance"),
        *flags,
    )


def tenure_months(as_of: dt.date) -> Column:
    return whole_months(as_of, F.to_date("join_date"))


def feat_tenure(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return customers.select("customer_id", tenure_months(as_of).alias("tenure_months"))


def feat_digital_score(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Share of digital transactions; NULL for a customer without transactions."""
    joined = customers.select("customer_id").join(feat_txn(transactions), "customer_id", "left")
    return joined.select("customer_id", _digital_score().alias("digital_engagement_score"))


def _digital_score() -> Column:
    return ratio2(F.coalesce("digital_txns", F.lit(0)), F.col("txn_count_90d"))


def feat_months_since_last_product(customers: DataFrame, accounts: DataFrame, as_of: dt.date) -> DataFrame:
    latest = accounts.groupBy("customer_id").agg(F.max("open_date").alias("last_open_date"))
    return customers.select("customer_id").join(latest, "customer_id", "left").select(
        "customer_id", whole_months(as_of, "last_open_date").alias("months_since_last_product")
    )


def income_rank() -> Column:
    """Position of the income band, 0 for an unknown or missing one."""
    rank = F.lit(0)
    for position, band in reversed(list(enumerate(INCOME_BANDS))):
        rank = F.when(F.col("income_band") == band, position).otherwise(rank)
    return rank


def feat_income_rank(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "income_band", income_rank().alias("income_rank"))


def features_base_join(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers with both aggregates; the aggregates come first, so nothing fans out."""
    return (
        customers.join(feat_acct(accounts), "customer_id", "left")
        .join(feat_txn(transactions), "customer_id", "left")
    )


def offer_rules() -> list[tuple[str, Column]]:
    """Offers in priority order with their conditions; bounds are inclusive unless written as > or <."""
    age, rank, balance = F.col("age"), F.col("income_rank"), F.col("total_balance")
    lacks = {flag: F.col(flag) == 0 for flag in FLAG_PRODUCTS}
    return [
        ("Home Financing-i", lacks["has_home"] & age.between(30, 50) & (rank >= 3)),
        ("Investment-i Fund", lacks["has_investment"] & (rank >= 4) & (balance > 50000)),
        ("Term Deposit-i", lacks["has_term_deposit"] & (age >= 50) & (balance > 30000)),
        ("Vehicle Financing-i", lacks["has_vehicle"] & age.between(25, 45) & rank.between(2, 4)),
        ("Personal Financing-i", lacks["has_personal"] & age.between(21, 40) & (rank <= 2)),
        ("Credit Card-i", lacks["has_card"] & (rank >= 2) & (F.col("digital_engagement_score") >= 0.5)),
        ("Education Financing-i", age.between(22, 35) & (F.col("category_variety") >= 5)),
    ]


def next_best_offer() -> Column:
    """The first rule that holds; a condition that is NULL does not hold."""
    offer = F.lit(NO_OFFER)
    for label, condition in reversed(offer_rules()):
        offer = F.when(condition, label).otherwise(offer)
    return offer


def customer_360_features(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row per customer: demographics, holdings, spend, income rank and offer."""
    zero_if_missing = [
        "num_products_held", "total_balance", *FLAG_PRODUCTS,
        "txn_count_90d", "avg_txn_amount", "total_spend", "category_variety",
    ]
    return (
        features_base_join(customers, accounts, transactions)
        .withColumns({
            "tenure_months": tenure_months(as_of),
            "digital_engagement_score": _digital_score(),
            "income_rank": income_rank(),
        })
        .na.fill(0, zero_if_missing)
        .withColumn("next_best_offer", next_best_offer())
        .select(*FEATURE_COLUMNS)
    )


def feat_offer_distribution(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("next_best_offer")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "next_best_offer")
    )
