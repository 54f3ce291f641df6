from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators import features as E
from bankspark.operators import medallion as M
from bankspark.functions.dates import whole_months

AS_OF = dt.date(2001, 8, 31)
PLAIN = {
    "age": 60, "income_rank": 0, "total_balance": 0.0, "category_variety": 0, "digital_engagement_score": 0.0,
    **{flag: 1 for flag in E.FLAG_PRODUCTS},
}

# (changes to a customer whom no rule matches, expected offer)
RULE_CASES = [
    ({}, "None"),
    # 1: both age bounds, rank bound, holding
    ({"has_home": 0, "age": 30, "income_rank": 3}, "Home Financing-i"),
    ({"has_home": 0, "age": 50, "income_rank": 3}, "Home Financing-i"),
    ({"has_home": 0, "age": 29, "income_rank": 3}, "None"),
    ({"has_home": 0, "age": 51, "income_rank": 3}, "None"),
    ({"has_home": 0, "age": 30, "income_rank": 2}, "None"),
    # 2: strict balance
    ({"has_investment": 0, "income_rank": 4, "total_balance": 50000.01}, "Investment-i Fund"),
    ({"has_investment": 0, "income_rank": 4, "total_balance": 50000.0}, "None"),
    ({"has_investment": 0, "income_rank": 3, "total_balance": 90000.0}, "None"),
    # 3: inclusive age, strict balance
    ({"has_term_deposit": 0, "age": 50, "total_balance": 30000.01}, "Term Deposit-i"),
    ({"has_term_deposit": 0, "age": 49, "total_balance": 30000.01}, "None"),
    ({"has_term_deposit": 0, "age": 50, "total_balance": 30000.0}, "None"),
    # 4: both bounds of age and rank
    ({"has_vehicle": 0, "age": 25, "income_rank": 2}, "Vehicle Financing-i"),
    ({"has_vehicle": 0, "age": 45, "income_rank": 4}, "Vehicle Financing-i"),
    ({"has_vehicle": 0, "age": 24, "income_rank": 2}, "None"),
    ({"has_vehicle": 0, "age": 46, "income_rank": 2}, "None"),
    ({"has_vehicle": 0, "age": 30, "income_rank": 1}, "None"),
    ({"has_vehicle": 0, "age": 30, "income_rank": 5}, "None"),
    # 5
    ({"has_personal": 0, "age": 21, "income_rank": 2}, "Personal Financing-i"),
    ({"has_personal": 0, "age": 40, "income_rank": 0}, "Personal Financing-i"),
    ({"has_personal": 0, "age": 20}, "None"),
    ({"has_personal": 0, "age": 41}, "None"),
    ({"has_personal": 0, "age": 30, "income_rank": 3}, "None"),
    # 6: a missing score must not match
    ({"has_card": 0, "income_rank": 2, "digital_engagement_score": 0.5}, "Credit Card-i"),
    ({"has_card": 0, "income_rank": 2, "digital_engagement_score": 0.49}, "None"),
    ({"has_card": 0, "income_rank": 2, "digital_engagement_score": None}, "None"),
    ({"has_card": 0, "income_rank": 1, "digital_engagement_score": 0.9}, "None"),
    # 7
    ({"age": 22, "category_variety": 5}, "Education Financing-i"),
    ({"age": 35, "category_variety": 5}, "Education Financing-i"),
    ({"age": 21, "category_variety": 9}, "None"),
    ({"age": 36, "category_variety": 9}, "None"),
    ({"age": 30, "category_variety": 4}, "None"),
    # first match wins
    ({"has_home": 0, "has_term_deposit": 0, "age": 50, "income_rank": 3, "total_balance": 40000.0}, "Home Financing-i"),
    ({"has_investment": 0, "has_vehicle": 0, "age": 30, "income_rank": 4, "total_balance": 60000.0},
     "Investment-i Fund"),
]


def test_offer_rules(spark):
    rows = [(i, *{**PLAIN, **changes}.values()) for i, (changes, _) in enumerate(RULE_CASES)]
    schema = "case int, age int, income_rank int, total_balance double, category_variety int, " \
        "digital_engagement_score double, " + ", ".join(f"{flag} int" for flag in E.FLAG_PRODUCTS)
    offers = spark.createDataFrame(rows, schema).select("case", E.next_best_offer().alias("offer")).collect()
    assert {r["case"]: r["offer"] for r in offers} == {i: want for i, (_, want) in enumerate(RULE_CASES)}


@pytest.mark.parametrize("earlier, later, want", [
    (dt.date(2000, 8, 15), dt.date(2001, 8, 15), 12),
    (dt.date(2001, 2, 28), dt.date(2001, 8, 31), 6),
    (dt.date(2000, 8, 16), dt.date(2001, 8, 15), 11),
    (dt.date(2001, 9, 15), dt.date(2001, 8, 31), 0),
    (dt.date(2001, 10, 30), dt.date(2001, 8, 31), -1),
    (dt.date(2000, 2, 29), dt.date(2001, 2, 28), 12),
])
def test_whole_months(spark, earlier, later, want):
    assert spark.range(1).select(whole_months(later, F.lit(earlier))).first()[0] == want


def test_income_rank(spark):
    bands = S.INCOME_BANDS + ["unknown", None]
    df = spark.createDataFrame([(b,) for b in bands], "income_band string")
    assert [r[0] for r in df.select(E.income_rank()).collect()] == [0, 1, 2, 3, 4, 5, 0, 0]


@pytest.fixture()
def one_customer(spark):
    customers = spark.createDataFrame(
        [("C1", "A", "F", 30, "S", "Central", "Mass", ">20K", "B1", dt.date(2000, 1, 1)),
         ("C2", "B", "M", 40, "S", "Central", "Mass", None, "B9", dt.date(2002, 1, 1))], S.CUSTOMERS)
    branches = spark.createDataFrame([("B1", "Main", "Home State", "Northern")], S.BRANCHES)
    accounts = spark.createDataFrame(
        [("A1", "C1", "P05", -100.10, dt.date(2000, 1, 1), "Closed"),
         ("A2", "C1", "P01", 40.05, dt.date(2001, 1, 31), "Active")], S.ACCOUNTS)
    transactions = spark.createDataFrame(
        [("T1", "C1", dt.date(2001, 8, 1), 10.01, "QR Pay", "Fuel", "m"),
         ("T2", "C1", dt.date(2000, 1, 1), 0.10, "ATM", "Fuel", "m"),
         ("T3", "C1", dt.date(2001, 8, 31), -5.00, "Branch", "Dining", "m")], S.TRANSACTIONS)
    return customers, branches, accounts, transactions


def test_nothing_fans_out(one_customer):
    customers, branches, accounts, transactions = one_customer
    dim = M.silver_customer_dim(customers, branches, accounts, with_has_balance=True)
    gold = M.gold_customer_360(dim, M.silver_transactions(transactions), with_spend_per_product=True)
    rows = {r["customer_id"]: r for r in gold.collect()}
    assert len(rows) == 2
    first, second = rows["C1"], rows["C2"]
    assert (first["products_held"], first["total_balance_myr"], first["has_balance"]) == (2, -60.05, False)
    assert (first["txn_count"], first["total_spend_myr"], first["avg_txn_myr"]) == (2, 10.11, 5.06)
    assert first["spend_per_product"] == 10.11 / 2
    assert first["state"] == "Home State"
    # without accounts or transactions: a zero count, everything else missing
    assert (second["products_held"], second["total_balance_myr"], second["has_balance"]) == (0, None, None)
    assert (second["txn_count"], second["total_spend_myr"], second["spend_per_product"]) == (None, None, None)
    assert second["branch_name"] is None


def test_feature_row(one_customer):
    customers, _, accounts, transactions = one_customer
    rows = {r["customer_id"]: r for r in E.customer_360_features(customers, accounts, transactions, AS_OF).collect()}
    first, second = rows["C1"], rows["C2"]
    assert first["state"] == "S"
    assert (first["num_products_held"], first["total_balance"]) == (2, 40.05)
    assert (first["has_home"], first["has_card"]) == (1, 0)
    assert (first["txn_count_90d"], first["total_spend"], first["avg_txn_amount"]) == (3, 5.11, 1.70)
    assert (first["category_variety"], first["digital_engagement_score"]) == (2, 0.33)
    assert (first["income_rank"], second["income_rank"]) == (5, 0)
    assert second["digital_engagement_score"] is None
    assert (second["txn_count_90d"], second["total_balance"], second["tenure_months"]) == (0, 0.0, -4)


def test_true_window_is_a_parameter(one_customer):
    *_, transactions = one_customer
    assert E.feat_txn(transactions).first()["txn_count_90d"] == 3
    assert E.feat_txn(transactions, AS_OF, 90).first()["txn_count_90d"] == 2
    with pytest.raises(ValueError):
        E.feat_txn(transactions, window_days=90)


def test_months_since_last_product(one_customer):
    customers, _, accounts, _ = one_customer
    rows = {r[0]: r[1] for r in E.feat_months_since_last_product(customers, accounts, AS_OF).collect()}
    assert rows == {"C1": 7, "C2": None}


def test_known_and_unknown_values_are_counted_exactly(spark):
    from bankspark.functions.sets import count_distinct_known

    rows = [("a", v) for v in ("Fuel", "Fuel", "Dining", "other", "other", "more", None)]
    rows += [("b", None), ("c", "Cash Withdrawal")]
    df = spark.createDataFrame(rows, "k string, category string")
    counted = df.groupBy("k").agg(count_distinct_known("category", S.CATEGORIES).alias("n"),
                                  F.count_distinct("category").alias("plain"))
    assert {r["k"]: r["n"] for r in counted.collect()} == {"a": 4, "b": 0, "c": 1}
    assert counted.filter("n <> plain").count() == 0


def test_a_long_list_of_known_values(spark):
    from bankspark.functions.sets import count_distinct_known

    known = [f"v{i}" for i in range(150)]
    df = spark.createDataFrame([(f"v{i % 170}",) for i in range(400)] + [(None,)], "c string")
    assert df.agg(count_distinct_known("c", known)).first()[0] == 170
