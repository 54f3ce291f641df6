"""Known figures of a sparser population.

The figures were established independently for a population in which only every
fifth order opens an account and some customers have neither accounts nor
transactions.  The same mapping functions must reproduce them on those rows.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bankspark.operators import documents, features, medallion, metrics, quality, routing
from bankspark.sources import mapping as M

FIGURES = {
    "sf0.001": {
        "accounts": 281, "transactions": 5342, "positive": 3576, "large": 97, "orphans": 6,
        "top": 115, "no_spend": 15, "digital": 18, "no_score": 15, "late": 134, "early_open": 99, "chunks": 496,
        "offers": {
            "Home Financing-i": 22, "Investment-i Fund": 6, "Term Deposit-i": 23, "Vehicle Financing-i": 15,
            "Personal Financing-i": 24, "Credit Card-i": 14, "Education Financing-i": 5, "None": 41,
        },
    },
    "sf0.01": {
        "accounts": 2779, "transactions": 54077, "positive": 36052, "large": 876, "orphans": 58,
        "top": 1153, "no_spend": 150, "digital": 35, "no_score": 150, "late": 1375, "early_open": 1062,
        "chunks": 2448,
        "offers": {
            "Home Financing-i": 211, "Investment-i Fund": 82, "Term Deposit-i": 181, "Vehicle Financing-i": 132,
            "Personal Financing-i": 179, "Credit Card-i": 168, "Education Financing-i": 42, "None": 505,
        },
    },
}


class Sparse:
    def __init__(self, spark, sf_dir):
        given = M.GivenTables(spark, sf_dir)
        orders, lineitem = given.raw("orders"), given.raw("lineitem")
        self.customers, self.branches = given.customers, given.branches
        self.documents = given.raw("documents")
        self.accounts = M.map_accounts(orders.filter("o_orderkey % 5 = 0 and o_custkey % 15 <> 0"))
        self.transactions = M.map_transactions(lineitem, orders.filter("o_custkey % 10 <> 0"))


@pytest.fixture(scope="module", params=sorted(FIGURES))
def case(request, spark):
    return Sparse(spark, f"/root/testdata/{request.param}"), FIGURES[request.param]


def test_rows(case):
    bank, want = case
    assert bank.accounts.count() == want["accounts"]
    assert bank.transactions.count() == want["transactions"]
    silver = medallion.silver_transactions(bank.transactions, with_is_large=True)
    assert silver.count() == want["positive"]
    assert silver.filter("is_large").count() == want["large"]
    assert documents.docs_chunk_words(bank.documents).count() == want["chunks"]


def test_offers(case):
    bank, want = case
    wide = features.customer_360_features(bank.customers, bank.accounts, bank.transactions, M.AS_OF)
    assert {r[0]: r[1] for r in features.feat_offer_distribution(wide).collect()} == want["offers"]
    assert wide.filter(F.col("digital_engagement_score").isNull()).count() == want["no_score"]


def test_gold(case):
    bank, want = case
    dim = medallion.silver_customer_dim(bank.customers, bank.branches, bank.accounts)
    gold = medallion.gold_customer_360(dim, medallion.silver_transactions(bank.transactions))
    assert dim.filter("branch_name is null").count() == want["orphans"]
    assert medallion.gold_top_customers(gold).count() == want["top"]
    assert gold.filter("total_spend_myr is null").count() == want["no_spend"]


def test_questions_and_checks(case):
    bank, want = case
    assert metrics.qa_digital_customers(bank.transactions).first()[0] == want["digital"]
    dates = quality.dq_dates(bank.customers, bank.accounts, bank.transactions, M.AS_OF)
    assert {r["check_name"]: r["violations"] for r in dates.collect()} == {
        "txn_after_as_of": want["late"], "opened_before_joining": want["early_open"],
    }


def test_routing_of_all_user_turns(spark):
    given = M.GivenTables(spark, "/root/testdata/sf0.01")
    turns = given.raw("conversations").filter("role = 'user'").select("conv_id", "turn", "text")
    routed = routing.route_questions(turns, routing.vocabularies(given.raw("documents"), "lang"))
    counts = {r[0]: r[1] for r in routed.groupBy("specialist").count().collect()}
    assert sum(counts.values()) == turns.count()
    assert set(counts) <= {"en", "de", "fr", "es", "none"}
