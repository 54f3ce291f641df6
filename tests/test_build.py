from __future__ import annotations

import pytest

import __spark_entry__ as entry
from bankspark.operators import governance as G
from bankspark.plans.build import build_tables
from bankspark.plans.registered import POLICIES, Bank
from bankspark.sources.mapping import AS_OF
from bankspark.sources.tags import set_tag


@pytest.fixture(scope="module")
def bank(spark, small_dir):
    return Bank(spark, small_dir)


@pytest.fixture(scope="module")
def built(spark, bank, tmp_path_factory):
    return build_tables(spark, bank.tables, AS_OF, str(tmp_path_factory.mktemp("lake")), "all_")


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", [
    "silver_customer_dim", "silver_transactions", "gold_customer_360", "gold_top_customers", "customer_360_features",
])
def test_stored_table_equals_the_query(spark, small_dir, built, name):
    assert rows(built[name]) == rows(entry.queries()[name](spark, small_dir))
    assert rows(spark.table("all_" + name)) == rows(built[name])


def test_rebuilding_replaces_the_tables(spark, bank, tmp_path):
    half = {**bank.tables, "customers": bank.customers.filter("age < 40")}
    first = build_tables(spark, bank.tables, AS_OF, str(tmp_path), "again_")["gold_customer_360"].count()
    second = build_tables(spark, half, AS_OF, str(tmp_path), "again_")["gold_customer_360"].count()
    assert first == bank.customers.count() and 0 < second < first


def test_tables_of_one_reader_carry_the_policies(spark, bank, tmp_path):
    """Masked names stay masked in everything built from them, and hidden branches leave NULLs."""
    customers = set_tag(bank.customers, "name", "pii", "true")
    seen = {
        **bank.tables,
        "customers": G.enforce(customers, POLICIES, bank.group_members, 1),
        "branches": bank.visible_branches(),
    }
    gold = build_tables(spark, seen, AS_OF, str(tmp_path), "reader_")["gold_customer_360"]
    assert gold.count() == bank.customers.count()
    assert [r[0] for r in gold.select("name").distinct().collect()] == ["***REDACTED***"]
    assert {r[0] for r in gold.select("region").distinct().collect()} == {"Southern", None}
