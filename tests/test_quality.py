from __future__ import annotations

import datetime as dt

import pytest

from bankspark import schemas as S
from bankspark.operators import quality as C

D = dt.date
AS_OF = D(2001, 8, 31)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "branches": spark.createDataFrame([("B001", "x", "Johor", "Southern"), ("B2", "y", "s", "Mars")], S.BRANCHES),
        "customers": spark.createDataFrame([
            ("C00001", "a", "F", 26, "Johor", "Southern", "Youth", "<3K", "B001", D(2000, 5, 1)),
            ("C00002", "b", "M", 25, "Johor", "Northern", "Youth", ">20K", "B404", D(2001, 5, 1)),
            ("C00003", "c", "M", 60, "Perak", "Northern", "Senior", "odd", None, D(2001, 5, 1)),
            ("C00003", "d", "M", 61, "Perak", "Northern", "Senior", "12K-20K", "B001", D(2001, 5, 1)),
        ], S.CUSTOMERS),
        "accounts": spark.createDataFrame([
            ("A000001", "C00001", "P05", -1.0, D(1999, 12, 31), "Active"),    # age 26 is too young; early
            ("A000002", "C00002", "P10", 0.0, D(2001, 1, 1), "Gone"),         # same year is allowed
            ("A000003", "C00001", "P11", 0.0, D(2001, 1, 1), "Active"),       # rank 0; wealth must be positive
            ("A4", "C00009", "P77", 5.0, D(2001, 1, 1), "Closed"),
        ], S.ACCOUNTS),
        "transactions": spark.createDataFrame([
            ("T0000001", "C00001", D(2001, 9, 1), 15.0, "ATM", "Groceries", "m1"),
            ("T0000002", "C00404", D(2001, 8, 31), 350.01, "ATM", "Groceries", "m1"),
            ("T0000003", "C00404", D(2001, 8, 31), 9.99, "Fax", "Dining", "m1"),
            ("T0000003", "C00001", None, None, "ATM", None, "m2"),
        ], S.TRANSACTIONS),
        "products": spark.createDataFrame(S.PRODUCT_ROWS, S.PRODUCTS),
    }


def violations(df):
    return {(r["check_name"], r["table_name"]): r["violations"] for r in df.collect()}


WANT = {
    ("pk_unique", "branches"): 0, ("pk_unique", "customers"): 1, ("pk_unique", "accounts"): 0,
    ("pk_unique", "transactions"): 1,
    ("id_format", "branches"): 1, ("id_format", "customers"): 0, ("id_format", "accounts"): 1,
    ("id_format", "transactions"): 0,
    ("fk_home_branch", "customers"): 1, ("fk_customer", "accounts"): 1, ("fk_product", "accounts"): 1,
    ("fk_customer", "transactions"): 2,
    ("domain_region", "branches"): 1, ("domain_region", "customers"): 0, ("domain_segment", "customers"): 0,
    ("domain_income_band", "customers"): 1, ("domain_status", "accounts"): 1,
    ("domain_product_type", "products"): 0, ("domain_channel", "transactions"): 1,
    ("domain_category", "transactions"): 0,
    ("region_of_state", "customers"): 1, ("segment_age", "customers"): 2,
    ("amount_range", "transactions"): 2, ("merchant_category", "transactions"): 1,
    ("balance_sign", "accounts"): 1,
    ("holding_P05", "accounts"): 1, ("holding_P06", "accounts"): 0, ("holding_P10", "accounts"): 0,
    ("holding_P11", "accounts"): 1,
    ("txn_after_as_of", "transactions"): 1, ("opened_before_joining", "accounts"): 1,
}
MISSING = {(f"missing_{c}", t): 0 for t, columns in C.REQUIRED.items() for c in columns} | {
    ("missing_home_branch_id", "customers"): 1, ("missing_txn_date", "transactions"): 1, ("missing_amount_myr", "transactions"): 1,
}


def test_each_check(tables):
    t = tables
    checks = [
        C.dq_pk_unique(t), C.dq_id_format(t), C.dq_fk_orphans(t), C.dq_domain(t),
        C.dq_region_of_state(t["customers"]), C.dq_segment_age(t["customers"]),
        C.dq_amount_range(t["transactions"]), C.dq_merchant_category(t["transactions"]),
        C.dq_balance_sign(t["accounts"], t["products"]), C.dq_holding_rules(t["customers"], t["accounts"]),
        C.dq_dates(t["customers"], t["accounts"], t["transactions"], AS_OF),
    ]
    found = {}
    for check in checks:
        found |= violations(check)
    assert found == WANT
    assert violations(C.dq_missing(t)) == MISSING


def test_report_holds_all_checks(tables):
    grain = {"customers": tables["customers"]}
    expected = tables["customers"].sparkSession.createDataFrame(
        [("customers", 4), ("accounts", 9)], "table_name string, expected_rows bigint")
    found = violations(C.dq_report(tables, AS_OF, customer_grain=grain, expected_rows=expected))
    assert found.pop(("one_row_per_customer", "customers")) == 1
    assert (found.pop(("row_count", "customers")), found.pop(("row_count", "accounts"))) == (0, 1)
    assert found == WANT | MISSING


def test_checks_on_empty_tables(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert set(violations(C.dq_report(empty, AS_OF)).values()) == {0}


def test_row_counts(spark, tables):
    expected = spark.createDataFrame(
        [("customers", 4), ("accounts", 5), ("products", 12)], "table_name string, expected_rows bigint")
    some = {t: tables[t] for t in ("customers", "accounts", "products", "branches")}
    rows = {r["table_name"]: r for r in C.dq_row_counts(some, expected, tolerance=0.1).collect()}
    assert rows["customers"]["within_tolerance"] and rows["products"]["within_tolerance"]
    assert rows["accounts"]["within_tolerance"] is False
    assert rows["branches"]["expected_rows"] is None
