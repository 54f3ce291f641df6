"""Data-quality checks.

Each check returns (check_name, table_name, violations).  All rules that look
at one row share a single pass over their table; rules that need another table
first count rows per key, so neither a hot key nor a wide row reaches a join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators.combine import union_all
from bankspark.operators.features import income_rank

# The age limits per segment and the holding rules per product
# (youngest, oldest, lowest income rank).
YOUTH_BELOW = 26
SENIOR_FROM = 61
HOLDING_RULES = {
    "P05": (30, 52, None),
    "P06": (25, 55, None),
    "P10": (None, None, 2),
    "P11": (None, None, 4),
}
PRIMARY_KEYS = {
    "branches": "branch_id",
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "txn_id",
}
ID_FORMATS = {
    "branches": "^B[0-9]{3,}$",
    "customers": "^C[0-9]{5,}$",
    "accounts": "^A[0-9]{6,}$",
    "transactions": "^T[0-9]{7,}$",
}

Tables = Mapping[str, DataFrame]
Rules = Mapping[str, Mapping[str, Column]]


def _result(check: str, table: str, violations: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    ]


def check_rows(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Count the rows that break each rule, in one pass; a NULL condition is no violation."""
    counted = df.agg(*[F.count_if(broken).alias(check) for check, broken in rules.items()])
    results = F.array(*[F.struct(*_result(check, table, F.col(f"`{check}`"))) for check in rules])
    return counted.select(F.inline(results))


# Rules on single rows: {table: {check: condition of a violation}}


def id_format_rules(formats: Mapping[str, str] = ID_FORMATS) -> Rules:
    return {
        table: {"id_format": ~F.col(PRIMARY_KEYS[table]).rlike(pattern)}
        for table, pattern in formats.items()
    }


def domain_rules() -> Rules:
    def outside(column: str, values: Sequence[str]) -> Column:
        return ~F.col(column).isin(list(values))

    return {
        "branches": {"domain_region": outside("region", S.REGIONS)},
        "customers": {
            "domain_segment": outside("segment", S.SEGMENTS),
            "domain_income_band": outside("income_band", S.INCOME_BANDS),
            "domain_region": outside("region", S.REGIONS),
        },
        "accounts": {"domain_status": outside("status", S.ACCOUNT_STATUSES)},
        "products": {"domain_product_type": outside("product_type", S.PRODUCT_TYPES)},
        "transactions": {
            "domain_channel": outside("channel", S.CHANNELS),
            "domain_category": outside("category", S.CATEGORIES),
        },
    }


def segment_age_rules() -> Rules:
    age, segment = F.col("age"), F.col("segment")
    return {
        "customers": {
            "segment_age": ((segment == "Youth") & (age >= YOUTH_BELOW))
            | ((segment == "Senior") & (age < SENIOR_FROM))
        }
    }


def amount_range_rules() -> Rules:
    """The twelve ranges become one CASE expression, so no join is needed."""
    broken = F.lit(False)
    for category, (low, high) in S.CATEGORY_RANGES.items():
        broken = F.when(F.col("category") == category, ~F.col("amount_myr").between(low, high)).otherwise(broken)
    return {"transactions": {"amount_range": broken}}


def balance_sign_rules() -> Rules:
    """Rules on accounts that already carry their product type."""
    kind, balance = F.col("product_type"), F.col("balance_myr")
    return {
        "accounts": {
            "balance_sign": (kind.isin("Deposit", "Wealth") & (balance <= 0))
            | ((kind == "Financing") & (balance >= 0))
            | ((kind == "Card") & (balance > 0))
            | ((kind == "Protection") & (balance != 0))
        }
    }


REQUIRED = {
    "branches": ("branch_id", "region"),
    "customers": ("customer_id", "segment", "home_branch_id", "join_date"),
    "accounts": ("account_id", "customer_id", "product_id", "balance_myr"),
    "transactions": ("txn_id", "customer_id", "txn_date", "amount_myr"),
    "products": ("product_id", "product_type"),
}


def missing_rules(required: Mapping[str, Sequence[str]] = REQUIRED) -> Rules:
    """Columns that must have a value; the other checks pass over what is missing."""
    return {
        table: {f"missing_{column}": F.col(column).isNull() for column in columns} for table, columns in required.items()
    }


def txn_date_rules(as_of: dt.date) -> Rules:
    return {"transactions": {"txn_after_as_of": F.col("txn_date") > F.lit(as_of)}}


def _checked(tables: Tables, rules: Rules) -> DataFrame:
    return union_all([check_rows(tables[t], t, conditions) for t, conditions in rules.items()])


def merge_rules(*groups: Rules) -> dict[str, dict[str, Column]]:
    merged: dict[str, dict[str, Column]] = {}
    for group in groups:
        for table, conditions in group.items():
            merged.setdefault(table, {}).update(conditions)
    return merged


def with_product_type(accounts: DataFrame, products: DataFrame) -> DataFrame:
    return accounts.join(products.select("product_id", "product_type"), "product_id", "left")


# Checks


def dq_id_format(tables: Tables, formats: Mapping[str, str] = ID_FORMATS) -> DataFrame:
    """Ids are a letter and at least the stated number of zero-padded digits."""
    return _checked(tables, id_format_rules(formats))


def dq_missing(tables: Tables) -> DataFrame:
    return _checked(tables, missing_rules())


def dq_domain(tables: Tables) -> DataFrame:
    return _checked(tables, domain_rules())


def dq_segment_age(customers: DataFrame) -> DataFrame:
    return _checked({"customers": customers}, segment_age_rules())


def dq_amount_range(transactions: DataFrame) -> DataFrame:
    return _checked({"transactions": transactions}, amount_range_rules())


def dq_balance_sign(accounts: DataFrame, products: DataFrame) -> DataFrame:
    return _checked({"accounts": with_product_type(accounts, products)}, balance_sign_rules())


def dq_pk_unique(tables: Tables, keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
    """Ids that occur more than once."""
    checks = []
    for table, key in keys.items():
        repeated = tables[table].groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        checks.append(repeated.agg(F.count(F.lit(1)).alias("v")).select(*_result("pk_unique", table, F.col("v"))))
    return union_all(checks)


def _orphans(check: str, child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent; a missing key is not one.  Keys are counted first, so a hot key is one row in the join."""
    per_key = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(key).alias(column))
    return per_key.join(known, column, "left_anti").agg(F.sum("n").alias("v")).select(
        *_result(check, table, F.col("v"))
    )


def dq_fk_orphans(tables: Tables) -> DataFrame:
    customers, branches = tables["customers"], tables["branches"]
    accounts, transactions = tables["accounts"], tables["transactions"]
    return union_all([
        _orphans("fk_home_branch", customers, "customers", "home_branch_id", branches, "branch_id"),
        _orphans("fk_customer", accounts, "accounts", "customer_id", customers, "customer_id"),
        _orphans("fk_product", accounts, "accounts", "product_id", tables["products"], "product_id"),
        _orphans("fk_customer", transactions, "transactions", "customer_id", customers, "customer_id"),
    ])


def _varying(check: str, table: str, df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that come with more than one value."""
    values = df.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1")
    return values.agg(F.count(F.lit(1)).alias("v")).select(*_result(check, table, F.col("v")))


def dq_region_of_state(customers: DataFrame) -> DataFrame:
    return _varying("region_of_state", "customers", customers, "state", "region")


def dq_merchant_category(transactions: DataFrame) -> DataFrame:
    return _varying("merchant_category", "transactions", transactions, "merchant", "category")


def dq_holding_rules(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts whose owner is outside the product's age or income limits, per product."""
    held = (
        accounts.filter(F.col("product_id").isin(list(HOLDING_RULES)))
        .groupBy("customer_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    owners = customers.select("customer_id", "age", income_rank().alias("rank"))
    sums = []
    for product, (youngest, oldest, lowest) in HOLDING_RULES.items():
        allowed = F.col("rank") >= lowest if lowest is not None else F.col("age").between(youngest, oldest)
        broken = (F.col("product_id") == product) & ~allowed
        sums.append(F.sum(F.when(broken, F.col("n"))).alias(f"holding_{product}"))
    results = F.array(*[
        F.struct(*_result(f"holding_{product}", "accounts", F.col(f"holding_{product}")))
        for product in HOLDING_RULES
    ])
    return held.join(owners, "customer_id").agg(*sums).select(F.inline(results))


def _opened_before_joining(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts opened in a year before their owner joined; the same year is allowed."""
    opened = accounts.groupBy("customer_id", F.year("open_date").alias("open_year")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = customers.select("customer_id", F.year("join_date").alias("join_year"))
    return (
        opened.join(joined, "customer_id")
        .filter(F.col("open_year") < F.col("join_year"))
        .agg(F.sum("n").alias("v"))
        .select(*_result("opened_before_joining", "accounts", F.col("v")))
    )


def dq_dates(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, as_of: dt.date) -> DataFrame:
    return union_all([
        _checked({"transactions": transactions}, txn_date_rules(as_of)),
        _opened_before_joining(customers, accounts),
    ])


def dq_row_counts(tables: Tables, expected: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Rows per table against ``expected`` (table_name, expected_rows); off by more than the share is flagged."""
    counts = union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(table))
        for table, df in tables.items()
    ])
    off = F.abs(F.col("row_count") - F.col("expected_rows")) > F.col("expected_rows") * F.lit(tolerance)
    return counts.join(expected, "table_name", "left").select(
        "table_name", "row_count", "expected_rows", (~off).alias("within_tolerance")
    )


def dq_one_row_per_customer(tables: Tables) -> DataFrame:
    """Rows beyond one per customer in each table of customer grain."""
    extra = F.count(F.lit(1)) - F.count_distinct("customer_id")
    return union_all([
        df.agg(extra.alias("v")).select(*_result("one_row_per_customer", table, F.col("v")))
        for table, df in tables.items()
    ])


def dq_report(
    tables: Tables,
    as_of: dt.date,
    formats: Mapping[str, str] = ID_FORMATS,
    customer_grain: Tables | None = None,
    expected_rows: DataFrame | None = None,
    tolerance: float = 0.1,
) -> DataFrame:
    """Every check in one table; rules on single rows share one pass per table.

    With ``expected_rows`` (table_name, expected_rows) a table whose row count is off by more than the tolerance is a
    violation of ``row_count``.
    """
    customers, accounts, transactions = tables["customers"], tables["accounts"], tables["transactions"]
    row_rules = merge_rules(
        missing_rules(), id_format_rules(formats), domain_rules(), segment_age_rules(),
        amount_range_rules(), balance_sign_rules(), txn_date_rules(as_of),
    )
    typed = {**tables, "accounts": with_product_type(accounts, tables["products"])}
    parts = [
        _checked(typed, row_rules),
        dq_pk_unique(tables),
        dq_fk_orphans(tables),
        dq_region_of_state(customers),
        dq_merchant_category(transactions),
        dq_holding_rules(customers, accounts),
        _opened_before_joining(customers, accounts),
    ]
    if customer_grain:
        parts.append(dq_one_row_per_customer(customer_grain))
    if expected_rows is not None:
        counts = dq_row_counts({**tables, **(customer_grain or {})}, expected_rows, tolerance)
        parts.append(counts.filter("expected_rows is not null").select(
            F.lit("row_count").alias("check_name"), "table_name",
            F.when(F.col("within_tolerance"), 0).otherwise(1).cast("bigint").alias("violations"),
        ))
    return union_all(parts)
