"""Declared schemas and vocabularies of the five banking tables."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("income_band", T.StringType()),
    T.StructField("home_branch_id", T.StringType()),
    T.StructField("join_date", T.DateType()),
])

ACCOUNTS = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("balance_myr", T.DoubleType()),
    T.StructField("open_date", T.DateType()),
    T.StructField("status", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("txn_date", T.DateType()),
    T.StructField("amount_myr", T.DoubleType()),
    T.StructField("channel", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_type", T.StringType()),
    T.StructField("profit_rate_pct", T.DoubleType()),
    T.StructField("min_amount_myr", T.IntegerType()),
])

BRANCHES = T.StructType([
    T.StructField("branch_id", T.StringType()),
    T.StructField("branch_name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("region", T.StringType()),
])

GROUP_MEMBERS = T.StructType([
    T.StructField("principal", T.LongType()),
    T.StructField("group_name", T.StringType()),
])

TABLES = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "products": PRODUCTS,
    "branches": BRANCHES,
}

# The vocabularies, the product catalog and the amount ranges
# below are data that results have to agree with.

SEGMENTS = ["Mass", "Mass Affluent", "Affluent", "Youth", "Senior"]

# In rank order: the position of a band is its income rank.
INCOME_BANDS = ["<3K", "3K-5K", "5K-8K", "8K-12K", "12K-20K", ">20K"]

REGIONS = ["Central", "Southern", "Northern", "East Coast", "East Malaysia"]

CHANNELS = ["Mobile App", "Internet Banking", "ATM", "Branch", "Debit Card", "QR Pay"]

CATEGORIES = [
    "Groceries", "Dining", "Fuel", "Utilities", "Retail Shopping", "Healthcare",
    "Education", "Travel", "Telco", "Entertainment", "Transfer", "Cash Withdrawal",
]

ACCOUNT_STATUSES = ["Active", "Dormant", "Closed"]

PRODUCT_TYPES = ["Deposit", "Financing", "Card", "Wealth", "Protection"]

PRODUCT_ROWS = [
    ("P01", "Savings-i Account", "Deposit", 0.25, 20),
    ("P02", "Term Deposit-i", "Deposit", 3.85, 1000),
    ("P03", "Current Account-i", "Deposit", 0.0, 500),
    ("P04", "Personal Financing-i", "Financing", 4.5, 5000),
    ("P05", "Home Financing-i", "Financing", 3.85, 50000),
    ("P06", "Vehicle Financing-i", "Financing", 3.4, 20000),
    ("P07", "Education Financing-i", "Financing", 3.75, 10000),
    ("P08", "Micro Financing-i", "Financing", 6.0, 1000),
    ("P09", "Cash Line-i", "Financing", 7.5, 3000),
    ("P10", "Credit Card-i", "Card", 0.0, 0),
    ("P11", "Investment-i Fund", "Wealth", 0.0, 1000),
    ("P12", "Takaful Protection-i", "Protection", 0.0, 0),
]

# category: (lowest, highest) amount of one transaction
CATEGORY_RANGES = {
    "Groceries": (15, 350),
    "Dining": (10, 200),
    "Fuel": (30, 250),
    "Utilities": (40, 500),
    "Retail Shopping": (20, 1200),
    "Healthcare": (15, 800),
    "Education": (100, 3000),
    "Travel": (50, 5000),
    "Telco": (30, 300),
    "Entertainment": (10, 250),
    "Transfer": (50, 8000),
    "Cash Withdrawal": (50, 2000),
}

MASKED = "***REDACTED***"
