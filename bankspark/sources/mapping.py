"""The banking tables, derived from the given star-schema tables.

Every function reads its whole input tables: each order becomes one account,
each line item one transaction, each customer one customer and one principal.
Nothing is filtered away.  The edge cases that the jobs must handle come from
how keys are assigned:

* customers whose key is a multiple of 15 hold no account, because their
  orders count for the next customer; multiples of 10 have no transaction;
* home branch 26 does not exist;
* join dates and transaction dates may lie after ``AS_OF``;
* transactions of returned items have a negative amount.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.sources.files import dealt_out
from bankspark.sources.literals import literal_table

# A month end, so that the month-end rule of months_between is exercised.
AS_OF = dt.date(2001, 8, 31)

# How the given codes translate into the banking vocabularies.
REGION_OF = {
    "AFRICA": "Central",
    "AMERICA": "East Coast",
    "ASIA": "East Malaysia",
    "EUROPE": "Northern",
    "MIDDLE EAST": "Southern",
}
SEGMENT_OF = {
    "AUTOMOBILE": "Mass",
    "BUILDING": "Mass Affluent",
    "FURNITURE": "Affluent",
    "HOUSEHOLD": "Youth",
    "MACHINERY": "Senior",
}
STATUS_OF = {"F": "Active", "O": "Dormant", "P": "Closed"}
BAND_BELOW = [1000, 3000, 5000, 7000, 8500]


def _translate(column: str, names: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for code, name in names.items():
        result = F.when(F.col(column) == code, name).otherwise(result)
    return result


def _pick(index: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def _padded(number: Column, width: int) -> Column:
    """Zero-padded to at least ``width`` digits; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _next_if_multiple(key: str, of: int) -> Column:
    return F.when(F.col(key) % of == 0, F.col(key) + 1).otherwise(F.col(key))


def _customer_id(key: Column) -> Column:
    return F.concat(F.lit("C"), _padded(key, 7))


def _group_of_region(region: Column) -> Column:
    return F.concat(F.lit("team_"), F.lower(F.replace(region, F.lit(" "), F.lit("_"))))


def map_branches(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("B"), _padded(F.col("n_nationkey") + 1, 3)).alias("branch_id"),
        F.concat("n_name", F.lit(" Main Branch")).alias("branch_name"),
        F.col("n_name").alias("state"),
        _translate("r_name", REGION_OF).alias("region"),
    )


def map_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    band = F.lit(S.INCOME_BANDS[-1])
    for limit, name in reversed(list(zip(BAND_BELOW, S.INCOME_BANDS))):
        band = F.when(F.col("c_acctbal") < limit, name).otherwise(band)
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _customer_id(key).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(key % 2 == 1, "M").otherwise("F").alias("gender"),
        (key % 61 + 18).cast("int").alias("age"),
        F.col("n_name").alias("state"),
        _translate("r_name", REGION_OF).alias("region"),
        _translate("c_mktsegment", SEGMENT_OF).alias("segment"),
        band.alias("income_band"),
        F.concat(F.lit("B"), _padded(key * 7 % 26 + 1, 3)).alias("home_branch_id"),
        F.date_add(F.lit(dt.date(1994, 1, 1)), (key * 37 % 2900).cast("int")).alias("join_date"),
    )


def customers_view_sql(prefix: str) -> str:
    """The statement for a view of customers over tables of the given files, all under names with the prefix."""
    region = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in REGION_OF.items())
    segment = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in SEGMENT_OF.items())
    return (
        f"CREATE OR REPLACE VIEW {prefix}customers AS SELECT"
        " concat('C', lpad(cast(c_custkey AS string), greatest(7, length(cast(c_custkey AS string))), '0')) AS customer_id,"
        f" c_name AS name, CASE c_mktsegment {segment} END AS segment, n_name AS state, CASE r_name {region} END AS region"
        f" FROM {prefix}customer JOIN {prefix}nation ON c_nationkey = n_nationkey JOIN {prefix}region ON n_regionkey = r_regionkey"
    )


def map_accounts(orders: DataFrame) -> DataFrame:
    product = F.floor(F.col("o_orderkey") / 5).cast("bigint") % 12
    price = F.col("o_totalprice")
    return orders.select(
        F.concat(F.lit("A"), _padded(F.col("o_orderkey"), 9)).alias("account_id"),
        _customer_id(_next_if_multiple("o_custkey", 15)).alias("customer_id"),
        F.concat(F.lit("P"), _padded(product + 1, 2)).alias("product_id"),
        F.when(product.between(3, 9), -price)
        .when(product == 11, 0.0)
        .otherwise(price)
        .alias("balance_myr"),
        F.col("o_orderdate").cast("date").alias("open_date"),
        _translate("o_orderstatus", STATUS_OF).alias("status"),
    )


def map_transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    whole_cents = (
        F.col("l_quantity").cast("int") * 2 * (F.col("l_partkey") % 12 + 1) * 100
        + F.col("l_suppkey") % 100
    )
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    owners = orders.select("o_orderkey", _customer_id(_next_if_multiple("o_custkey", 10)).alias("customer_id"))
    return lineitem.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(
            F.lit("T"), _padded(F.col("l_orderkey"), 9), F.lit("-"), F.col("l_linenumber"),
            F.lit("-"), F.col("l_partkey"), F.lit("-"), F.col("l_suppkey"),
        ).alias("txn_id"),
        "customer_id",
        F.col("l_shipdate").cast("date").alias("txn_date"),
        ((sign * whole_cents).cast("double") / 100).alias("amount_myr"),
        _pick(F.col("l_suppkey") % 6, S.CHANNELS).alias("channel"),
        _pick(F.col("l_partkey") % 12, S.CATEGORIES).alias("category"),
        F.concat(F.lit("Merchant "), F.col("l_suppkey")).alias("merchant"),
    )


def map_group_members(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One principal per customer: its region's team, plus ``team_central`` for multiples of 13;
    multiples of 11 are in the ``staff`` group only, which is no region team."""
    key = F.col("c_custkey")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    team = _group_of_region(_translate("r_name", REGION_OF))
    groups = (
        F.when(key % 11 == 0, F.array(F.lit("staff")))
        .when(key % 13 == 0, F.array_distinct(F.array(team, F.lit("team_central"))))
        .otherwise(F.array(team))
    )
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("principal"), F.explode(groups).alias("group_name")
    )


def map_sheets(part: DataFrame) -> DataFrame:
    """One product disclosure sheet of eight lines per part."""
    lines = [
        F.lit("Product Disclosure Sheet"),
        F.lit("Key Product Features"),
        F.concat(F.lit("Profit rate:  "), F.col("p_size"), F.lit(".25% per annum")),
        F.concat(F.lit("Minimum placement:  RM"), F.floor("p_retailprice").cast("bigint")),
        F.lit("Eligibility"),
        F.concat(F.lit("Age:  "), F.col("p_size") % 10 + 18, F.lit(" to 60 years old")),
        F.lit("Fees and Charges"),
        F.lit("Late payment charge:  1% per annum on overdue instalment"),
    ]
    return part.select(
        F.col("p_partkey").alias("doc_id"),
        F.col("p_type").alias("product"),
        F.concat_ws("\n", *lines).alias("text"),
    )


def map_catalog(part: DataFrame) -> DataFrame:
    """A catalog to reconcile with the sheets: every 7th product id has no sheet
    (and leaves one without a product), every 11th rate has drifted."""
    key = F.col("p_partkey")
    return part.select(
        F.when(key % 7 == 0, -1 - key).otherwise(key).alias("doc_id"),
        (F.col("p_size") + 0.25 + F.when(key % 11 == 0, 0.5).otherwise(0.0)).alias("profit_rate_pct"),
    )


class GivenTables:
    """Lazy access to the given parquet tables and the banking tables made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        """The texts, for jobs that read them word by word."""
        return dealt_out(self.raw("documents"))

    @cached_property
    def branches(self) -> DataFrame:
        return map_branches(self.raw("nation"), self.raw("region"))

    @cached_property
    def customers(self) -> DataFrame:
        return map_customers(self.raw("customer"), self.raw("nation"), self.raw("region"))

    @cached_property
    def accounts(self) -> DataFrame:
        return map_accounts(self.raw("orders"))

    @cached_property
    def transactions(self) -> DataFrame:
        return map_transactions(self.raw("lineitem"), self.raw("orders"))

    @cached_property
    def products(self) -> DataFrame:
        return literal_table(self.spark, S.PRODUCT_ROWS, S.PRODUCTS)

    @cached_property
    def group_members(self) -> DataFrame:
        return map_group_members(self.raw("customer"), self.raw("nation"), self.raw("region"))

    @cached_property
    def sheets(self) -> DataFrame:
        return map_sheets(self.raw("part"))

    @cached_property
    def catalog(self) -> DataFrame:
        return map_catalog(self.raw("part"))
