"""A roll-up of spend that can be filtered afterwards and still counts distinct customers exactly.

A cell holds the spend of a segment, state, region and month, and the customers who have it as bitmaps.  Whatever cells
a choice of filters keeps, their bitmaps are joined by OR, so a customer of many months counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.functions.money import from_units
from bankspark.operators.medallion import spend_in_units
from bankspark.operators.metrics import apply_filters

PROFILE = ("segment", "state", "region")
CUSTOMERS_PER_PART = 1 << 14  # numbered by one task, about
PART_WIDTH = 1 << 40  # numbers of one part


def customer_numbers(customers: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(customer_id, number): dense numbers within parts of bounded size, or from part to part within each group of ``within``.

    Groups never share a chunk of bitmap numbers.  Rows are numbered in parts by a hash of the id; how many stand in
    the parts before is added up beside that, so a group of any size is no single task.
    """
    parts = max(1, customers.count() // CUSTOMERS_PER_PART)
    part = F.pmod(F.xxhash64("customer_id"), F.lit(parts))
    in_part = F.row_number().over(Window.partitionBy("part").orderBy("customer_id")) - 1
    if not within:
        return customers.select("customer_id", part.alias("part")).select(
            "customer_id", (F.col("part") * PART_WIDTH + in_part).alias("number")
        )
    rows = customers.select("customer_id", F.struct(*within).alias("group"), part.alias("part")).select(
        "customer_id", F.struct("group", "part").alias("part"))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.col("part.group").alias("group"), "n")
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # As many rows as there are groups, which are few: combinations of a profile.
    firsts = sizes.select("group").distinct().withColumn("first", F.row_number().over(Window.orderBy("group")) * PART_WIDTH)
    starts = starts.join(firsts, "group").select("part", (F.col("first") + F.col("start")).alias("start"))
    numbered = rows.withColumn("inside", in_part)
    return numbered.join(starts, "part").select("customer_id", (F.col("start") + F.col("inside") + 1).alias("number"))  # bitmap chunks begin at 1


def spend_cells(profile: DataFrame, transactions: DataFrame) -> DataFrame:
    """(segment, state, region, txn_month, chunk, customers, spend_units, txns) of customers with transactions.

    ``customers`` is the bitmap of the chunk's customers in the cell.  Customers are numbered profile by profile, so a
    chunk belongs to one profile and its bitmaps are not nearly empty: there are a few times as many cells as months and
    32,768s of customers.  Transactions are added up per customer and month before they meet the profile.
    """
    monthly = spend_in_units(transactions.withColumn("txn_month", F.date_trunc("month", "txn_date")), "txn_month")
    members = profile.select("customer_id", *PROFILE).join(customer_numbers(profile, PROFILE), "customer_id")
    return (
        members.join(monthly, "customer_id")
        .groupBy(*PROFILE, "txn_month", F.bitmap_bucket_number("number").alias("chunk"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"),
            F.sum("spend_units").alias("spend_units"), F.sum("txns").alias("txns"),
        )
    )


def spend_by(cells: DataFrame, by: Sequence[str], chosen: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(by..., customers, txns, total_amount) of the cells that match the filters; ``by`` may be empty."""
    chunks = apply_filters(cells, chosen or {}).groupBy(*by, "chunk").agg(
        F.bitmap_count(F.bitmap_or_agg("customers")).alias("customers"),
        F.sum("spend_units").alias("spend_units"), F.sum("txns").alias("txns"),
    )
    return chunks.groupBy(*by).agg(
        F.sum("customers").alias("customers"), F.sum("txns").alias("txns"),
        from_units(F.sum("spend_units")).alias("total_amount"),
    )
