"""SQL text over registered views gives what the DataFrame jobs give."""

from __future__ import annotations

import pytest

from bankspark.operators import governance as G
from bankspark.operators import metrics as Q
from bankspark.plans.registered import Bank
from bankspark.sources.tables import register_views

CENT = "decimal(18,2)"

PAIRS = {
    "segment profile": (
        lambda b: Q.agg_segment_profile(b.customers),
        "select segment, count(*) customers, round(avg(age), 1) avg_age from customers group by segment"),
    "spend by category": (
        lambda b: Q.agg_spend_by_category(b.transactions),
        f"select category, double(sum(cast(amount_myr as {CENT}))) total_amount, count(*) txns "
        "from transactions group by category"),
    "spend by segment": (
        lambda b: Q.agg_segment_spend(b.customers, b.transactions),
        f"""select segment, double(total) total_spend, customers, double(round(total / customers, 2)) spend_per_customer
            from (select segment, sum(cast(amount_myr as {CENT})) total, count(distinct customer_id) customers
                  from customers join transactions using (customer_id) group by segment)"""),
    "channels": (
        lambda b: Q.agg_channel_stats(b.transactions),
        f"select channel, double(round(avg(cast(amount_myr as {CENT})), 2)) avg_txn, count(*) txns "
        "from transactions group by channel"),
    "older customers": (
        lambda b: Q.eda_age_filter_by_segment(b.customers),
        "select segment, count(*) cust from customers where age > 30 group by segment"),
    "dashboard rows": (
        lambda b: Q.dash_dataset(b.gold, b.transactions),
        """select g.customer_id, g.segment, g.state, g.region, g.products_held, g.total_balance_myr,
             g.total_spend_myr, t.category, t.channel, t.amount_myr, t.txn_date
           from gold g join transactions t on t.customer_id = g.customer_id"""),
    "mask": (
        lambda b: b.customers.select("customer_id", G.mask_value().alias("region"), "segment"),
        "select customer_id, mask_pii(region) region, segment from customers"),
    "row filter": (
        lambda b: G.filter_rows(b.branches, "region", b.group_members, 1),
        "select * from branches where filter_by_region(region)"),
}


@pytest.fixture(scope="module")
def bank(spark, small_dir):
    bank = Bank(spark, small_dir)
    register_views({**bank.tables, "gold": bank.gold})
    G.register_functions(spark, bank.group_members, 1)
    return bank


@pytest.mark.parametrize("name", PAIRS)
def test_sql_equals_dataframe(spark, bank, name):
    job, sql = PAIRS[name]
    frame, text = job(bank), spark.sql(sql)
    assert frame.columns == text.columns
    assert sorted(map(repr, frame.collect())) == sorted(map(repr, text.collect()))


def test_row_filter_function_without_a_group(spark, bank):
    G.register_functions(spark, bank.group_members, 11)
    assert spark.sql("select * from branches where filter_by_region(region)").count() == 0
    G.register_functions(spark, bank.group_members, 1)
    assert spark.sql("select filter_by_region(null)").first()[0] is None
    assert spark.sql("select mask_pii(null)").first()[0] == "***REDACTED***"


def test_row_filter_function_of_a_reader_in_many_groups(spark, bank):
    own = bank.group_members.filter("principal = 1").select("principal", "group_name")
    many = own.union(spark.range(2000).selectExpr("1L AS principal", "concat('team_', id) AS group_name"))
    want = spark.sql("select branch_id from branches where filter_by_region(region)").collect()
    G.register_functions(spark, many, 1)
    assert sorted(spark.sql("select branch_id from branches where filter_by_region(region)").collect()) == sorted(want)
