"""Bucketed tables, the filtered roll-up, tables over existing files, tags in properties, and generated views."""

from __future__ import annotations

import itertools
import re

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators import check_states as K
from bankspark.operators import features as E
from bankspark.operators import governance as G
from bankspark.operators import medallion as M
from bankspark.operators import metrics as Q
from bankspark.operators import policies as V
from bankspark.operators import rollup as L
from bankspark.plans.bucketed import store_by_customer
from bankspark.plans.registered import Bank
from bankspark.sources import scratch, tables
from bankspark.sources.mapping import AS_OF
from bankspark.sources.tags import scan_tagged, tag_table, tags_of


@pytest.fixture(scope="module")
def bank(spark, small_dir):
    return Bank(spark, small_dir)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Buckets


@pytest.fixture(scope="module")
def by_customer(spark, bank, tmp_path_factory):
    """A third of the transactions belong to one customer, who also has many accounts."""
    hot = bank.transactions.limit(2000).withColumn("customer_id", F.lit("C0000001"))
    held = bank.accounts.limit(300).withColumn("customer_id", F.lit("C0000001"))
    own = {
        "customers": bank.customers, "accounts": bank.accounts.union(held), "transactions": bank.transactions.union(hot),
    }
    return own, store_by_customer(spark, own, "buckets_", str(tmp_path_factory.mktemp("buckets")), 16)


def test_large_customers_are_kept_apart(by_customer):
    _, stored = by_customer
    assert [r[0] for r in stored.large["customers"].select("customer_id").collect()] == ["C0000001"]
    assert stored.bulk["transactions"].filter("customer_id = 'C0000001'").isEmpty()


def gold(t, branches):
    dim = M.silver_customer_dim(t["customers"], branches, t["accounts"])
    return M.gold_customer_360(dim, M.silver_transactions(t["transactions"]))


@pytest.mark.parametrize("job", [
    lambda t, b: gold(t, b),
    lambda t, b: M.silver_customer_dim(t["customers"], b, t["accounts"]),
    lambda t, b: E.features_base_join(t["customers"], t["accounts"], t["transactions"]),
    lambda t, b: E.customer_360_features(t["customers"], t["accounts"], t["transactions"], AS_OF),
], ids=["gold", "dim", "base", "features"])
def test_jobs_per_customer_need_no_exchange(spark, bank, by_customer, job):
    own, stored = by_customer
    branches = F.broadcast(bank.branches)  # two dozen rows
    assert rows(stored.per_customer(lambda t: job(t, branches))) == rows(job(own, bank.branches))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        plan = plan_of(job(stored.bulk, branches))
        large = plan_of(job(stored.large, branches))
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert not re.search(r"Exchange hashpartitioning\(customer_id", plan), plan
    assert "Exchange hashpartitioning(customer_id" in large  # combined before the shuffle, and splittable


# Roll-up


def test_every_choice_of_filters_equals_the_rows(spark, bank):
    cells = scratch.store(L.spend_cells(bank.profile, bank.transactions))
    facts = Q.dash_dataset(bank.gold, bank.transactions).withColumn("txn_month", F.date_trunc("month", "txn_date")).cache()
    choices = [
        {}, {"segment": ["Affluent", "Youth"]}, {"region": ["Central"], "segment": ["Mass"]}, {"state": ["NATION_3", "NATION_7"]},
        {"segment": ["nobody"]},
    ]
    for chosen, by in itertools.product(choices, ([], ["state"], ["region", "txn_month"], ["segment", "region"])):
        want = Q.apply_filters(facts, chosen).groupBy(*by).agg(
            F.count_distinct("customer_id").alias("customers"), F.count("amount_myr").alias("txns"),
            Q.sum_money("amount_myr").alias("total_amount"))
        got = L.spend_by(cells, by, chosen)
        if by or chosen != {"segment": ["nobody"]}:
            assert rows(got) == rows(want), (chosen, by)
        else:
            assert got.first()["customers"] is None


def test_numbers_are_dense_in_parts(spark, monkeypatch):
    monkeypatch.setattr(L, "CUSTOMERS_PER_PART", 50)
    found = L.customer_numbers(spark.range(1000).selectExpr("concat('C', id) AS customer_id")).select("number").collect()
    parts = {}
    for (n,) in found:
        parts.setdefault(n // L.PART_WIDTH, []).append(n % L.PART_WIDTH)
    assert len(parts) == 20 and all(sorted(p) == list(range(len(p))) for p in parts.values())


def test_bitmaps_of_a_cell_are_not_nearly_empty(spark, monkeypatch):
    """Customers of a profile have numbers side by side, so a profile has as few bitmaps as its size needs."""
    monkeypatch.setattr(L, "CUSTOMERS_PER_PART", 50)
    n = 2000
    profile = spark.range(n).selectExpr(
        "concat('C', id) AS customer_id", "nullif(concat('s', id % 4), 's3') AS segment", "'x' AS state", "'y' AS region")
    numbers = L.customer_numbers(profile, L.PROFILE).join(profile, "customer_id").collect()
    assert len({r["number"] for r in numbers}) == len(numbers) == n
    chunks = {}
    for r in numbers:
        chunks.setdefault(r["segment"], []).append(r["number"])
    for of_segment in chunks.values():  # gapless from part to part
        assert sorted(of_segment) == list(range(min(of_segment), min(of_segment) + n // 4))
    assert len({min(c) // L.PART_WIDTH for c in chunks.values()}) == 4
    days = spark.range(3 * n).selectExpr(
        f"concat('C', id % {n}) AS customer_id", "make_date(2001, cast(id % 3 as int) + 1, 1) AS txn_date", "1.0D AS amount_myr")
    assert L.spend_cells(profile, days).count() == 4 * 3


def test_the_report_joins_the_transactions_once(spark, small_dir):
    plan = entry.queries()["dq_report"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_partkey" not in plan and "txn_id" in plan


# Features


def test_categories_off_the_list_count_exactly(spark):
    odd = [("a", 1.0, "ATM", f"odd {i % 7}") for i in range(50)] + [("a", 2.0, "Mobile App", "Dining")] * 3
    odd += [("b", None, None, None), ("b", 5.0, "QR Pay", "Fuel"), (None, 1.0, "ATM", "odd 1")]
    txns = spark.createDataFrame(odd, "customer_id string, amount_myr double, channel string, category string")
    found = {r["customer_id"]: tuple(r)[1:] for r in E.feat_txn(txns).collect()}
    assert found == {"a": (53, 1.06, 56.0, 8, 3), "b": (2, 5.0, 5.0, 1, 1), None: (1, 1.0, 1.0, 1, 0)}


# Tables over existing files


def test_attached_table_copies_nothing(spark, tmp_path):
    path = str(tmp_path / "given's")
    spark.range(10).selectExpr("id", "'x' AS name").write.parquet(path)
    before = sorted(p.name for p in (tmp_path / "given's").iterdir())
    assert tables.attach(spark, "attached_given", path).count() == 10
    tables.comment_on(spark, "attached_given", "It's ten rows")
    assert tables.comment_of(spark, "attached_given") == "It's ten rows"
    assert sorted(p.name for p in (tmp_path / "given's").iterdir()) == before
    tables.attach(spark, "attached_given", path)  # anew, the files stay
    spark.sql("DROP TABLE attached_given")
    assert sorted(p.name for p in (tmp_path / "given's").iterdir()) == before


def test_tags_reach_another_session(spark, tmp_path):
    path = str(tmp_path / "people")
    spark.createDataFrame([("Ann", "Central")], "name string, region string").write.parquet(path)
    tables.attach(spark, "tagged_people", path)
    tag_table(spark, "tagged_people", "name", "pii", "true")
    spark.sql("CREATE OR REPLACE VIEW tagged_view AS SELECT * FROM tagged_people")
    tag_table(spark, "tagged_view", "region", "pii", "it's")
    other = spark.newSession()
    assert tags_of(scan_tagged(other, "tagged_people").schema["name"]) == {"pii": "true"}
    assert tags_of(scan_tagged(other, "tagged_view").schema["region"]) == {"pii": "it's"}
    with pytest.raises(ValueError):
        tag_table(spark, "tagged_people", "age", "pii", "true")


# Views made from policies


@pytest.fixture()
def protected(spark, tmp_path):
    people = [("Ann", "a@x", "Central"), ("Bob", "b@x", "East Coast"), ("Cy", "c@x", None)]
    spark.createDataFrame(people, "name string, mail string, region string").write.parquet(str(tmp_path / "p"))
    tables.attach(spark, "people_base", str(tmp_path / "p"))
    user = spark.sql("SELECT current_user()").first()[0]
    members = [(user, "team_east_coast"), ("somebody", "team_central"), (user, "staff")]
    tables.write_table(spark.createDataFrame(members, "principal string, group_name string"), "people_members", str(tmp_path / "m"))
    rules = [G.MaskPolicy("hide"), G.RowFilterPolicy("rows")]
    tables.write_table(V.policy_rows(spark, rules), "people_policies", str(tmp_path / "r"))
    return lambda: V.protect(spark, "people_base", "people", "people_policies", "people_members")


def test_reader_of_the_name_gets_what_the_policies_allow(spark, protected):
    read = lambda s: sorted(map(tuple, s.sql("SELECT * FROM people").collect()), key=repr)
    protected()
    assert len(read(spark)) == 3  # nothing is tagged yet
    tag_table(spark, "people_base", "region", "region_filter", "true")
    tag_table(spark, "people_base", "name", "pii", "true")
    protected()
    assert read(spark) == read(spark.newSession()) == [(S.MASKED, "b@x", "East Coast")]
    tag_table(spark, "people_base", "mail", "pii", "true")  # a new tag, no new code
    tag_table(spark, "people_base", "region", "pii", "true")  # filtered on the raw value, then masked
    protected()
    assert read(spark) == [(S.MASKED, S.MASKED, S.MASKED)]
    plan = spark.table("people")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_policies_that_cannot_hold_are_refused(spark, protected):
    tag_table(spark, "people_base", "region", "region_filter", "true")
    tag_table(spark, "people_base", "name", "region_filter", "true")
    with pytest.raises(ValueError):
        protected()


def test_clean_drops_tables(spark, small_dir, bank):
    name = bank.store("customers", bank.customers)
    assert spark.catalog.tableExists(name)
    scratch.clean(spark)
    assert not spark.catalog.tableExists(name)


# States of checks


def _parts(spark, rows):
    return spark.createDataFrame(rows, "part string, id string, age int")


RULES = {"too_old": "age > 90", "missing_age": "age IS NULL"}


def _states(df):
    return K.part_states(df, "people", F.col("part"), {name: F.expr(rule) for name, rule in RULES.items()}, "id")


def _full(df):
    repeated = df.groupBy("id").count().filter("count > 1").count()
    broken = df.agg(*(F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items())).first()
    return sorted([("pk_unique", "people", repeated), *((name, "people", broken[name]) for name in RULES)])


@pytest.mark.parametrize("added, asked", [
    ([("d", "40", 5), ("d", "41", 99), ("d", "41", None)], []),  # a range of its own, with a repeat within
    ([("d", "25", 5), ("d", "40", 99)], ["c", "d"]),  # meets the range of c: a key of c again
    ([("d", "05", 95), ("d", "30", 1)], ["b", "c", "d"]),
    ([("d", None, 95), ("d", None, 1)], []),
])
def test_a_report_reads_only_what_it_must(spark, added, asked):
    old = _parts(spark, [("a", "01", 5), ("a", "02", 95), ("b", "11", None), ("b", "12", 3), ("c", "25", 4), ("c", "29", 4), ("c", "29", 1)])
    new = _parts(spark, added)
    stored = scratch.store(_states(old))  # the old parts are not read for these again
    whole, seen = old.unionByName(new), []

    def read(table, names):
        seen.extend(names)
        return whole.filter(F.col("part").isin(list(names))).select("id")

    states = scratch.store(stored.unionByName(_states(new)))
    assert sorted(map(tuple, K.report(states, {"people": "id"}, read).collect())) == _full(whole)
    assert sorted(seen) == asked
    assert K.row_counts(states).first()["row_count"] == whole.count()


def test_states_of_nothing(spark):
    states = scratch.store(_states(_parts(spark, [])))
    assert K.report(states, {"people": "id"}, None).count() == 0
