from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pyspark.sql.functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bankspark.functions.money import avg_money, half_up, ratio2, sum_money

AMOUNTS = st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30)
QUIET = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUIET
@given(cents=AMOUNTS)
def test_sum_and_average_are_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    total, mean = df.agg(sum_money("x"), avg_money("x")).first()
    exact = Decimal(sum(cents)) / 100
    assert total == float(exact)
    assert mean == float((exact / len(cents)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_ties_go_away_from_zero(spark):
    row = spark.range(1).select(
        half_up(F.lit(5), F.lit(2)), half_up(F.lit(-5), F.lit(2)), half_up(F.lit(1), F.lit(0)),
        ratio2(F.lit(1), F.lit(8)), ratio2(F.lit(29), F.lit(200)),
    ).first()
    assert tuple(row) == (3, -3, None, 0.13, 0.15)


def test_nulls_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert tuple(df.agg(sum_money("x"), avg_money("x")).first()) == (3.0, 1.5)
    assert tuple(df.filter("x > 9").agg(sum_money("x"), avg_money("x")).first()) == (None, None)


def test_a_sum_is_rounded_once(spark):
    df = spark.range(1000).selectExpr("0.004D AS x", "-0.0049D AS y")
    assert tuple(df.agg(sum_money("x"), avg_money("x"), sum_money("y")).first()) == (4.0, 0.0, -4.9)
    assert spark.range(1).selectExpr("0.125D AS x").agg(sum_money("x")).first()[0] == 0.13
