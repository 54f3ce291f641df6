"""Every registered query against its independent SQL twin, on the whole given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from bankspark.plans import registered, twins
from tests.compare import difference, given_views

QUERIES = registered.queries()
TWINS = twins.oracle_sql()
ROWS_ONLY = {"ml_leaderboard", "ml_search", "ml_batch_score", "ml_offer_actions"}


@pytest.fixture(scope="module")
def con(small_dir):
    return given_views(small_dir)


def test_twins_cover_all_but_the_known_queries():
    assert set(QUERIES) - set(TWINS) == ROWS_ONLY
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_matches_its_twin(spark, con, small_dir, name):
    assert difference(QUERIES[name](spark, small_dir), con, TWINS[name]) is None


def test_entry_has_the_feature_columns(spark):
    from bankspark.operators.features import FEATURE_COLUMNS

    df = entry.entry(spark)
    assert df.columns == FEATURE_COLUMNS
    assert len(df.columns) == 23
    assert df.count() == 150
