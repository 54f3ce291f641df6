from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators import governance as G
from bankspark.sources.tags import set_tag, tag_listing, tags_of

# Branches per region.
BRANCHES_PER_REGION = {"Central": 3, "Southern": 5, "Northern": 6, "East Coast": 5, "East Malaysia": 5}
MASK, ROWS = G.MaskPolicy("mask"), G.RowFilterPolicy("rows")


@pytest.fixture(scope="module")
def branches(spark):
    rows = [
        (f"B{region[:2]}{region[-2:]}{n}", f"{region} {n}", f"state {n}", region)
        for region, count in BRANCHES_PER_REGION.items() for n in range(count)
    ]
    return set_tag(
        spark.createDataFrame([*rows, ("B0", "Nowhere", "none", None)], S.BRANCHES),
        "region", "region_filter", "true")


@pytest.fixture(scope="module")
def members(spark):
    rows = [(i, "team_" + r.lower().replace(" ", "_")) for i, r in enumerate(BRANCHES_PER_REGION)]
    return spark.createDataFrame([*rows, (90, "staff"), (91, None), (92, "team_central"), (92, "team_northern")],
                                 S.GROUP_MEMBERS)


@pytest.mark.parametrize("principal, region", list(enumerate(BRANCHES_PER_REGION)))
def test_each_team_sees_its_own_branches(branches, members, principal, region):
    seen = G.enforce(branches, [ROWS], members, principal).collect()
    assert len(seen) == BRANCHES_PER_REGION[region]
    assert {r["region"] for r in seen} == {region}


@pytest.mark.parametrize("principal", [90, 91, 999])
def test_no_team_sees_nothing(branches, members, principal):
    assert G.enforce(branches, [ROWS], members, principal).count() == 0


def test_several_teams_add_up(branches, members):
    assert G.enforce(branches, [ROWS], members, 92).count() == 3 + 6


def test_any_number_of_groups_is_a_semi_join(spark, branches, members):
    many = spark.range(2000).selectExpr("92L AS principal", "concat('team_', id) AS group_name")
    seen = G.enforce(branches, [ROWS], members.select("principal", "group_name").union(many), 92)
    assert seen.count() == 3 + 6
    assert "LeftSemi" in seen._jdf.queryExecution().optimizedPlan().toString()


def test_filter_sees_raw_values_before_the_mask(branches, members):
    both = set_tag(branches, "region", "pii", "true")
    seen = G.enforce(both, [MASK, ROWS], members, 0).collect()
    assert len(seen) == 3
    assert {r["region"] for r in seen} == {S.MASKED}


def test_two_row_filters_are_refused(branches, members):
    with pytest.raises(ValueError, match="more than one row filter"):
        G.enforce(branches, [ROWS, G.RowFilterPolicy("again")], members, 0)


def test_visibility_and_coverage(spark, branches, members):
    seen = {r[0]: r[1] for r in G.branch_visibility(branches).collect()}
    assert seen == {"team_" + r.lower().replace(" ", "_"): n for r, n in BRANCHES_PER_REGION.items()}
    principals = spark.createDataFrame([(p,) for p in (0, 1, 90, 92, 999)], "principal bigint")
    assert {tuple(r) for r in G.group_coverage(principals, members).collect()} == {(90, 0), (92, 2), (999, 0)}


@pytest.fixture(scope="module")
def people(spark):
    df = spark.createDataFrame(
        [(1, "Ann", "Central"), (2, None, None), (3, "Bo", "Northern")], "id int, name string, region string")
    return set_tag(df, "region", "pii", "true")


def test_mask_follows_the_tag(people):
    rows = G.mask_by_tag(people, [MASK]).orderBy("id").collect()
    assert [r["region"] for r in rows] == [S.MASKED] * 3
    assert [r["name"] for r in rows] == ["Ann", None, "Bo"]
    again = G.mask_by_tag(set_tag(people, "name", "pii", "true"), [MASK]).orderBy("id").collect()
    assert [r["name"] for r in again] == [S.MASKED] * 3


def test_other_tag_values_do_not_match(people):
    off = set_tag(people, "region", "pii", "false")
    assert G.mask_by_tag(off, [MASK]).collect() == people.collect()


def test_masked_column_keeps_its_tag_and_masking_twice_changes_nothing(people):
    once = G.mask_by_tag(people, [MASK])
    assert tags_of(once.schema["region"]) == {"pii": "true"}
    assert G.mask_by_tag(once, [MASK]).collect() == once.collect()


def test_what_is_derived_after_enforcement_is_masked(people, members):
    named = set_tag(people, "name", "pii", "true")
    derived = G.enforce(named, [MASK], members, 0).select(F.upper("name").alias("shout")).collect()
    assert {r["shout"] for r in derived} == {S.MASKED}
    # the expression itself carries no tag, which is why enforcement comes first
    assert tags_of(named.select(F.upper("name").alias("shout")).schema["shout"]) == {}


def test_only_text_can_be_masked(people):
    with pytest.raises(TypeError):
        G.mask_by_tag(set_tag(people, "id", "pii", "true"), [MASK])


def test_tags_survive_select_filter_join_and_list(spark, people):
    joined = people.filter("id > 0").select("id", "region").join(people.select("id", "name"), "id")
    assert tags_of(joined.schema["region"]) == {"pii": "true"}
    tagged = set_tag(people, "region", "region_filter", "true")
    listed = {tuple(r) for r in tag_listing({"people": tagged}).collect()}
    assert listed == {("people", "region", "pii", "true"), ("people", "region", "region_filter", "true")}


def test_stored_table_keeps_tags(spark, people):
    people.write.mode("overwrite").saveAsTable("tagged_people")
    assert tags_of(spark.table("tagged_people").schema["region"]) == {"pii": "true"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(regions=st.lists(st.sampled_from([*BRANCHES_PER_REGION, None]), min_size=1, max_size=20),
       principal=st.integers(0, 6))
def test_filter_returns_a_part_of_its_input(spark, members, regions, principal):
    df = set_tag(spark.createDataFrame(list(enumerate(regions)), "id int, region string"),
                 "region", "region_filter", "true")
    seen = {tuple(r) for r in G.enforce(df, [ROWS], members, principal).collect()}
    own = list(BRANCHES_PER_REGION)[principal] if principal < 5 else None
    assert seen == {(i, r) for i, r in enumerate(regions) if r is not None and r == own}
