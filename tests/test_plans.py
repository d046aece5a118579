"""Plan-shape assertions: the physical plans we want at scale."""

import os

import pytest

import __spark_entry__ as E
from valuekit.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF)) for name, fn in QUERIES.items()}


def test_no_python_udf_cross_join_or_nested_loop(plans):
    for name, p in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, f"{name} has {bad}"


def test_topk_uses_window_group_limit(plans):
    assert "WindowGroupLimit" in plans["q20_topk_per_group"]


def test_tier_score_broadcasts_the_bounded_tier_table(plans):
    p = plans["q24_tier_value_score"]
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_prefer_aggregate_is_anti_join_without_window(plans):
    p = plans["q05_prefer_aggregate"]
    assert "LeftAnti" in p and "Window" not in p


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_are_broadcast(spark):
    # derived dimensions: AQE turns the joins into broadcasts once it has seen their size
    q = E.queries()
    assert "BroadcastHashJoin" in final_plan(q["q11_normalize_to_cap"](spark, SF))
    assert final_plan(q["q12_unify"](spark, SF)).count("BroadcastHashJoin") >= 2
    # small stored dimensions likewise
    assert "BroadcastHashJoin" in final_plan(q["q10_map_lookup"](spark, SF))


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["q04_range_to_null"](spark, SF)
    p = plan_of(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double," in p
    assert "l_returnflag" not in p.split("ReadSchema")[1].split("\n")[0]
    q = plan_of(E.queries()["q16_per36"](spark, SF))
    assert "Filter" in q
