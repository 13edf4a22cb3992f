"""What the plans must and must not hold."""

import pytest
from conftest import SMALL

from pagetables.plans import catalog  # noqa: F401
from pagetables.plans.registry import PLANS


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize(
    "name",
    ["link_frontier", "crawl_schedule", "robots_verdict", "update_by_key", "reconcile_sources", "flat_product",
     "unique_violations", "missing_keys", "lookup_batch", "harvest_growth", "assign_ids"],
)
def test_no_cross_joins(spark, name):
    plan = plan_of(PLANS[name].build(spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_lookup_reaches_the_scan(spark):
    plan = plan_of(PLANS["lookup_by_key"].build(spark, SMALL))
    assert "EqualTo(o_orderkey,1000)" in plan.split("PushedFilters")[1].splitlines()[0]
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan
    assert "Exchange" not in plan


def test_state_is_parsed_once(spark):
    assert plan_of(PLANS["flat_product"].build(spark, SMALL)).count("from_json(") <= 2  # node and its output list


@pytest.mark.parametrize("name", ["json_path", "int_coercion", "api_response_filter", "fixed_columns", "link_suffix"])
def test_narrow_jobs_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(PLANS[name].build(spark, SMALL))


def test_frontier_combines_before_the_shuffle(spark):
    plan = plan_of(PLANS["link_frontier"].build(spark, SMALL))
    assert "partial_min" in plan


@pytest.mark.parametrize("name", ["lookup_batch", "delete_by_key", "missing_keys"])
def test_keys_are_reduced_before_their_shuffle(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(PLANS[name].build(spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    tree = plan.split("\n\n")[0]
    assert "HashAggregate" in tree
    assert tree.count("Exchange") == 2  # one per side of the join
