"""Shapes of physical plans that matter at scale."""

import re

import pytest

from tablestream.plans import QUERIES

DATA = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "roundtrip_"))]


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(spark, name) for name in BATCH}


def test_no_product_of_tables(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_python_only_in_the_cooldown(plans):
    for name, text in plans.items():
        has_python = "InPandas" in text or "EvalPython" in text
        assert has_python == (name == "cooldown_alerts"), name


@pytest.mark.parametrize(
    "name",
    ["metric_stats", "hourly_stats_of_stats", "null_profile", "range_profile", "daily_summary",
     "key_comparison_wide", "moving_average_7", "trend_slope", "dead_letter_split",
     "availability_rollup", "alert_all_rules"],
)
def test_one_scan(plans, name):
    assert plans[name].count("FileScan") == 1


def test_top_rows_are_not_sorted_in_full(plans):
    for name in ("top_leads", "newest_readings", "first_orders"):
        assert "TakeOrderedAndProject" in plans[name], name
    assert "WindowGroupLimit" in plans["top_products_per_region"]


def test_small_dimensions_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["sales_by_region_product"]


def test_filters_and_columns_reach_the_scan(plans):
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plans["newest_readings"]
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in plans["availability_rollup"]
    read = re.findall(r"ReadSchema: (struct<[^\n]*>)", plans["sales_by_region_product"])
    assert "struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in read


def test_no_sort_before_wide_aggregates(plans):
    for name in ("metric_stats", "daily_summary", "customer_order_stats", "click_rollup"):
        assert "SortAggregate" not in plans[name], name
