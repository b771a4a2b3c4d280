"""Plans that must hold at scale, whatever the test data size."""

import pytest

import tidemark.plans.queries  # noqa: F401
from tidemark.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(QUERIES["revenue_by_region"](spark, FOLDER))
    orders = next(part for part in text.split("Scan parquet") if "o_orderstatus" in part and "PushedFilters" in part)
    assert "EqualTo(o_orderstatus,F)" in orders and "GreaterThanOrEqual(o_orderdate" in orders
    assert "o_orderpriority" not in orders.split("ReadSchema")[1].split("\n")[0]


def test_time_range_is_folded_and_pushed(spark, plan):
    text = plan(QUERIES["time_ranges"](spark, FOLDER))
    assert text.count("GreaterThanOrEqual(o_orderdate,1998") == 4


def test_top_per_group_is_cut_before_the_shuffle(spark, plan):
    for name in ("top_per_group", "latest_per_key", "qualify_rank", "dedup_candidates"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, FOLDER)), name


@pytest.mark.parametrize("name", ["top3_products", "top_customers", "recent_events", "union_topk", "keyword_search", "metric_ranking"])
def test_top_k_keeps_k_rows_per_task(spark, plan, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_row_python(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert node not in text, node


def test_large_sides_are_not_broadcast(spark, plan):
    """With the size check failing, nothing but literal relations is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("join_inner", "star_fact", "scd1_merge", "scd2_apply", "monthly_rollup", "version_number"):
            text = plan(QUERIES[name](spark, FOLDER))
            assert "BroadcastHashJoin" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_do_not_round_what_they_add(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.numbers import exact_avg, exact_sum
    from tidemark.plans.warehouse import bronze_orders

    landing = spark.createDataFrame([("1", "p", "c", 1000, 0.125, "2024-01-02", "r")], "order_id string, product_id string, customer_id string, quantity int, price_per_unit double, order_date string, region string")
    assert bronze_orders(landing, F.lit("2024-01-01").cast("timestamp")).first().total_price == 125.0
    sales = spark.createDataFrame([(x,) for x in (3735.138, 443.4228, 2097.27, 732.38, 994.7052)], "v double")
    assert sales.agg(exact_sum("v")).first()[0] == 8002.916
    odd = spark.createDataFrame([(1.5,), (float("nan"),), (None,), (float("inf"),)], "v double")
    assert odd.agg(exact_sum("v"), exact_avg("v")).first() == (1.5, 1.5)
