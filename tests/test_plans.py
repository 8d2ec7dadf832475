"""What the physical plans must (not) contain."""

import re

import pytest
from pyspark.sql import functions as F

from tidemill.catalog import load_all
from tidemill.operators.ordered import row_numbers

REGISTRY = load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(REGISTRY["c02_filters"].build(tables))
    assert re.search(r"PushedFilters: \[(?!\])", text)
    assert "o_orderdate" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_named_partition_is_pruned(tables):
    text = plan(REGISTRY["c14_one_partition"].build(tables))
    assert re.search(r"PartitionFilters: \[[^\]]*event_type", text)


def test_range_filter_is_pushed_to_the_sorted_layout(tables):
    text = plan(REGISTRY["k28_skipping_layout"].build(tables))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert "l_partkey" in pushed and "l_suppkey" in pushed


@pytest.mark.parametrize("name", ["f09_newest_per_key", "f10_top_n"])
def test_rank_limit_is_applied_before_the_shuffle(tables, name):
    text = plan(REGISTRY[name].build(tables))
    assert text.count("WindowGroupLimit") == 2


def test_top_k_needs_no_global_sort(tables):
    assert "TakeOrderedAndProject" in plan(REGISTRY["g04_top_k"].build(tables))


@pytest.mark.parametrize("name", [
    "c10_not_exists", "d05_comma_join", "d07_interval_join", "d08_orders_shipments",
    "d11_temporal_join", "d17_priced_deals", "e04_count_distinct", "e08_listagg_ordered",
    "f01_row_number", "f03_lead_lag", "f07_running_last_value", "k05_op_merge", "k11_changelog",
    "l02_route_sites",
])
def test_no_cross_join_and_no_python(tables, name):
    text = plan(REGISTRY[name].build(tables))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert banned not in text


@pytest.mark.parametrize("name", ["e04_count_distinct", "e12_cube", "g06_two_phase", "e15_partial_final"])
def test_rows_are_combined_before_the_shuffle(tables, name):
    assert "partial_" in plan(REGISTRY[name].build(tables))


def test_range_chunks_need_no_single_partition_for_rows(spark, tables):
    out = row_numbers(tables.orders.select("o_orderkey"), [], [F.col("o_orderkey")])
    singles = [line for line in plan(out).split("\n") if "Exchange SinglePartition" in line]
    # only the chunk counts meet in one task
    assert len(singles) == 1 and "partial_count" in plan(out)


def test_windows_without_hot_keys_scan_once(spark, tables):
    from tidemill.catalog import load_all

    for name, scans in (("f01_row_number", 1), ("f03_lead_lag", 1), ("f07_running_last_value", 1),
                        ("d11_temporal_join", 2)):
        plan = load_all()[name].build(tables)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= scans, name
