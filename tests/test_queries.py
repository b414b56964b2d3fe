"""The registered queries against DuckDB, and the shape of their plans."""

from __future__ import annotations

import pytest
from line_rows import TESTDATA

import __spark_entry__ as contract
from check_oracle import compare, connect
from pulseline.plans.queries import QUERIES
from pulseline.plans.stream_queries import STREAM_QUERIES

SF = str(TESTDATA / "sf0.001")
NAMES = [*QUERIES, *STREAM_QUERIES]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, SF)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.find("== Initial Plan ==")]


@pytest.mark.parametrize("name", ["running_sales_total", "running_order_count", "running_cancel_rate"])
def test_running_values_shuffle_the_rows_once(spark, name):
    """Rows go through one shuffle by range that both uses read; only range totals meet in one task."""
    plan = final_plan(contract.queries()[name](spark, SF))
    by_range = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(by_range) == 2
    assert sum("ReusedExchange" in line for line in by_range) == 1
    single = plan.count("SinglePartition")
    assert single == 1
    below = plan[plan.index("SinglePartition"):].splitlines()[1]
    assert "HashAggregate" in below


@pytest.mark.parametrize(
    "name",
    ["produce_count_filtered", "warning_count_tumbling", "warning_top_sliding", "user_spend", "sku_running_amount",
     "transitions_to_running", "order_detail_latest", "hold_alerts_status"],
)
def test_rows_never_meet_in_one_task(spark, name):
    df = contract.queries()[name](spark, SF)
    plan = final_plan(df)
    for piece in plan.split("SinglePartition")[1:]:
        assert "HashAggregate" in piece.splitlines()[1]


def test_latest_figures_scan_the_tail_only(spark):
    """The second pass starts behind the last cancellation, and the scan knows."""
    plan = final_plan(contract.queries()["order_kpis_latest"](spark, SF))
    assert "ReusedSubquery" in plan


def test_windows_aggregate_before_the_shuffle(spark):
    plan = final_plan(contract.queries()["produce_count_filtered"](spark, SF))
    assert "partial_count" in plan


def test_only_needed_columns_are_read(spark):
    df = contract.queries()["warning_count_tumbling"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "value" not in schema


def test_sliding_windows_copy_counts_not_rows(spark):
    """What is copied into every window is the count of a pane."""
    plan = final_plan(contract.queries()["warning_top_sliding"](spark, SF))
    below = plan.split("Expand")[1:]
    assert below and all("partial_count" in part for part in below)
