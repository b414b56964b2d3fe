from __future__ import annotations

import random

import pytest
from line_rows import order_line, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulseline.operators import decode, kpis, running, topk
from pulseline.operators import ranges as ranges_module
from pulseline.operators.ranges import RANGE, plan_ranges, with_range


@pytest.fixture(scope="module")
def sequence(spark):
    """Arrival numbers with gaps and a dense stretch; one key holds a third of all rows."""
    picker = random.Random(7)
    numbers = sorted(picker.sample(range(1_000_000), 1500) + list(range(2_000_000, 2_001_500)))
    made = [(n, "hot" if picker.random() < 0.34 else f"k{picker.randrange(300)}", picker.randrange(-50, 1000)) for n in numbers]
    return spark.createDataFrame(made, "arrival bigint, key string, cents int").select(
        "arrival", "key", (F.col("cents") / 100).cast("decimal(18,2)").alias("amount"),
        F.when(F.col("cents") % 3 == 0, "运行").otherwise("待机").alias("status"),
    ).repartition(5).persist()


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_running_sums_over_all_rows(sequence, ranges):
    cuts = plan_ranges(sequence, "arrival", target_rows=10_000, min_ranges=ranges)
    got = running.running_sums(sequence, "arrival", {"total": F.col("amount"), "n": F.lit(1)}, ranges=cuts)
    window = Window.orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    want = sequence.select("*", F.sum("amount").over(window).alias("total"), F.sum(F.lit(1)).over(window).alias("n"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("target", [50, 400, 10_000])
def test_running_sums_per_key_with_hot_keys(sequence, target):
    cuts = plan_ranges(sequence, "arrival", target_rows=target, min_ranges=1)
    got = running.running_sums(sequence, "arrival", {"total": F.col("amount")}, key="key", ranges=cuts)
    window = Window.partitionBy("key").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    want = sequence.withColumn("total", F.sum("amount").over(window))
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("target", [50, 400, 10_000])
def test_previous_value_with_hot_keys(sequence, target):
    cuts = plan_ranges(sequence, "arrival", target_rows=target, min_ranges=1)
    got = running.previous_value(sequence, "arrival", "status", "previous", key="key", ranges=cuts)
    want = sequence.withColumn("previous", F.lag("status").over(Window.partitionBy("key").orderBy("arrival")))
    assert rows(got.select(want.columns)) == rows(want)


def test_ranges_hold_similar_numbers_of_rows(sequence):
    cuts = plan_ranges(sequence, "arrival", target_rows=100, min_ranges=1)
    sizes = [r[0] for r in with_range(sequence, "arrival", cuts).groupBy(RANGE).count().select("count").collect()]
    assert cuts.count == 30 and len(sizes) == 30
    assert max(sizes) <= 200
    assert plan_ranges(sequence, "arrival", target_rows=10, min_ranges=1).count > 200


def test_ranges_follow_the_order(sequence):
    cuts = plan_ranges(sequence, "arrival", target_rows=100, min_ranges=1)
    tagged = with_range(sequence, "arrival", cuts)
    bounds = tagged.groupBy(RANGE).agg(F.min("arrival"), F.max("arrival")).orderBy(RANGE).collect()
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def orders_of(lines, *statuses, amounts=None, users=None):
    amounts, users = amounts or ["10.00"] * len(statuses), users or ["7"] * len(statuses)
    made = [order_line(id=i, status=s, amount=a, user=u) for i, (s, a, u) in enumerate(zip(statuses, amounts, users))]
    return decode.decode_orders(lines(made)).rows


def test_empty_input(lines):
    orders = orders_of(lines, "1003")
    assert running.running_sales_total(orders).count() == 0
    assert topk.top_k_text(topk.user_spend(orders), 2, "k").count() == 0
    none = orders.where("false")
    assert kpis.order_kpis_latest(none).count() == 0


def test_running_sums_are_exact(lines):
    got = running.running_sales_total(orders_of(lines, "1001", "1002", amounts=["0.10", "0.20"]))
    assert [str(r.total) for r in got.orderBy("arrival").collect()] == ["0.10", "0.30"]


def test_cancel_rate_is_emitted_at_cancellations(lines):
    orders = orders_of(lines, "1001", "1003", "1001", "1001")
    assert [r.cancel_rate for r in running.running_cancel_rate(orders).collect()] == ["50.0%"]
    assert dict(rows(kpis.order_kpis_latest(orders)))["cancelrate"] == "50.0%"


def test_cancel_rate_rounds_half_up(lines):
    orders = orders_of(lines, *["1001"] * 15, "1003")
    assert [r.cancel_rate for r in running.running_cancel_rate(orders).collect()] == ["6.3%"]


def test_figures_without_orders_of_a_kind_are_left_out(lines):
    assert rows(kpis.order_kpis_latest(orders_of(lines, "1001", "1005"))) == [
        ("refundcountminute", "1"), ("totalcount", "1"), ("totalprice", "10.00"),
    ]


def test_money_is_never_in_scientific_notation(lines):
    orders = orders_of(lines, "1001", amounts=["19786518"])
    assert dict(rows(kpis.order_kpis_latest(orders)))["totalprice"] == "19786518.00"


def test_top_users(lines):
    one = orders_of(lines, "1001", "1001")
    assert topk.top_k_text(topk.user_spend(one), 2, "top").count() == 0
    tied = orders_of(lines, "1001", "1001", "1001", amounts=["5", "5", "1"], users=["9", "8", "7"])
    assert rows(topk.top_k_text(topk.user_spend(tied), 2, "top")) == [("top", "[8:ann:5.00,9:ann:5.00]")]


def details_of(lines, *items):
    made = [f"{i},1,{sku},sku,{price},{num},2020-4-25 18:47:14" for i, (sku, price, num) in enumerate(items)]
    return decode.decode_order_details(lines(made)).rows


def test_first_event_of_a_product_is_swallowed(lines):
    details = details_of(lines, ("a", "1.50", 2), ("b", "1", 1), ("a", "2.25", 3))
    assert rows(running.sku_running_quantity(details)) == [(2, "a", 2, 5)]
    assert [str(r.amount) for r in running.sku_running_amount(details).collect()] == ["9.75"]
    assert rows(topk.sku_quantity(details)) == [("a", 5)]
    assert running.sku_running_quantity(details, min_events=1).count() == 3


def test_top_products_need_three(lines):
    two = [("a", "1", 1), ("a", "1", 1), ("b", "1", 1), ("b", "1", 1)]
    assert topk.top_k_text(topk.sku_quantity(details_of(lines, *two)), 3, "t").count() == 0
    three = [*two, ("c", "9", 1), ("c", "9", 1), ("d", "100", 100)]
    details = details_of(lines, *three)
    assert rows(topk.top_k_text(topk.sku_quantity(details), 3, "t")) == [("t", "[a:2,b:2,c:2]")]
    assert rows(topk.top_k_text(topk.sku_amount(details), 3, "t")) == [("t", "[c:18.00,a:2.00,b:2.00]")]


def test_the_driver_holds_a_bounded_number_of_cuts(sequence, monkeypatch):
    """More ranges than that lie evenly between fewer cuts, in the order of the rows."""
    monkeypatch.setattr(ranges_module, "MAX_CUTS", 8, raising=False)
    cuts = plan_ranges(sequence, "arrival", target_rows=100, min_ranges=1)
    assert len(cuts.cuts) < 8 and 30 <= cuts.count <= 60
    tagged = with_range(sequence, "arrival", cuts)
    assert tagged.columns == [*sequence.columns, RANGE]
    bounds = tagged.groupBy(RANGE).agg(F.min("arrival"), F.max("arrival"), F.count("*")).orderBy(RANGE).collect()
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))
    assert len(bounds) >= 25 and sum(b[3] for b in bounds) == 3000 and max(b[3] for b in bounds) <= 2 * 3000 / 8
    unknown = sequence.limit(5).withColumn("arrival", F.lit(None).cast("bigint"))
    assert [r[0] for r in with_range(unknown, "arrival", cuts).select(RANGE).collect()] == [None] * 5


@pytest.mark.parametrize("sent", [0, 1, 100])
def test_many_hot_keys_stay_off_the_driver(sequence, monkeypatch, sent):
    """Up to a number of them are broadcast, more are joined; either way the sums are right."""
    monkeypatch.setattr(ranges_module, "MAX_CUTS", 8, raising=False)
    monkeypatch.setattr(ranges_module, "MAX_SENT_KEYS", sent, raising=False)
    cuts = plan_ranges(sequence, "arrival", target_rows=50, min_ranges=1)
    got = running.running_sums(sequence, "arrival", {"total": F.col("amount")}, key="key", ranges=cuts)
    window = Window.partitionBy("key").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    want = sequence.withColumn("total", F.sum("amount").over(window))
    assert rows(got.select(want.columns)) == rows(want)
    hot = ranges_module.hot_keys(sequence, "key", cuts)
    plan = hot._jdf.queryExecution().analyzed().toString()
    assert ("strategy=broadcast" in plan) == (hot.count() <= sent) and "LogicalRDD" in plan
