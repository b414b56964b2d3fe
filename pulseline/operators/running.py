"""Running values: one result per row, in arrival order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, text
from .ranges import RANGE, Ranges, plan_ranges, shuffled_once, split_hot, with_range
from .routing import is_sale

BEFORE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def running_sums(
    df: DataFrame, order: str, increments: dict[str, Column], *, key: str | None = None, ranges: Ranges | None = None
) -> DataFrame:
    """Adds running sums of `increments` in the order of the unique column `order`, over all rows or per key.

    Over all rows, the rows are cut into ranges and shuffled by range once: every range is summed up, the few range
    totals are turned into the carry of each range, and the running sum inside a range starts from its carry. Per key,
    a plain window does; only keys too large for one task are cut into ranges. Sums are exact for whole numbers and
    decimals.
    """
    ranges = ranges or plan_ranges(df, order, min_ranges=None if key is None else 1)
    if key is None:
        return _sums_in_ranges(with_range(df, order, ranges), [], order, increments)
    cold, hot = split_hot(df, key, order, ranges)
    window = Window.partitionBy(key).orderBy(order).rowsBetween(*UP_TO_HERE)
    result = cold.select("*", *[F.sum(c).over(window).alias(name) for name, c in increments.items()])
    if hot is None:
        return result
    return result.unionByName(_sums_in_ranges(hot, [key], order, increments))


def _sums_in_ranges(df: DataFrame, key: list[str], order: str, increments: dict[str, Column]) -> DataFrame:
    place = [*key, RANGE]
    rows = shuffled_once(df, *place)
    totals = rows.groupBy(*place).agg(*[F.sum(c).alias(name) for name, c in increments.items()])
    # One row per range (and hot key).
    earlier = Window.partitionBy(*key).orderBy(RANGE).rowsBetween(*BEFORE)
    carry = totals.select(*place, *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in increments])
    if not key:
        carry = F.broadcast(carry)
    inside = Window.partitionBy(*place).orderBy(order).rowsBetween(*UP_TO_HERE)

    def value(name):
        return F.sum(increments[name]).over(inside) + F.coalesce(F.col(f"_before_{name}"), F.lit(0))

    return rows.join(carry, place, "left").select(
        *[c for c in df.columns if c != RANGE], *[value(name).alias(name) for name in increments]
    )


def previous_value(
    df: DataFrame, order: str, column: str, name: str, *, key: str, ranges: Ranges | None = None
) -> DataFrame:
    """Adds the value `column` had in the row before, per key; a hot key's ranges carry their last value on."""
    ranges = ranges or plan_ranges(df, order, min_ranges=1)
    cold, hot = split_hot(df, key, order, ranges)
    result = cold.withColumn(name, F.lag(column).over(Window.partitionBy(key).orderBy(order)))
    if hot is None:
        return result
    place = [key, RANGE]
    hot = shuffled_once(hot, *place)
    last = hot.groupBy(*place).agg(F.max_by(column, order).alias("_last"))
    carry = last.select(*place, F.lag("_last").over(Window.partitionBy(key).orderBy(RANGE)).alias("_carry"))
    inside = Window.partitionBy(*place).orderBy(order)
    value = F.when(F.row_number().over(inside) == 1, F.col("_carry")).otherwise(F.lag(column).over(inside))
    return result.unionByName(hot.join(carry, place).withColumn(name, value).select(result.columns))


# `sums` is how running sums are made: over a whole frame, or for the next batch of a stream (`folds.RunningSums`).
Sums = Callable[..., DataFrame]


def running_sales_total(
    orders: DataFrame, statuses=codes.SALES_STATUSES, ranges: Ranges | None = None, sums: Sums = running_sums
) -> DataFrame:
    """Sales total after each sales order."""
    sales = orders.where(is_sale(statuses)).select("arrival", "id", "amount")
    return sums(sales, "arrival", {"total": F.col("amount")}, ranges=ranges)


def running_refund_total(orders: DataFrame, ranges: Ranges | None = None, sums: Sums = running_sums) -> DataFrame:
    """Refunded total after each completed refund."""
    return running_sales_total(orders, (codes.REFUNDED,), ranges, sums)


def running_order_count(
    orders: DataFrame, statuses=codes.SALES_STATUSES, ranges: Ranges | None = None, sums: Sums = running_sums
) -> DataFrame:
    """Number of sales orders after each of them."""
    sales = orders.where(is_sale(statuses)).select("arrival", "id")
    return sums(sales, "arrival", {"orders": F.lit(1)}, ranges=ranges)


def running_refund_requests(orders: DataFrame, ranges: Ranges | None = None, sums: Sums = running_sums) -> DataFrame:
    """Number of refund requests after each of them."""
    return running_order_count(orders, (codes.REFUND_REQUESTED,), ranges, sums)


def running_cancel_rate(orders: DataFrame, ranges: Ranges | None = None, sums: Sums = running_sums) -> DataFrame:
    """At each cancellation: the share of cancelled orders among all orders so far, as percent text."""
    cancelled = F.col("status") == codes.CANCELLED
    counts = sums(
        orders.select("arrival", "id", "status"),
        "arrival",
        {"cancels": F.when(cancelled, 1).otherwise(0), "orders": F.lit(1)},
        ranges=ranges,
    )
    return counts.where(cancelled).select(
        "arrival", "id", "cancels", "orders", text.percent_text(F.col("cancels"), F.col("orders")).alias("cancel_rate")
    )


def sku_running_quantity(
    details: DataFrame, min_events: int = 2, ranges: Ranges | None = None, sums: Sums = running_sums
) -> DataFrame:
    """Quantity of a product sold so far, from its `min_events`-th line on."""
    return _sku_running(details.select("arrival", "sku_id", "num"), "quantity", F.col("num"), min_events, ranges, sums)


def sku_running_amount(
    details: DataFrame, min_events: int = 2, ranges: Ranges | None = None, sums: Sums = running_sums
) -> DataFrame:
    """Amount of a product sold so far, from its `min_events`-th line on."""
    rows = details.select("arrival", "sku_id", "price", "num")
    return _sku_running(rows, "amount", line_amount(), min_events, ranges, sums)


def line_amount() -> Column:
    return F.col("price") * F.col("num")


def _sku_running(
    rows: DataFrame, name: str, increment: Column, min_events: int, ranges: Ranges | None, sums: Sums
) -> DataFrame:
    made = sums(rows, "arrival", {name: increment, "events": F.lit(1)}, key="sku_id", ranges=ranges)
    return made.where(F.col("events") >= min_events).select("arrival", "sku_id", "events", name)
