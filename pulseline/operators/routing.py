"""Filters, and the split of orders into named routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes

# Route of each status; orders of any other status have none.
SALES, CANCELLED, REFUND_REQUESTED, REFUNDED = "sales", "cancelled", "refund_requested", "refunded"


def is_sale(statuses: tuple[str, ...] = codes.SALES_STATUSES) -> Column:
    return F.col("status").isin(*statuses)


def sales_orders(orders: DataFrame, statuses: tuple[str, ...] = codes.SALES_STATUSES) -> DataFrame:
    return orders.where(is_sale(statuses))


def passed_products(produce: DataFrame) -> DataFrame:
    return produce.where(F.col("passed") == codes.PASSED)


def warnings(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("status") == codes.WARNING)


def flagged_warnings(changes: DataFrame) -> DataFrame:
    """Warnings whose flag is even."""
    return warnings(changes).where(F.col("flag") % 2 == 0)


def route_orders(orders: DataFrame) -> DataFrame:
    """One pass over the orders that adds the `route` column and drops orders without a route."""
    status = F.col("status")
    route = (
        F.when(is_sale(), SALES)
        .when(status == codes.CANCELLED, CANCELLED)
        .when(status == codes.REFUND_REQUESTED, REFUND_REQUESTED)
        .when(status == codes.REFUNDED, REFUNDED)
    )
    return orders.withColumn("route", route).where(F.col("route").isNotNull())


def take_route(routed: DataFrame, route: str) -> DataFrame:
    return routed.where(F.col("route") == route).drop("route")


def cancelled_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == codes.CANCELLED)
