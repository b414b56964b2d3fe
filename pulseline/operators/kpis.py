"""Order figures as they stand after the last order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text
from .routing import is_sale


def order_totals() -> list[Column]:
    """The aggregates behind all figures; they can be computed partially and added up."""
    status = F.col("status")

    def amount(condition):
        return F.sum(F.when(condition, F.col("amount")))

    return [
        amount(is_sale()).alias("sales_total"),
        amount(status == codes.REFUNDED).alias("refund_total"),
        F.count_if(is_sale()).alias("sales"),
        F.count_if(status == codes.REFUND_REQUESTED).alias("refund_requests"),
        F.count("*").alias("orders"),
        F.count_if(status == codes.CANCELLED).alias("cancels"),
        F.max(F.when(status == codes.CANCELLED, F.col("arrival"))).alias("last_cancel"),
    ]


def order_kpis(orders: DataFrame) -> DataFrame:
    """One row of figures; `orders_at_cancel` counts the orders up to the last cancellation.

    One pass over the orders for all sums, and a second one that starts behind the last cancellation (the bound is
    known by then, so the scan can skip everything before it).
    """
    totals = orders.agg(F.struct(*order_totals()).alias("t")).scalar()
    later = orders.where(F.col("arrival") > totals["last_cancel"]).agg(F.count("*")).scalar()
    names = ["sales_total", "refund_total", "sales", "refund_requests", "orders", "cancels"]
    return orders.sparkSession.range(1, numPartitions=1).select(
        *[totals[name].alias(name) for name in names],
        F.when(totals["cancels"] > 0, totals["orders"] - later).alias("orders_at_cancel"),
    )


def kpi_values(kpis: DataFrame) -> DataFrame:
    """(key, value) rows of the latest-value table; a figure nothing has been seen for has no row."""
    rate = text.percent_text(F.col("cancels"), F.col("orders_at_cancel"))
    values = [
        (codes.KEY_SALES_TOTAL, text.money_text(F.col("sales_total"))),
        (codes.KEY_REFUND_TOTAL, text.money_text(F.col("refund_total"))),
        (codes.KEY_ORDER_COUNT, F.when(F.col("sales") > 0, F.col("sales").cast("string"))),
        (codes.KEY_REFUND_REQUESTS, F.when(F.col("refund_requests") > 0, F.col("refund_requests").cast("string"))),
        (codes.KEY_CANCEL_RATE, F.when(F.col("cancels") > 0, rate)),
    ]
    rows = F.array(*[F.struct(F.lit(key).alias("key"), value.alias("value")) for key, value in values])
    return kpis.select(F.inline(rows)).where(F.col("value").isNotNull())


def order_kpis_latest(orders: DataFrame) -> DataFrame:
    return kpi_values(order_kpis(orders))
