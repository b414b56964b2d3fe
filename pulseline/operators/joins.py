"""Orders joined with their detail lines inside the same time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def _orders_side(orders: DataFrame, size: str, time: str) -> DataFrame:
    return orders.select(F.col("id"), F.window(time, size).alias("w"), F.col("amount"), F.col("arrival").alias("o_arrival"))


def _details_side(details: DataFrame, size: str, time: str) -> DataFrame:
    return details.select(
        F.col("order_id").alias("id"), F.window(time, size).alias("w"), F.col("num"), F.col("arrival").alias("d_arrival")
    )


# Which of two pairs of an order is written later.
PAIR_ORDER = ["w", "o_arrival", "d_arrival"]


def pair_cells(pairs: DataFrame, *kept: str) -> DataFrame:
    return pairs.select(
        "id",
        *kept,
        text.money_text(F.col("amount")).alias("orderprice"),
        F.col("num").cast("string").alias("orderdetailcount"),
    )


def order_detail_window_join(
    orders: DataFrame, details: DataFrame, size: str = "1 second", *, time: str = "arrival_ts"
) -> DataFrame:
    """Every (order, detail) pair with the same order id and window: (id, orderprice, orderdetailcount).

    An equi-join on both; adaptive execution picks the join and splits skewed partitions.
    """
    return pair_cells(order_detail_pairs(orders, details, size, time=time))


def order_detail_pairs(orders: DataFrame, details: DataFrame, size: str = "1 second", *, time: str = "arrival_ts"):
    """The pairs with the columns that order them. Streams carry a watermark on `time` on both sides.

    They meet on the last instant of the window, since a stream's state holds the keys of each row several times.
    """

    def narrow(side: DataFrame) -> DataFrame:
        return side.withColumn("w", F.window_time("w"))

    pairs = narrow(_orders_side(orders, size, time)).join(narrow(_details_side(details, size, time)), ["id", "w"])
    return pairs.withColumn("w", F.window("w", size))


def order_detail_latest(
    orders: DataFrame, details: DataFrame, size: str = "1 second", *, time: str = "arrival_ts"
) -> DataFrame:
    """The pair that is written last per order id: (id, amount, num).

    That is the last order row and the last detail row of the latest window that has both, so each side is reduced
    to one row per id and window before the join instead of joining all pairs.
    """

    def last(side: DataFrame, value: str, arrival: str) -> DataFrame:
        return side.groupBy("id", "w").agg(F.max_by(value, arrival).alias(value))

    left = last(_orders_side(orders, size, time), "amount", "o_arrival")
    right = last(_details_side(details, size, time), "num", "d_arrival")
    latest = left.join(right, ["id", "w"]).groupBy("id").agg(F.max_by(F.struct("amount", "num"), "w").alias("last"))
    return latest.select("id", "last.amount", "last.num")
