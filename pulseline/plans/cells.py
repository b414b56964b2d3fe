"""Product rows as the text cells that row stores and database tables hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text
from ..operators import joins


def cancelled_cells(orders: DataFrame) -> DataFrame:
    """The five cells of the order table."""
    return orders.select("id", "consignee", "consignee_tel", text.money_text(F.col("amount")).alias("amount"), "freight")


def order_cells(orders: DataFrame) -> DataFrame:
    """Order cells under the order id; `arrival` decides which row of an id is the last."""
    key = F.col("id").cast("string")
    return orders.select(
        key.alias("row_key"),
        key.alias("id"),
        "consignee",
        text.money_text(F.col("amount")).alias("final_total_amount"),
        F.col("status").alias("order_status"),
        "user_id",
        text.time_text(F.col("create_time")).alias("create_time"),
        text.time_text(F.col("operation_time")).alias("operation_time"),
        "arrival",
    )


def join_cells(pairs: DataFrame, *order: str) -> DataFrame:
    """The cells of (order, detail) pairs under the order id; the `order` columns decide which pair is the last."""
    key = F.col("id").cast("string")
    cells = joins.pair_cells(pairs, *order)
    return cells.select(key.alias("row_key"), key.alias("id"), "orderprice", "orderdetailcount", *order)


def warning_cells(counts: DataFrame) -> DataFrame:
    """The three cells of the warning table."""
    return counts.select("machine_id", F.col("cnt").cast("string").alias("cnt"), F.col("window_end_text").alias("window_end"))


def transition_cells(transitions: DataFrame) -> DataFrame:
    """The four cells of the transition table."""
    return transitions.select(
        "machine_id",
        F.col("previous").alias("last_status"),
        F.col("changes").cast("string").alias("changes"),
        text.time_text(F.col("change_time")).alias("change_time"),
    )


def temperature_cells(alerts: DataFrame) -> DataFrame:
    """The cells of a temperature alert under `machine-time`."""
    time = text.time_text(F.col("alert_time"))
    return alerts.select(
        F.concat_ws("-", "machine_id", time).alias("row_key"), "machine_id", time.alias("out_warning_time"), "alert_time"
    )


def warning_held_values(alerts: DataFrame) -> DataFrame:
    """(key, field, value) rows: machine to message; `alert_time` decides which is the last."""
    return alerts.select(
        F.lit(codes.HASH_WARNING_HELD).alias("key"),
        F.col("machine_id").alias("field"),
        F.col("message").alias("value"),
        "alert_time",
    )
