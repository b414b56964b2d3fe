"""Top-k of per-key sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .routing import sales_orders
from .running import line_amount


def user_spend(orders: DataFrame) -> DataFrame:
    """Amount spent per user, keyed `user_id:consignee`."""
    key = F.concat("user_id", F.lit(":"), "consignee")
    return sales_orders(orders).groupBy(key.alias("key")).agg(F.sum("amount").alias("value"))


def sku_sums(details: DataFrame, min_events: int = 2) -> DataFrame:
    """Quantity and amount sold per product with at least `min_events` lines."""
    sums = details.groupBy(F.col("sku_id").alias("key")).agg(
        F.sum("num").alias("quantity"), F.sum(line_amount()).alias("amount"), F.count("*").alias("events")
    )
    return sums.where(F.col("events") >= min_events)


def sku_quantity(details: DataFrame, min_events: int = 2) -> DataFrame:
    return sku_sums(details, min_events).select("key", F.col("quantity").alias("value"))


def sku_amount(details: DataFrame, min_events: int = 2) -> DataFrame:
    return sku_sums(details, min_events).select("key", F.col("amount").alias("value"))


def top_k(sums: DataFrame, k: int) -> DataFrame:
    """The k largest (key, value) rows, ties by key; each task keeps k rows only."""
    return sums.orderBy(F.desc("value"), F.asc("key")).limit(k)


def top_k_text(sums: DataFrame, k: int, name: str) -> DataFrame:
    """One (key, value) row for the latest-value table, `[k:v,k:v]`; none while there are fewer than k keys."""
    is_money = dict(sums.dtypes)["value"].startswith("decimal")
    items = F.sort_array(F.collect_list(F.struct((-F.col("value")).alias("rank"), "key", "value")))

    def value(item):
        return text.money_text(item["value"]) if is_money else item["value"].cast("string")

    return (
        top_k(sums, k)
        .agg(items.alias("items"))
        .where(F.size("items") == k)
        .select(F.lit(name).alias("key"), text.top_text(F.col("items"), value).alias("value"))
    )
