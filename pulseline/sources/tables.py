"""Raw-line views over the test tables, one per line kind.

The tables stand in for the topics: each row becomes one comma-separated line with an arrival number and time.
A few lines are made malformed on purpose, by a rule on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import codes
from ..functions.text import compute_once

UNPADDED = "'yyyy-M-d H:mm:ss'"
PADDED = f"'{codes.TIME_FORMAT}'"

ORDER_STATUS = f"""CASE o_orderpriority WHEN '1-URGENT' THEN '{codes.CREATED}' WHEN '2-HIGH' THEN '{codes.PAID}'
  WHEN '3-MEDIUM' THEN '{codes.COMPLETED}' WHEN '4-NOT SPECIFIED' THEN '{codes.CANCELLED}'
  ELSE CASE WHEN o_orderstatus = 'O' THEN '{codes.REFUND_REQUESTED}' ELSE '{codes.REFUNDED}' END END"""
MACHINE_STATUS = f"""CASE event_type WHEN 'error' THEN '{codes.WARNING}' WHEN 'view' THEN '{codes.RUNNING}'
  WHEN 'click' THEN '待机' WHEN 'signup' THEN '离线' WHEN 'purchase' THEN '维修' END"""
EVENT_NUMBER = "CAST(regexp_extract(props, '([0-9]+)', 1) AS int)"

# Numbers the lines of one order. An order has a handful of lines; all columns together tell them apart.
LINE_OF_ORDER = """row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(df: DataFrame, arrival: str, arrival_ts: str, fields: list[str], bad: str = "false", bad_line: str = "''"):
    """(value, arrival, arrival_ts) from SQL expressions; lines with `bad` become `bad_line`."""
    value = f"CASE WHEN {bad} THEN {bad_line} ELSE concat_ws(',', {', '.join(fields)}) END"
    return compute_once(df, [], {"value": value, "arrival": arrival, "arrival_ts": f"CAST({arrival_ts} AS timestamp)"})


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    fields = [
        "o_orderkey", "c_name", "concat('tel-', c_custkey)",
        "CASE WHEN o_orderkey % 101 = 5 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS decimal(12,2)) AS string) END",
        ORDER_STATUS, "c_custkey", "'addr'", "'note'", "'trade'", "'body'",
        f"date_format(CAST(o_orderdate AS timestamp), {UNPADDED})",
        f"date_format(CAST(o_orderdate AS timestamp) + make_dt_interval(0, 0, 0, o_orderkey % 86400), {UNPADDED})",
        "c_nationkey", "'5'",
    ]
    joined = orders.join(customer, "c_custkey")
    return _lines(joined, "o_orderkey", "o_orderdate", fields, "o_orderkey % 97 = 3", "concat('bad,', o_orderkey)")


def order_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival numbers of the order lines."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS arrival")


def detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").selectExpr("*", f"l_orderkey * 100 + {LINE_OF_ORDER} AS number")
    fields = [
        "number", "l_orderkey", "l_partkey", "'sku'", "CAST(l_extendedprice AS decimal(12,2))",
        "CAST(l_quantity AS int)", f"date_format(CAST(l_shipdate AS timestamp), {PADDED})",
    ]
    return _lines(items, "number", "l_shipdate", fields, "number % 89 = 7", "'bad'")


def detail_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival numbers of the detail lines, up to the line number inside an order."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 100 AS arrival")


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival numbers and times of the machine lines."""
    return table(spark, sf_dir, "events").selectExpr("event_id AS arrival", "CAST(ts AS timestamp) AS arrival_ts")


def _event_lines(spark: SparkSession, sf_dir: str, fields: list[str], bad: str = "false", bad_line: str = "''"):
    events = table(spark, sf_dir, "events")
    return _lines(events, "event_id", "ts", ["event_id", "user_id", *fields], bad, bad_line)


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = f"date_format(CAST(ts AS timestamp), {PADDED})"
    fields = ["'0000'", MACHINE_STATUS, time, "'x'", EVENT_NUMBER]
    return _event_lines(spark, sf_dir, fields, "event_id % 83 = 9", "concat('bad,', event_id)")


def produce_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = f"date_format(CAST(ts AS timestamp), {PADDED})"
    fields = ["'0000'", time, time, time, "'11560'", "'1900-01-01 00:00:00'", "'184962'", f"{EVENT_NUMBER} % 2"]
    return _event_lines(spark, sf_dir, fields)


def environment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "CAST(CAST(value AS decimal(10,2)) AS string)"
    padded = f"CASE WHEN event_id % 73 = 5 THEN concat(' ', {number}, ' ') ELSE {number} END"
    fields = ["'a'", "'b'", "'c'", padded, "'d'"]
    return _event_lines(spark, sf_dir, fields, "event_id % 79 = 11", "'x,y'")
