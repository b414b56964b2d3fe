"""Every operator over the test tables, as named queries.

The tables become raw lines first, so each query runs the whole way from lines to result. Money and times are
returned as text, the way the sinks write them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, text
from ..operators import decode, joins, kpis, patterns, routing, running, topk, windows
from ..operators.ranges import TARGET_ROWS, plan_ranges
from ..session import shared_folder
from ..sources import tables
from ..sources.lines import read_files, read_lines
from ..streaming import sinks
from ..streaming.runner import Flow, run_job
from . import cells, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Durations for the test tables, where one machine reports about every few hours.
DAY, THREE_DAYS, SIX_HOURS, MONTH = "1 day", "3 days", "6 hours", "30 days"
# Rows of a range in the queries whose names end in `_split`: keys of the test tables hold more, so they are cut.
SPLIT_ROWS = 40
# Buckets of the merged tables, whose content at this size would fit one.
TABLE_BUCKETS = 4


def _query(name: str, make: Query) -> None:
    QUERIES[name] = make


# Columns are made when a query runs, since they need a session.


def _time(c: str) -> Callable[[], Column]:
    return lambda: text.time_text(F.col(c)).alias(c)


def _money(c: str) -> Callable[[], Column]:
    return lambda: text.money_text(F.col(c)).alias(c)


def _pick(df: DataFrame, *columns) -> DataFrame:
    return df.select(*[c() if callable(c) else c for c in columns])


def _orders(spark, sf, **options) -> DataFrame:
    return decode.decode_orders(tables.order_lines(spark, sf), **options).rows


def _details(spark, sf) -> DataFrame:
    return decode.decode_order_details(tables.detail_lines(spark, sf)).rows


def _changes(spark, sf, with_time: bool = False) -> DataFrame:
    return decode.decode_changes(tables.change_lines(spark, sf), with_time=with_time).rows


def _produce(spark, sf, **options) -> DataFrame:
    return decode.decode_produce(tables.produce_lines(spark, sf), **options).rows


def _environment(spark, sf) -> DataFrame:
    return decode.decode_environment(tables.environment_lines(spark, sf)).rows


def _of(source: Callable, operator: Callable[[DataFrame], DataFrame], *columns) -> Query:
    """`operator` over the rows of `source`, and the columns to return."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        result = operator(source(spark, sf))
        return _pick(result, *columns) if columns else result

    return run


def _same(df: DataFrame) -> DataFrame:
    return df


# Sources and decoding.


def _read_lines(spark, sf):
    lines = read_files(spark, f"{sf}/events.parquet", value="props", arrival="event_id", arrival_ts="ts")
    return lines.select("arrival", "value", F.unix_micros("arrival_ts").alias("arrival_us"))


def _rejects(spark, sf):
    return decode.reject_counts(
        decode.decode_orders(tables.order_lines(spark, sf)),
        decode.decode_order_details(tables.detail_lines(spark, sf)),
        decode.decode_changes(tables.change_lines(spark, sf), with_time=True),
        decode.decode_environment(tables.environment_lines(spark, sf)),
    )


_query("read_lines", _read_lines)
_query(
    "decode_orders",
    _of(
        _orders, _same, "arrival", "id", "consignee", "consignee_tel", _money("amount"), "status", "user_id",
        _time("create_time"), _time("operation_time"), "freight",
    ),
)
_query(
    "decode_orders_date_only",
    _of(lambda s, d: _orders(s, d, date_only=True), _same, "arrival", "id", _time("create_time"), _time("operation_time")),
)
_query(
    "decode_order_details",
    _of(_details, _same, "arrival", "detail_id", "order_id", "sku_id", _money("price"), "num", _time("create_time")),
)
_query("decode_produce", _of(_produce, _same, "arrival", "machine_id", "passed"))
_query(
    "decode_produce_strict",
    _of(lambda s, d: _produce(s, d, on_bad="fail"), _same, "arrival", "machine_id", "passed"),
)
_query(
    "decode_changes",
    _of(lambda s, d: _changes(s, d, True), _same, "arrival", "machine_id", "status", _time("start_time"), "flag"),
)
_query("decode_environment", _of(_environment, _same, "arrival", "machine_id", "temperature"))
_query("decode_rejects", _rejects)
_query("event_time_max", _of(_orders, decode.with_event_time, "arrival", "id", _time("event_time")))

# Filters and routing.

_query("filter_sales_orders", _of(_orders, routing.sales_orders, "arrival", "id", "status"))
_query("filter_passed", _of(_produce, routing.passed_products, "arrival", "machine_id"))
_query("filter_flagged_warning", _of(_changes, routing.flagged_warnings, "arrival", "machine_id", "flag"))
_query("filter_warning", _of(_changes, routing.warnings, "arrival", "machine_id"))
_query("route_orders", _of(_orders, routing.route_orders, "arrival", "id", "route"))
_query(
    "cancelled_orders",
    _of(_orders, routing.cancelled_orders, "id", "consignee", "consignee_tel", _money("amount"), "freight"),
)

# Running values and latest figures.


def _running(operator, *columns) -> Query:
    """The cut points come from the arrival numbers alone, which is cheaper than from decoded rows."""

    def run(spark, sf):
        ranges = plan_ranges(tables.order_arrivals(spark, sf), "arrival")
        rows = operator(_orders(spark, sf), ranges=ranges)
        return _pick(rows, "arrival", "id", *columns)

    return run


def _per_sku(operator, *columns, target_rows: int = TARGET_ROWS) -> Query:
    def run(spark, sf):
        ranges = plan_ranges(tables.detail_arrivals(spark, sf), "arrival", target_rows=target_rows, min_ranges=1)
        rows = operator(_details(spark, sf), ranges=ranges)
        return _pick(rows, "arrival", "sku_id", "events", *columns)

    return run


_query("running_sales_total", _running(running.running_sales_total, _money("total")))
_query("running_refund_total", _running(running.running_refund_total, _money("total")))
_query("running_order_count", _running(running.running_order_count, "orders"))
_query("running_refund_requests", _running(running.running_refund_requests, "orders"))
_query("running_cancel_rate", _running(running.running_cancel_rate, "cancel_rate"))
_query("order_kpis_latest", _of(_orders, kpis.order_kpis_latest))
_query("user_spend", _of(_orders, topk.user_spend, "key", _money("value")))
_query("sku_running_quantity", _per_sku(running.sku_running_quantity, "quantity"))
_query("sku_running_amount", _per_sku(running.sku_running_amount, _money("amount")))
_query(
    "sku_running_amount_split", _per_sku(running.sku_running_amount, _money("amount"), target_rows=SPLIT_ROWS)
)

# Top-k.


def _top_users(orders):
    return topk.top_k_text(topk.user_spend(orders), 2, codes.KEY_TOP_USERS)


def _top_quantity(details):
    return topk.top_k_text(topk.sku_quantity(details), 3, codes.KEY_TOP_SKU_QUANTITY)


def _top_amount(details):
    return topk.top_k_text(topk.sku_amount(details), 3, codes.KEY_TOP_SKU_AMOUNT)


_query("top2_users", _of(_orders, _top_users))
_query("top3_sku_quantity", _of(_details, _top_quantity))
_query("top3_sku_amount", _of(_details, _top_amount))

# Time windows, with the jobs' own durations and with longer ones.

_WINDOW = ("machine_id", _time("window_start"), _time("window_end"), "cnt")

for _suffix, _size in (("", "5 minutes"), ("_daily", DAY)):

    def _filtered(produce, size=_size):
        return windows.produce_count_filtered(produce, size)

    def _conditional(produce, size=_size):
        return windows.produce_count_conditional(produce, size)

    def _latest(produce, size=_size):
        return windows.produce_latest_window(windows.produce_count_filtered(produce, size))

    def _rowkey(produce, size=_size):
        return windows.produce_rowkey(windows.produce_count_filtered(produce, size))

    _query(f"produce_count_filtered{_suffix}", _of(_produce, _filtered, *_WINDOW))
    _query(f"produce_count_conditional{_suffix}", _of(_produce, _conditional, *_WINDOW))
    _query(f"produce_latest_window{_suffix}", _of(_produce, _latest))
    _query(f"produce_rowkey{_suffix}", _of(_produce, _rowkey))

_WARNINGS = ("machine_id", "cnt", lambda: F.col("window_end_text").alias("window_end"))
_TOP_WARNING = (_time("window_end"), "machine_id", "cnt")


def _daily_warnings(changes):
    return windows.warning_count_tumbling(changes, DAY)


def _daily_top_warning(changes):
    return windows.warning_top_sliding(changes, THREE_DAYS, DAY)


_query("warning_count_tumbling", _of(_changes, windows.warning_count_tumbling, *_WARNINGS))
_query("warning_count_tumbling_daily", _of(_changes, _daily_warnings, *_WARNINGS))
_query("warning_top_sliding", _of(_changes, windows.warning_top_sliding, *_TOP_WARNING))
_query("warning_top_sliding_daily", _of(_changes, _daily_top_warning, *_TOP_WARNING))

# Joins.


def _window_join(spark, sf, size=MONTH):
    return joins.order_detail_window_join(routing.sales_orders(_orders(spark, sf)), _details(spark, sf), size)


def _join_latest(spark, sf):
    return joins.order_detail_latest(routing.sales_orders(_orders(spark, sf)), _details(spark, sf), MONTH)


_query("order_detail_window_join", _window_join)
_query("order_detail_window_join_1s", lambda spark, sf: _window_join(spark, sf, "1 second"))
_query("order_detail_latest", lambda spark, sf: joins.pair_cells(_join_latest(spark, sf)))

# Patterns.


def _event_ranges(spark, sf, order, target_rows=TARGET_ROWS):
    """From the arrival numbers or times alone, which needs no decoding."""
    return plan_ranges(tables.event_arrivals(spark, sf), order, target_rows=target_rows, min_ranges=1)


def _transitions(target_rows=TARGET_ROWS):
    def source(spark, sf):
        ranges = _event_ranges(spark, sf, "arrival", target_rows)
        return patterns.transitions_to_running(_changes(spark, sf), ranges=ranges)

    return source


def _text_transitions(spark, sf):
    """The machine lines as text files, read back; the transitions depend on their order."""
    path = f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    lines = tables.change_lines(spark, sf).repartitionByRange("arrival").sortWithinPartitions("arrival")
    lines.select("value").write.text(path)
    changes = decode.decode_changes(read_lines(spark, "text", path=path, files_by="path")).rows
    return patterns.transitions_to_running(changes).select("machine_id", "previous", "changes")


def _warning_held(hold, target_rows=TARGET_ROWS):
    def run(spark, sf):
        ranges = _event_ranges(spark, sf, "arrival_ts", target_rows)
        alerts = patterns.warning_held(_changes(spark, sf, True), hold, ranges=ranges)
        return _pick(alerts, "machine_id", _time("alert_time"), "message")

    return run


def _temperature_held(hold, target_rows=TARGET_ROWS):
    def run(spark, sf):
        ranges = _event_ranges(spark, sf, "arrival_ts", target_rows)
        alerts = patterns.temperature_held(_environment(spark, sf), hold, ranges=ranges)
        return alerts.select(
            "machine_id",
            F.unix_micros("alert_time").alias("alert_us"),
            F.unix_micros("last_match_time").alias("last_match_us"),
        )

    return run


_query("hold_alerts_status", _warning_held(codes.WARNING_HOLD))
_query("hold_alerts_status_6h", _warning_held(SIX_HOURS))
_query("hold_alerts_threshold", _temperature_held(codes.TEMPERATURE_HOLD))
_query("hold_alerts_threshold_6h", _temperature_held(SIX_HOURS))
_query("hold_alerts_status_6h_split", _warning_held(SIX_HOURS, SPLIT_ROWS))
_query("hold_alerts_threshold_6h_split", _temperature_held(SIX_HOURS, SPLIT_ROWS))

_TRANSITION = ("arrival", "machine_id", "previous", "changes", _time("change_time"))

_query("transitions_to_running", _of(_transitions(), _same, *_TRANSITION))
_query("transitions_to_running_split", _of(_transitions(SPLIT_ROWS), _same, *_TRANSITION))
_query("read_lines_text", _text_transitions)

# Sinks: write to a latest-value table in the shared folder and read its content back.


def _write_and_read(spark, flows: list[Flow], keys: list[str], order=None) -> DataFrame:
    """Write all products of the flows to one table, and return its content."""
    path = f"{shared_folder(spark)}/{flows[0].name}-{uuid.uuid4().hex}"
    sink = sinks.latest_sink(path, keys, order)
    run_job(flows, {name: sink for flow in flows for name in flow.outputs})
    return sinks.read_latest(spark, path, keys)


def _kv_set(spark, sf):
    orders = _orders(spark, sf)
    flows = [
        Flow("kpis", orders, {"kpis": lambda batch, _: kpis.order_kpis_latest(batch)}),
        Flow("top_users", topk.user_spend(orders), {codes.KEY_TOP_USERS: jobs.top_users_text}),
        jobs.sku_flow(_details(spark, sf)),
    ]
    return _write_and_read(spark, flows, ["key"])


def _one(spark, name: str, frame: DataFrame, keys: list[str], order=None) -> DataFrame:
    return _write_and_read(spark, [Flow(name, frame, {name: lambda batch, _: batch})], keys, order)


def _kv_hset(spark, sf):
    values = windows.warning_top_values(_daily_top_warning(_changes(spark, sf)))
    return _one(spark, codes.HASH_TOP_WARNING, values, ["key", "field"])


def _row_upsert(spark, sf):
    return _one(spark, codes.TABLE_ORDER_JOIN, cells.join_cells(_join_latest(spark, sf)), ["row_key"])


def _row_upsert_temperature(spark, sf):
    alerts = patterns.temperature_held(_environment(spark, sf), SIX_HOURS)
    return _one(spark, codes.TABLE_TEMPERATURE, cells.temperature_cells(alerts), ["row_key"], "alert_time")


def _cancelled_upsert(spark, sf):
    rows = cells.order_cells(routing.cancelled_orders(_orders(spark, sf, date_only=True)))
    return _one(spark, codes.TABLE_ORDER_INFO, rows, ["row_key"], "arrival")


def _cancelled_merged(spark, sf):
    """The same content, merged batch by batch into hash buckets; one batch comes twice."""
    rows = cells.order_cells(routing.cancelled_orders(_orders(spark, sf, date_only=True)))
    path = f"{shared_folder(spark)}/merged-{uuid.uuid4().hex}"
    sink = sinks.row_upsert(path, "arrival", TABLE_BUCKETS)
    for batch, part in enumerate([0, 1, 1, 2]):
        sink(rows.where(F.col("arrival") % 3 == part), batch - (batch > 1), codes.TABLE_ORDER_INFO)
    return sinks.read_latest(spark, path, ["row_key"])


_query("sink_kv_set", _kv_set)
_query("sink_kv_hset", _kv_hset)
_query("sink_row_upsert", _row_upsert)
_query("sink_row_upsert_temperature", _row_upsert_temperature)
_query("cancelled_orders_upsert", _cancelled_upsert)
_query("cancelled_orders_upsert_merged", _cancelled_merged)

# The text cells the JDBC sink inserts.

_query(
    "sink_jdbc_append_order_info",
    _of(_orders, lambda orders: sinks.text_cells(cells.cancelled_cells(routing.cancelled_orders(orders)))),
)
_query(
    "sink_jdbc_append_warnings",
    _of(_changes, lambda changes: sinks.text_cells(cells.warning_cells(_daily_warnings(changes)))),
)
_query(
    "sink_jdbc_append_transitions",
    _of(_changes, lambda changes: sinks.text_cells(cells.transition_cells(patterns.transitions_to_running(changes)))),
)
