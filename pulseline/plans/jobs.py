"""The jobs. Each turns raw lines, from a batch or a stream, into flows of products for `run_job`.

`JOBS` maps a job name to its line kinds and a function `(lines, folder, **options) -> flows`; `lines` holds one
frame per line kind, `folder` is where the job keeps figures between batches, and products are named by the key or
table they are written to. Malformed lines of a kind are the product `rejects_<kind>`. Where a flow takes rows as they
are decoded, both are made from one frame; where a flow aggregates a stream, the rejects are a flow of their own that
runs only if the product has a sink. A source that several flows need is decoded once and staged (`_staged`).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import decode, joins, patterns, routing, running, topk, windows
from ..operators.ranges import plan_ranges
from ..streaming import processors, stages
from ..streaming.folds import Ranking, RunningSums, fold_kpis
from ..streaming.runner import Flow, Output
from ..streaming.sinks import last_per_key
from . import cells

Lines = dict[str, DataFrame]


class Job(NamedTuple):
    inputs: tuple[str, ...]
    flows: Callable[..., list[Flow]]


JOBS: dict[str, Job] = {}


def job(name: str, *inputs: str):
    def register(flows: Callable[..., list[Flow]]) -> Callable[..., list[Flow]]:
        JOBS[name] = Job(inputs, flows)
        return flows

    return register


def build(name: str, lines: Lines, folder: str, **options) -> list[Flow]:
    return JOBS[name].flows(lines, f"{folder}/{name}", **options)


def _rows(batch: DataFrame, batch_id: int) -> DataFrame:
    return batch


def _rejects(kind: str, decoded: decode.Decoded) -> Flow:
    """(value, arrival, arrival_ts, reason) of the lines that were not decoded."""
    return Flow(f"rejects_{kind}", decoded.rejects, {f"rejects_{kind}": _rows})


def _decoded(
    name: str, kind: str, decoded: decode.Decoded, outputs: dict[str, Output],
    rows: Callable[[DataFrame], DataFrame] = lambda found: found,
) -> Flow:
    """Products of rows as they are decoded, and the rejects, from one frame."""

    def of_rows(output: Output) -> Output:
        return lambda batch, batch_id: output(rows(decode.rows_of(batch)), batch_id)

    both = {product: of_rows(output) for product, output in outputs.items()}
    both[f"rejects_{kind}"] = lambda batch, _: decode.rejects_of(batch)
    return Flow(name, decoded.labelled, both)


def _staged(
    kind: str, decoded: decode.Decoded, folder: str, delay: str, files: int | None
) -> tuple[DataFrame, Flow]:
    """Rows for several flows, and the flow that decodes their lines.

    A stream's lines are read and decoded once: each batch's rows and rejects are put into the job's folder, and the
    flows read them there. With `files`, a batch is in as many files for each core, and the flows read one batch at a
    time. Rejects are among the rows, so that the watermark goes on with every line.
    """
    rejects = {f"rejects_{kind}": lambda batch, _: decode.rejects_of(batch)}
    labelled = decoded.labelled
    if not labelled.isStreaming:
        return decoded.rows, Flow(f"rejects_{kind}", labelled, rejects)
    place = f"{folder}/staged_{kind}"
    files = stages.files_a_batch(labelled.sparkSession, place, files) if files else None
    options = {"maxFilesPerTrigger": str(files)} if files else {}
    found = stages.staged_stream(labelled.sparkSession, place, labelled.schema, **options).withWatermark("arrival_ts", delay)
    return decode.rows_of(found), Flow(f"staged_{kind}", labelled, rejects, stage=place, stage_files=files)


def _kpis(folder: str, keys: list[str]) -> dict[str, Output]:
    """The figures under `keys`, as one product."""

    def output(batch: DataFrame, batch_id: int) -> DataFrame:
        return fold_kpis(batch, batch_id, folder).where(F.col("key").isin(keys))

    return {"kpis": output}


def _running(folder: str, **operators: Callable[..., DataFrame]) -> dict[str, Output]:
    """Running values as products: a row per event, batch after batch."""

    def output(name: str, operator: Callable[..., DataFrame]) -> Output:
        return lambda batch, batch_id: operator(batch, sums=RunningSums(batch_id, f"{folder}/{name}"))

    return {name: output(name, operator) for name, operator in operators.items()}


def _cancelled(make: Callable[[DataFrame], DataFrame]) -> Output:
    return lambda batch, batch_id: make(routing.cancelled_orders(batch))


# Orders.


@job("order_totals", "order")
def order_totals(lines: Lines, folder: str) -> list[Flow]:
    """Sales and refund totals as they stand and after each order, and the cancelled orders."""
    decoded = decode.decode_orders(lines["order"])
    outputs = _kpis(folder, [codes.KEY_SALES_TOTAL, codes.KEY_REFUND_TOTAL])
    outputs |= _running(
        folder, running_sales=running.running_sales_total, running_refunds=running.running_refund_total
    )
    outputs[codes.TABLE_ORDER_INFO] = _cancelled(cells.cancelled_cells)
    return [_decoded("order_totals", "order", decoded, outputs, decode.with_event_time)]


@job("order_rates", "order")
def order_rates(lines: Lines, folder: str) -> list[Flow]:
    """Order count, refund request count, and cancel rate, as they stand and after each order."""
    required = ("amount", "status", "create_time", "operation_time")
    decoded = decode.decode_orders(lines["order"], date_only=True, required=required)
    keys = [codes.KEY_ORDER_COUNT, codes.KEY_REFUND_REQUESTS, codes.KEY_CANCEL_RATE]
    outputs = _kpis(folder, keys) | _running(
        folder, running_orders=running.running_order_count, running_refund_requests=running.running_refund_requests,
        running_cancel_rate=running.running_cancel_rate,
    )
    return [_decoded("order_rates", "order", decoded, outputs)]


@job("top_users", "order")
def top_users(lines: Lines, folder: str) -> list[Flow]:
    """The two users who spent most, the cancel rate, and the latest row of each cancelled order."""
    required = ("id", "consignee", "amount", "status", "user_id", "create_time", "operation_time")
    decoded = decode.decode_orders(lines["order"], date_only=True, required=required)
    outputs = _kpis(folder, [codes.KEY_CANCEL_RATE])
    outputs[codes.TABLE_ORDER_INFO] = _cancelled(cells.order_cells)
    return [
        _decoded("cancelled_orders", "order", decoded, outputs),
        _ranked("top_users", topk.user_spend(decoded.rows), {codes.KEY_TOP_USERS: ("value", 2)}, folder),
    ]


@job("order_count", "order")
def order_count(lines: Lines, folder: str) -> list[Flow]:
    """Number of sales orders; the amount is not looked at."""
    decoded = decode.decode_orders(lines["order"], required=("status", "create_time", "operation_time"))
    outputs = _kpis(folder, [codes.KEY_ORDER_COUNT])
    return [_decoded("order_count", "order", decoded, outputs, routing.sales_orders)]


def top_users_text(batch: DataFrame, batch_id: int) -> DataFrame:
    return topk.top_k_text(batch, 2, codes.KEY_TOP_USERS)


def _ranked(name: str, sums: DataFrame, products: dict[str, tuple[str, int]], folder: str) -> Flow:
    """Top-k texts of sums per key: product to (column, k).

    A batch frame holds all sums. A stream gives those that a batch has changed, and the others lie in a keyed table.
    """
    ranking = Ranking(f"{folder}/{name}", ["key"], dict(products.values()))

    def output(product: str, column: str, k: int) -> Output:
        def text_of(batch: DataFrame, batch_id: int) -> DataFrame:
            rows = batch.select("key", F.col(column).alias("value"))
            return topk.top_k_text(ranking.top(batch, batch_id, column) if sums.isStreaming else rows, k, product)

        return text_of

    return Flow(name, sums, {p: output(p, column, k) for p, (column, k) in products.items()}, "update")


def sku_flow(details: DataFrame, folder: str = "") -> Flow:
    products = {codes.KEY_TOP_SKU_QUANTITY: ("quantity", 3), codes.KEY_TOP_SKU_AMOUNT: ("amount", 3)}
    return _ranked("top_skus", topk.sku_sums(details), products, folder)


@job("top_skus", "order_detail")
def top_skus(lines: Lines, folder: str) -> list[Flow]:
    """The three products sold most, by quantity and by amount, and both after each line of a product."""
    required = ("detail_id", "sku_id", "price", "num", "create_time")
    decoded = decode.decode_order_details(lines["order_detail"], required=required)
    sequences = _running(
        folder, sku_running_quantity=running.sku_running_quantity, sku_running_amount=running.sku_running_amount
    )
    return [sku_flow(decoded.rows, folder), _decoded("sku_running", "order_detail", decoded, sequences)]


@job("orders_with_details", "order", "order_detail")
def orders_with_details(
    lines: Lines, folder: str, size: str = "1 second", delay: str = "0 seconds", files: int | None = None
) -> list[Flow]:
    """Number of sales orders, the three products with most sales, and orders joined with their details.

    Only the join needs the order id as a number; a row without one finds no partner there. On streams the join keeps
    the rows of windows that the watermark of both sources has not passed; rows of closed windows are dropped and
    counted in the progress of `order_join` (`numRowsDroppedByWatermark`).
    """
    required = ("amount", "status", "create_time", "operation_time")
    decoded = decode.decode_orders(lines["order"], required=required)
    order_rows, order_flow = _staged("order", decoded, folder, delay, files)
    orders = routing.sales_orders(order_rows)
    required = ("detail_id", "sku_id", "price", "num", "create_time")
    decoded = decode.decode_order_details(lines["order_detail"], required=required)
    details, detail_flow = _staged("order_detail", decoded, folder, delay, files)

    def join_rows(batch: DataFrame, batch_id: int) -> DataFrame:
        last = last_per_key(batch, ["id"], joins.PAIR_ORDER, kept=tuple(joins.PAIR_ORDER))
        return cells.join_cells(last, *joins.PAIR_ORDER)

    joined = joins.order_detail_pairs(orders, details, size)
    return [
        order_flow,
        detail_flow,
        Flow("order_count", orders, _kpis(folder, [codes.KEY_ORDER_COUNT])),
        _ranked("top_skus", topk.sku_sums(details), {codes.KEY_TOP_SKU_AMOUNT: ("amount", 3)}, folder),
        Flow("order_join", joined, {codes.TABLE_ORDER_JOIN: join_rows}),
    ]


# Machines.


# The watermark sits on the lines, before any filter, so that time goes on with every line.


def _produce(lines: Lines, delay: str, **options) -> decode.Decoded:
    return decode.decode_produce(lines["produce"].withWatermark("arrival_ts", delay), **options)


def _changes(lines: Lines, delay: str, with_time: bool) -> decode.Decoded:
    return decode.decode_changes(lines["change"].withWatermark("arrival_ts", delay), with_time=with_time)


@job("produced_latest", "produce")
def produced_latest(lines: Lines, folder: str, size: str = "5 minutes", delay: str = "0 seconds") -> list[Flow]:
    """Passed products of each machine's latest window. A malformed line fails the job."""
    counts = windows.produce_count_filtered(_produce(lines, delay, on_bad="fail").rows, size)
    latest = {codes.HASH_PRODUCED: lambda batch, batch_id: windows.produce_latest_window(batch)}
    return [Flow("produced_latest", counts, latest)]


@job("produced_with_zeros", "produce")
def produced_with_zeros(lines: Lines, folder: str, size: str = "5 minutes", delay: str = "0 seconds") -> list[Flow]:
    """Passed products per machine and window, with windows that have none."""
    counts = windows.produce_count_conditional(_produce(lines, delay, on_bad="fail").rows, size)
    return [Flow("produced_with_zeros", counts, {"counts": _rows})]


@job("produced", "produce")
def produced(lines: Lines, folder: str, size: str = "5 minutes", delay: str = "0 seconds") -> list[Flow]:
    """Passed products per machine and window."""
    counts = windows.produce_count_filtered(_produce(lines, delay, on_bad="fail").rows, size)
    return [Flow("produced", counts, {"counts": _rows})]


@job("produced_rows", "produce")
def produced_rows(lines: Lines, folder: str, size: str = "5 minutes", delay: str = "0 seconds") -> list[Flow]:
    """Passed products per machine and window as rows of a row store."""
    decoded = _produce(lines, delay)
    counts = windows.produce_count_filtered(decoded.rows, size)
    rowkeys = {codes.TABLE_PRODUCED: lambda batch, _: windows.produce_rowkey(batch)}
    return [Flow("produced_rows", counts, rowkeys), _rejects("produce", decoded)]


@job("warning_held", "change")
def warning_held(lines: Lines, folder: str, hold: str = codes.WARNING_HOLD, delay: str = "0 seconds") -> list[Flow]:
    """Machines in the warning state for a while."""
    decoded = decode.decode_changes(lines["change"], with_time=True)
    changes = decoded.rows
    if changes.isStreaming:
        alerts = processors.stream_warning_held(changes, hold, delay=delay)
    else:
        alerts = patterns.warning_held(changes, hold, ranges=plan_ranges(lines["change"], "arrival_ts", min_ranges=1))
    outputs = {"alerts": _rows, codes.HASH_WARNING_HELD: lambda batch, _: cells.warning_held_values(batch)}
    return [Flow("warning_held", alerts, outputs), _rejects("change", decoded)]


@job("warning_counts", "change")
def warning_counts(
    lines: Lines, folder: str, size: str = "3 minutes", delay: str = "0 seconds", with_time: bool = False
) -> list[Flow]:
    """Flagged warnings per machine and window; `with_time` takes lines with a valid start time only."""
    decoded = _changes(lines, delay, with_time)
    counts = windows.warning_count_tumbling(decoded.rows, size)
    outputs = {codes.TABLE_WARNING_COUNT: lambda batch, _: cells.warning_cells(batch)}
    return [Flow("warning_counts", counts, outputs), _rejects("change", decoded)]


@job("warning_top", "change")
def warning_top(
    lines: Lines, folder: str, size: str = "3 minutes", slide: str = "1 minute", delay: str = "0 seconds"
) -> list[Flow]:
    """The machine with most warnings per sliding window."""
    decoded = _changes(lines, delay, with_time=False)
    top = windows.warning_top_sliding(decoded.rows, size, slide)
    outputs = {codes.HASH_TOP_WARNING: lambda batch, _: windows.warning_top_values(batch)}
    return [Flow("warning_top", top, outputs), _rejects("change", decoded)]


@job("transitions", "change")
def transitions(lines: Lines, folder: str, delay: str | None = None) -> list[Flow]:
    """Changes from another status to running; with a `delay`, streams put late rows into their place first."""
    decoded = decode.decode_changes(lines["change"])
    changes = decoded.rows
    if changes.isStreaming:
        found = processors.stream_transitions(changes, delay=delay)
    else:
        ranges = plan_ranges(lines["change"], "arrival", min_ranges=1)
        found = patterns.transitions_to_running(changes, ranges=ranges)
    outputs = {codes.TABLE_TRANSITIONS: lambda batch, _: cells.transition_cells(batch)}
    return [Flow("transitions", found, outputs), _rejects("change", decoded)]


@job("temperature_held", "environment")
def temperature_held(
    lines: Lines, folder: str, hold: str = codes.TEMPERATURE_HOLD, delay: str = "0 seconds", clock: str = "event"
) -> list[Flow]:
    """Machines above the temperature limit for a while; live jobs use the processing clock."""
    decoded = decode.decode_environment(lines["environment"])
    readings = decoded.rows
    if readings.isStreaming:
        alerts = processors.stream_temperature_held(readings, hold, delay=delay, clock=clock)
    else:
        ranges = plan_ranges(lines["environment"], "arrival_ts", min_ranges=1)
        alerts = patterns.temperature_held(readings, hold, ranges=ranges)
    outputs = {codes.TABLE_TEMPERATURE: lambda batch, _: cells.temperature_cells(batch)}
    return [Flow("temperature_held", alerts, outputs), _rejects("environment", decoded)]
