"""Jobs run as streams over the test tables, as named queries.

The lines are captured to files in arrival order first; a stream then reads them file by file to the end, and the
query returns what the sinks hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, text
from ..operators.joins import PAIR_ORDER
from ..operators.patterns import duration_micros
from ..session import shared_folder
from ..sources import tables
from ..sources.lines import read_lines
from ..streaming import sinks
from ..streaming.keyed import Folder
from ..streaming.runner import run_job
from . import jobs

PIECES = 2
TABLE_BUCKETS = 4
# A line of no machine and without a warning.
LAST_LINE = "0,,0000,离线,2000-01-01 00:00:00,x,1"
COUNT_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
LINE = "value string, arrival bigint, arrival_ts timestamp"
SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order": tables.order_lines,
    "order_detail": tables.detail_lines,
    "produce": tables.produce_lines,
    "change": tables.change_lines,
    "environment": tables.environment_lines,
}


def capture(lines: DataFrame, path: str, pieces: int = PIECES) -> None:
    """Write lines in `pieces` steps that follow the arrival order, as a topic would have received them."""
    kept = _kept(lines, path)
    low, high = kept.select(F.min("arrival"), F.max("arrival")).first()
    width = (high - low) // pieces + 1
    for i in range(pieces):
        first = low + i * width
        kept.where(F.col("arrival").between(first, first + width - 1)).write.mode("append").parquet(path, compression="zstd")
    Folder(lines.sparkSession, f"{path}-all").remove()


def _kept(lines: DataFrame, path: str) -> DataFrame:
    """The lines, made once; they go when all steps are written."""
    lines.write.parquet(f"{path}-all")
    return lines.sparkSession.read.parquet(f"{path}-all")


def capture_late(lines: DataFrame, path: str, late: str, pieces: int = 2 * PIECES) -> None:
    """Like `capture`, but each line is delivered later than it should be, by up to `late`."""
    by = F.unix_micros("arrival_ts") + F.pmod(F.xxhash64("arrival"), F.lit(duration_micros(late)))
    kept = _kept(lines.withColumn("delivered", by), path)
    low, high = kept.select(F.min("delivered"), F.max("delivered")).first()
    width = (high - low) // pieces + 1
    for i in range(pieces):
        first = low + i * width
        part = kept.where(F.col("delivered").between(first, first + width - 1)).drop("delivered")
        part.write.mode("append").parquet(path, compression="zstd")
    Folder(lines.sparkSession, f"{path}-all").remove()


def close_windows(path: str, spark: SparkSession) -> None:
    """Append a line far in the future, which closes all windows and is in no result itself."""
    last = spark.read.schema(LINE).parquet(path).agg(
        F.lit(LAST_LINE).alias("value"),
        (F.max("arrival") + 1).alias("arrival"),
        (F.max("arrival_ts") + F.expr("INTERVAL 10 YEARS")).alias("arrival_ts"),
    )
    last.write.mode("append").parquet(path)


@contextmanager
def uncounted_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside do not report the rows in their state, which costs a look-up for each row written there."""
    before = spark.conf.get(COUNT_STATE, None)
    spark.conf.set(COUNT_STATE, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(COUNT_STATE)
        else:
            spark.conf.set(COUNT_STATE, before)


def run_streams(
    spark: SparkSession,
    sf_dir: str,
    job: str,
    product: str,
    keys: list[str] | None,
    order: list[str] | None = None,
    *,
    close: bool = False,
    late: str | None = None,
    **options,
) -> DataFrame:
    """The content of one product's table after the job has read all lines; without keys, all rows of all batches.

    With `late`, lines come out of order by up to that, and the job's `delay` has to put them right.
    """
    folder = f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"
    lines = {}
    for kind in jobs.JOBS[job].inputs:
        path = f"{folder}/lines/{kind}"
        if late:
            capture_late(SOURCES[kind](spark, sf_dir), path, late)
            options["delay"] = late
        else:
            capture(SOURCES[kind](spark, sf_dir), path)
        if close:
            close_windows(path, spark)
        files = len(spark.read.schema(LINE).parquet(path).inputFiles())
        lines[kind] = read_lines(
            spark, "parquet", path=path, schema=LINE, stream=True, maxFilesPerTrigger=str(-(-files // PIECES))
        )
    table = f"{folder}/table"
    sink = {product: sinks.latest_sink(table, keys, order, TABLE_BUCKETS) if keys else sinks.rows_append(table)}
    flows = [flow for flow in jobs.build(job, lines, f"{folder}/state", **options) if product in flow.outputs or flow.stage]
    with uncounted_state(spark):
        for query in run_job(flows, sink, checkpoint=f"{folder}/checkpoint", trigger={"availableNow": True}):
            query.awaitTermination()
    return sinks.read_latest(spark, table, keys) if keys else sinks.read_rows(spark, table)


def sequence(job: str, product: str, *columns) -> Callable[[SparkSession, str], DataFrame]:
    """A row per event, over all batches of the stream."""
    return lambda spark, sf_dir: run_streams(spark, sf_dir, job, product, None).select(*[c() if callable(c) else c for c in columns])


def text_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machine lines as text files, which come in one by one; the transitions depend on their order."""
    folder = f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    capture(SOURCES["change"](spark, sf_dir), f"{folder}/lines")
    lines = spark.read.schema(LINE).parquet(f"{folder}/lines")
    lines.repartitionByRange(PIECES, "arrival").sortWithinPartitions("arrival").select("value").write.text(f"{folder}/text")
    now = {"availableNow": True}
    live = read_lines(
        spark, "text", path=f"{folder}/text", stream=True, ledger=f"{folder}/ledger", files_by="path", trigger=now
    )
    table = f"{folder}/table"
    (flow, *_) = jobs.build("transitions", {"change": live}, f"{folder}/state")
    for query in run_job(
        [flow], {codes.TABLE_TRANSITIONS: sinks.rows_append(table)}, checkpoint=f"{folder}/checkpoint", trigger=now
    ):
        query.awaitTermination()
    return sinks.read_rows(spark, table).select("machine_id", F.col("last_status").alias("previous"), "changes")


def money(name: str):
    return lambda: text.money_text(F.col(name)).alias(name)


STREAM_QUERIES = {
    "stream_order_rates": lambda s, d: run_streams(s, d, "order_rates", "kpis", ["key"]),
    "stream_top_users": lambda s, d: run_streams(s, d, "top_users", codes.KEY_TOP_USERS, ["key"]),
    "stream_top_sku_amount": lambda s, d: run_streams(s, d, "top_skus", codes.KEY_TOP_SKU_AMOUNT, ["key"]),
    "stream_warning_counts": lambda s, d: run_streams(
        s, d, "warning_counts", codes.TABLE_WARNING_COUNT, ["machine_id", "window_end"], close=True, size="1 day"
    ),
    "stream_warning_top": lambda s, d: run_streams(
        s, d, "warning_top", codes.HASH_TOP_WARNING, ["key", "field"], close=True, size="3 days", slide="1 day"
    ),
    "stream_transitions": lambda s, d: run_streams(
        s, d, "transitions", codes.TABLE_TRANSITIONS, ["machine_id", "changes"]
    ),
    "stream_transitions_late": lambda s, d: run_streams(
        s, d, "transitions", codes.TABLE_TRANSITIONS, ["machine_id", "changes"], close=True, late="2 days"
    ),
    "stream_warning_held": lambda s, d: run_streams(
        s, d, "warning_held", codes.HASH_WARNING_HELD, ["key", "field"], ["alert_time"], hold="6 hours"
    ),
    "stream_rejects": lambda s, d: run_streams(s, d, "temperature_held", "rejects_environment", ["arrival"]).select(
        "arrival", "value", "reason"
    ),
    "stream_order_join": lambda s, d: run_streams(
        s, d, "orders_with_details", codes.TABLE_ORDER_JOIN, ["row_key"], PAIR_ORDER, size="30 days", delay="4000 days"
    ),
    "stream_order_join_late": lambda s, d: run_streams(
        s, d, "orders_with_details", codes.TABLE_ORDER_JOIN, ["row_key"], PAIR_ORDER, size="30 days", late="2 days", files=1
    ),
    "stream_order_rejects": lambda s, d: run_streams(s, d, "order_rates", "rejects_order", ["arrival"]).select(
        "arrival", "value", "reason"
    ),
    "stream_read_lines_text": lambda s, d: text_transitions(s, d),
    "stream_running_sales_total": sequence("order_totals", "running_sales", "arrival", "id", money("total")),
    "stream_running_refund_total": sequence("order_totals", "running_refunds", "arrival", "id", money("total")),
    "stream_running_order_count": sequence("order_rates", "running_orders", "arrival", "id", "orders"),
    "stream_running_refund_requests": sequence("order_rates", "running_refund_requests", "arrival", "id", "orders"),
    "stream_running_cancel_rate": sequence("order_rates", "running_cancel_rate", "arrival", "id", "cancel_rate"),
    "stream_sku_running_quantity": sequence(
        "top_skus", "sku_running_quantity", "arrival", "sku_id", "events", "quantity"
    ),
    "stream_sku_running_amount": sequence(
        "top_skus", "sku_running_amount", "arrival", "sku_id", "events", money("amount")
    ),
    "stream_top_sku_quantity": lambda s, d: run_streams(s, d, "top_skus", codes.KEY_TOP_SKU_QUANTITY, ["key"]),
}
