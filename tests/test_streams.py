"""Streams give what the batch operators give, for any cut into micro-batches and across a restart."""

from __future__ import annotations

import datetime as dt
import os
import random
import time

import pandas as pd
import pytest
from line_rows import LINE, TESTDATA, order_line, rows
from pyspark.sql import functions as F

from pulseline.functions import codes
from pulseline.operators import decode, joins, patterns, windows
from pulseline.plans import jobs, stream_queries
from pulseline.sources import tables
from pulseline.sources.lines import kafka_lines, read_lines
from pulseline.streaming import processors, sinks, stages
from pulseline.streaming.runner import run_job, write_outputs

SF = str(TESTDATA / "sf0.001")
KINDS = {
    "order": tables.order_lines,
    "order_detail": tables.detail_lines,
    "produce": tables.produce_lines,
    "change": tables.change_lines,
    "environment": tables.environment_lines,
}
# A line far in the future closes all windows and holds.
FLUSH = {
    "produce": "9,flush,0000,t,t,t,1,t,1,0",
    "change": "9,flush,0000,离线,2030-01-01 00:00:00,x,1",
    "environment": "9,flush,a,b,c,1.0,d",
}


@pytest.fixture(scope="module")
def captured(spark, tmp_path_factory):
    """Captured lines of each kind in several files, in arrival order."""
    folder = tmp_path_factory.mktemp("lines")
    made = {}

    def capture(kind: str, pieces: int) -> str:
        if (kind, pieces) not in made:
            path = str(folder / f"{kind}-{pieces}")
            lines = KINDS[kind](spark, SF).persist()
            order = "arrival" if kind in ("order", "order_detail") else "arrival_ts"
            low, high = lines.select(F.min("arrival"), F.max("arrival")).first()
            step = (high - low) // pieces + 1
            for i in range(pieces):
                part = lines.where(F.col("arrival").between(low + i * step, low + (i + 1) * step - 1))
                part.coalesce(1).sortWithinPartitions(order).write.mode("append").parquet(path)
            if kind in FLUSH:
                last = [(FLUSH[kind], high + 1, dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc))]
                spark.createDataFrame(last, LINE).coalesce(1).write.mode("append").parquet(path)
            lines.unpersist()
            made[kind, pieces] = path
        return made[kind, pieces]

    return capture


def batch(spark, path):
    return read_lines(spark, "parquet", path=path)


def stream(spark, path, files="1"):
    return read_lines(spark, "parquet", path=path, schema=LINE, stream=True, maxFilesPerTrigger=files)


def drain(df, folder, mode="append"):
    """All rows a stream emits."""
    out = str(folder / "out")

    def write(part, batch_id):
        part.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", str(folder / "check"))
    query.trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(out).drop("batch_id")


@pytest.mark.parametrize("pieces", [1, 4])
def test_hold_alerts(spark, captured, tmp_path, pieces):
    path = captured("change", pieces)

    def changes(lines):
        return decode.decode_changes(lines, with_time=True).rows

    want = patterns.warning_held(changes(batch(spark, path)), "6 hours")
    got = drain(processors.stream_warning_held(changes(stream(spark, path)), "6 hours"), tmp_path)
    assert rows(got) == rows(want)
    assert want.count() > 50


def test_temperature_alerts(spark, captured, tmp_path):
    path = captured("environment", 3)
    want = patterns.temperature_held(decode.decode_environment(batch(spark, path)).rows)
    got = drain(processors.stream_temperature_held(decode.decode_environment(stream(spark, path)).rows), tmp_path)
    assert rows(got) == rows(want)
    assert want.count() > 300


def test_processing_clock_ends_holds_without_further_lines(spark, captured, tmp_path):
    """The lines are old, so every pending hold is overdue by the wall clock."""
    path = captured("environment", 1)
    readings = decode.decode_environment(stream(spark, path, files="10")).rows.where("machine_id <> 'flush'")
    alerts = processors.stream_temperature_held(readings, "6 hours", clock="processing")
    want = rows(patterns.temperature_held(decode.decode_environment(batch(spark, path)).rows, "6 hours"))
    found = []

    def collect(part, batch_id):
        found.extend(tuple(r) for r in part.collect())

    # Such a query never runs out of batches, so it is stopped once it has raised the alerts.
    query = alerts.writeStream.foreachBatch(collect).option("checkpointLocation", str(tmp_path / "check"))
    query = query.trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            if len(found) >= len(want) or query.exception():
                break
            time.sleep(1)
    finally:
        query.stop()
    assert sorted(found, key=str) == want


def test_transitions(spark, captured, tmp_path):
    path = captured("change", 4)
    want = patterns.transitions_to_running(decode.decode_changes(batch(spark, path)).rows)
    got = drain(processors.stream_transitions(decode.decode_changes(stream(spark, path)).rows), tmp_path)
    assert rows(got) == rows(want)


READING = "machine_id string, arrival bigint, arrival_ts timestamp, status string"


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Readings whose order of delivery is up to five seconds off, cut into files as delivered; and all of them."""
    picker = random.Random(11)
    second, made = 0.0, []
    for i in range(3000):
        second += picker.choice([0, 0.4, 1, 3])
        status = picker.choice(["预警", "预警", "预警", "运行", "待机"])
        machine = "hot" if picker.random() < 0.4 else f"m{picker.randrange(12)}"
        made.append((machine, i, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second), status))
    made.append(("flush", 3000, dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc), "待机"))
    seen = {}

    def capture(pieces: int) -> str:
        if pieces not in seen:
            path = str(tmp_path_factory.mktemp("shuffled") / "rows")
            jitter = random.Random(pieces)
            sent = sorted(made[:-1], key=lambda r: r[2] + dt.timedelta(seconds=5 * jitter.random())) + made[-1:]
            step = -(-len(sent) // pieces)
            for at in range(0, len(sent), step):
                spark.createDataFrame(sent[at : at + step], READING).coalesce(1).write.mode("append").parquet(path)
                time.sleep(0.02)  # files are read in the order of their times
            seen[pieces] = path
        return seen[pieces]

    return capture


@pytest.mark.parametrize("pieces", [1, 7, 23])
def test_readings_out_of_order_find_their_place(spark, shuffled, tmp_path, pieces):
    path = shuffled(pieces)
    lines = spark.read.parquet(path)
    live = spark.readStream.schema(READING).option("maxFilesPerTrigger", "1").parquet(path)
    condition = F.col("status") == "预警"
    want = rows(patterns.hold_alerts(lines, condition, "6 seconds"))
    got = drain(processors.stream_hold_alerts(live, condition, "6 seconds", delay="5 seconds"), tmp_path / "hold")
    assert rows(got) == want
    assert len(want) > 100
    want = patterns.transitions_to_running(lines)
    got = drain(processors.stream_transitions(live, delay="5 seconds"), tmp_path / "transitions")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_text_files_as_a_stream(spark, tmp_path, max_files):
    """Files come in two goes, with a restart between; small blocks, ties in time, empty lines."""
    path, ledger = tmp_path / "text", str(tmp_path / "ledger")
    path.mkdir()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    now = {"trigger": {"availableNow": True}, "max_files": max_files}
    try:
        for go, names in enumerate((["n", "b", "c"], ["a", "m"])):
            for i, name in enumerate(names):
                text = "".join(f"{name}-{j}\n" if j % 7 else "\n" for j in range(150))
                (path / f"{name}.txt").write_text(text)
                at = 1_700_000_000 + 10 * go + i // 2
                os.utime(path / f"{name}.txt", (at, at))
            live = read_lines(spark, "text", path=str(path), stream=True, ledger=ledger, **now)
            got = drain(live, tmp_path / "drain")
            want = read_lines(spark, "text", path=str(path))
            if max_files is None:
                assert rows(got) == rows(want)  # whole goes: ties are cut by path in both
            else:
                assert rows(got.select("value")) == rows(want.select("value"))
            kept = {(r._file, r._number) for r in spark.read.parquet(f"{ledger}/files").collect()}
            assert go == 0 or first < kept
            first = kept
        assert sorted(n for _, n in kept) == list(range(5))
        of_file = got.groupBy(F.shiftright("arrival", 40).alias("f")).agg(
            F.sort_array(F.collect_list(F.struct("arrival", "value"))).alias("lines")
        )
        for r in of_file.collect():
            names = [line.value for line in r.lines]
            letter = names[1].split("-")[0]
            assert names == [f"{letter}-{j}" if j % 7 else "" for j in range(150)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_repeated_batch_is_staged_once(spark, tmp_path):
    folder = str(tmp_path / "stage")
    for batch_id in (0, 1, 1, 0):
        stages.append_once(spark.range(3).withColumn("b", F.lit(batch_id)), batch_id, folder)
    spark.range(9).write.parquet(f"{folder}/_draft-2")  # of a batch that died before the rename
    stages.append_once(spark.range(2).withColumn("b", F.lit(2)), 2, folder)
    live = stages.staged_stream(spark, folder, spark.read.parquet(folder).select("id", "b").schema)
    assert rows(drain(live, tmp_path / "drain").groupBy("b").count()) == [(0, 3), (1, 3), (2, 2)]


def test_transitions_of_records_from_a_topic(spark, tmp_path):
    """The number of a record has more digits than 64 bits hold; waiting rows keep it."""
    schema = "value binary, partition int, offset bigint, timestamp timestamp"
    day, path = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), str(tmp_path / "lines")
    for part in range(3):
        made = [
            (f"{i},m{i % 2},0000,{'运行' if i % 5 == 0 else '待机'},2024-01-01 00:00:00,x,0".encode(), i % 3, 2**62 + i,
             day + dt.timedelta(seconds=i)) for i in range(20 * part, 20 * part + 20)
        ]
        if part == 2:
            made.append((b"0,flush,0000,x,2024-01-01 00:00:00,x,0", 0, 0, day + dt.timedelta(days=1)))
        kafka_lines(spark.createDataFrame(made, schema)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    want = patterns.transitions_to_running(decode.decode_changes(batch(spark, path)).rows)
    live = read_lines(
        spark, "parquet", path=path, schema="value string, arrival decimal(38,0), arrival_ts timestamp", stream=True,
        maxFilesPerTrigger="1",
    )
    for delay in (None, "5 seconds"):
        changes = decode.decode_changes(live).rows
        got = drain(processors.stream_transitions(changes, delay=delay), tmp_path / str(delay))
        assert rows(got) == rows(want)
    assert want.count() > 5


def test_readings_behind_the_watermark_are_left_out(spark, tmp_path):
    """The engine drops what is older than the watermark of the batch before; nothing else is lost."""
    path, day = str(tmp_path / "rows"), dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    sent = [[(0, "待机"), (100, "待机")], [(200, "运行")], [(50, "运行"), (150, "预警")], [(300, "待机")], [(9999, "待机")]]
    for i, readings in enumerate(sent):
        made = [("m", 10 * i + j, day + dt.timedelta(seconds=at), status) for j, (at, status) in enumerate(readings)]
        spark.createDataFrame(made, READING).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    live = spark.readStream.schema(READING).option("maxFilesPerTrigger", "1").parquet(path)
    got = rows(drain(processors.stream_transitions(live, delay="0 seconds"), tmp_path).select("arrival", "previous"))
    assert got == [(10, "预警")]


@pytest.mark.parametrize("cuts", [[0, 4], [0, 1, 2, 4], [0, 3, 4]])
def test_waiting_rows_are_followed_in_order(cuts):
    """The processor itself, with state in plain objects: chunks wait until the watermark has passed them."""
    rows_of = pd.DataFrame({"t": [4, 1, 3, 2], "order": [0, 1, 2, 3], "status": ["运行", "待机", "运行", "预警"]})
    rows_of["t"] *= 1_000_000
    machine = processors.TransitionProcessor("event", ["t", "order"])
    machine.init(PlainHandle())
    out = []
    for at, until in zip(cuts, cuts[1:]):
        parts = [rows_of.iloc[i : i + 1] for i in range(at, until)]
        out += machine.handleInputRows(("m",), iter(parts), PlainTimers(0))
    out += machine.handleInputRows(("m",), iter([]), PlainTimers(3500))
    found = pd.concat(out)
    assert found[["t", "previous", "changes"]].values.tolist() == [[3_000_000, "预警", 1]]
    assert machine.timer.get() == (4000,)  # the last reading is due when the watermark is there


class PlainState:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def clear(self):
        self.value = None

    def update(self, value):
        self.value = value

    put = update


class PlainHandle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return PlainState()

    getListState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class PlainTimers:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def run(spark, name, lines, sink_of, folder, **options):
    """Run a job to its end and return its latest-value tables."""
    flows = jobs.build(name, lines, str(folder / "state"), **options)
    tables_of = {}
    used = {}
    for flow in flows:
        for product in flow.outputs:
            if product not in sink_of:
                continue
            keys, order = sink_of[product]
            tables_of[product] = (str(folder / "tables" / product), keys)
            used[product] = sinks.latest_sink(tables_of[product][0], keys, order)
    for query in run_job(flows, used, checkpoint=str(folder / "check"), trigger={"availableNow": True}):
        query.awaitTermination()
    return {name: rows(sinks.read_latest(spark, path, keys)) for name, (path, keys) in tables_of.items()}


KV = (["key"], None)
JOB_CASES = {
    "order_totals": ({"kpis": KV, codes.TABLE_ORDER_INFO: (["id"], "id")}, {}),
    "order_rates": ({"kpis": KV}, {}),
    "order_count": ({"kpis": KV}, {}),
    "top_users": ({"kpis": KV, codes.TABLE_ORDER_INFO: (["row_key"], "arrival"), codes.KEY_TOP_USERS: KV}, {}),
    "top_skus": ({codes.KEY_TOP_SKU_QUANTITY: KV, codes.KEY_TOP_SKU_AMOUNT: KV}, {}),
    "produced_latest": ({codes.HASH_PRODUCED: (["key", "field"], None)}, {"size": "1 day"}),
    "produced_with_zeros": ({"counts": (["machine_id", "window_start"], "window_end")}, {"size": "1 day"}),
    "produced": ({"counts": (["machine_id", "window_start"], "window_end")}, {"size": "1 day"}),
    "produced_rows": ({codes.TABLE_PRODUCED: (["row_key"], None)}, {}),
    "warning_counts": ({codes.TABLE_WARNING_COUNT: (["machine_id", "window_end"], None)}, {"size": "1 day"}),
    "warning_top": ({codes.HASH_TOP_WARNING: (["key", "field"], None)}, {"size": "3 days", "slide": "1 day"}),
    "transitions": ({codes.TABLE_TRANSITIONS: (["machine_id", "changes"], None)}, {}),
    "temperature_held": ({codes.TABLE_TEMPERATURE: (["row_key"], "alert_time")}, {"hold": "6 hours"}),
    "warning_held": (
        {"alerts": (["machine_id", "alert_time"], "message"), codes.HASH_WARNING_HELD: (["key", "field"], "alert_time")},
        {"hold": "6 hours"},
    ),
}


@pytest.mark.parametrize("name", JOB_CASES)
def test_job_on_stream_equals_batch(spark, captured, tmp_path, name):
    products, options = JOB_CASES[name]
    paths = {kind: captured(kind, 3) for kind in jobs.JOBS[name].inputs}
    want = run(
        spark, name, {k: batch(spark, p) for k, p in paths.items()}, products, tmp_path / "batch", **options
    )
    got = run(
        spark, name, {k: stream(spark, p) for k, p in paths.items()}, products, tmp_path / "stream", **options
    )
    # The window of the flush line itself stays open.
    want = {p: [r for r in found if "flush" not in str(r)] for p, found in want.items()}
    assert got == want
    assert all(want.values())


def test_join_on_stream(spark, captured, tmp_path):
    paths = {kind: captured(kind, 2) for kind in ("order", "order_detail")}
    sink_of = {"kpis": KV, codes.KEY_TOP_SKU_AMOUNT: KV, codes.TABLE_ORDER_JOIN: (["row_key"], joins.PAIR_ORDER)}
    options = {"size": "30 days", "delay": "4000 days"}
    want = run(
        spark, "orders_with_details", {k: batch(spark, p) for k, p in paths.items()}, sink_of, tmp_path / "b", **options
    )
    got = run(
        spark, "orders_with_details", {k: stream(spark, p) for k, p in paths.items()}, sink_of, tmp_path / "s", **options
    )
    assert len(want[codes.TABLE_ORDER_JOIN]) > 10
    assert got == want


def test_rejects_on_stream(spark, captured, tmp_path):
    paths = {kind: captured(kind, 2) for kind in ("order", "order_detail")}
    sink_of = {"rejects_order": (["arrival"], None), "rejects_order_detail": (["arrival"], None)}
    want, got = (
        run(spark, "orders_with_details", {k: read(spark, p) for k, p in paths.items()}, sink_of, tmp_path / folder)
        for read, folder in ((batch, "b"), (stream, "s"))
    )
    assert got == want
    assert all(want.values())


def test_orders_without_a_number_count(spark, lines, tmp_path):
    made = {"order": lines([order_line(id="x"), order_line(id=2)]), "order_detail": lines([])}
    got = run(spark, "orders_with_details", made, {"kpis": KV}, tmp_path)
    assert got["kpis"] == [(codes.KEY_ORDER_COUNT, "2")]


def test_lines_of_a_stream_are_read_once(spark, captured, tmp_path):
    path = captured("order", 1)
    flows = jobs.build("order_rates", {"order": stream(spark, path)}, str(tmp_path / "state"))
    sink = {"kpis": sinks.kv_set(str(tmp_path / "table"))}
    (query,) = run_job(flows, sink, checkpoint=str(tmp_path / "check"), trigger={"availableNow": True})
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == batch(spark, path).count()


def test_rows_and_rejects_come_from_one_read(spark, captured, tmp_path):
    path = captured("order", 2)
    flows = jobs.build("order_rates", {"order": stream(spark, path)}, str(tmp_path / "state"))
    sink = {"kpis": sinks.kv_set(str(tmp_path / "kpis")), "rejects_order": sinks.rows_append(str(tmp_path / "rejects"))}
    (query,) = run_job(flows, sink, checkpoint=str(tmp_path / "check"), trigger={"availableNow": True})
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == batch(spark, path).count()
    want = decode.decode_orders(batch(spark, path), date_only=True).rejects
    assert rows(sinks.read_rows(spark, str(tmp_path / "rejects"))) == rows(want.select("value", "arrival", "arrival_ts", "reason"))


def test_each_source_of_a_job_is_read_once(spark, captured, tmp_path):
    """Three products of the orders, three of the details; only two queries read lines."""
    paths = {kind: captured(kind, 2) for kind in ("order", "order_detail")}
    flows = jobs.build("orders_with_details", {k: stream(spark, p) for k, p in paths.items()}, str(tmp_path / "state"))
    sink = {p: sinks.rows_append(str(tmp_path / "tables" / p)) for flow in flows for p in flow.outputs}
    queries = run_job(flows, sink, checkpoint=str(tmp_path / "check"), trigger={"availableNow": True})
    read = {}
    for query in queries:
        query.awaitTermination()
        for progress in query.recentProgress:
            for source in progress["sources"]:
                of = [k for k, p in paths.items() if source["description"].endswith(f"{p}]")]
                for kind in of:
                    read[kind] = read.get(kind, 0) + source["numInputRows"]
    assert read == {k: batch(spark, p).count() for k, p in paths.items()}
    assert len(queries) == 5


def test_join_on_stream_lets_go_of_closed_windows(spark, tmp_path):
    """Lines of fourteen batches; the state holds the open windows, and what comes behind the watermark is counted."""
    day = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    paths = {kind: str(tmp_path / kind) for kind in ("order", "order_detail")}
    for part in range(14):
        seconds = range(10 * part, 10 * part + 10)
        orders = [(order_line(id=s, amount=f"{s}.00"), s, day + dt.timedelta(seconds=s)) for s in seconds]
        details = [(f"{s},{s},3,sku,1,{s},2020-4-25 18:47:14", s, day + dt.timedelta(seconds=s)) for s in seconds]
        if part == 10:  # far more than the delay and a window
            details.append(("1,5,3,sku,1,9,2020-4-25 18:47:14", 1000, day + dt.timedelta(seconds=5)))
        for kind, made in (("order", orders), ("order_detail", details)):
            spark.createDataFrame(made, LINE).coalesce(1).write.mode("append").parquet(paths[kind])
        time.sleep(0.02)
    flows = jobs.build(
        "orders_with_details", {k: stream(spark, p) for k, p in paths.items()}, str(tmp_path / "state"),
        size="2 seconds", delay="10 seconds", files=1,
    )
    table = str(tmp_path / "table")
    sink = {codes.TABLE_ORDER_JOIN: sinks.latest_sink(table, ["row_key"], joins.PAIR_ORDER)}
    queries = run_job(flows, sink, checkpoint=str(tmp_path / "check"), trigger={"availableNow": True})
    for query in queries:
        query.awaitTermination()
    states = [s for p in queries[-1].recentProgress for s in p["stateOperators"]]
    kept = [s["numRowsTotal"] for s in states]
    assert len(kept) >= 14
    # A batch of ten seconds on both sides, the delay, and the batch that the watermark is behind.
    assert max(kept) <= 2 * (10 + 10 + 10 + 2) and sum(s["numRowsRemoved"] for s in states) > 150
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 1
    want = [(str(s), f"{s}.00", str(s)) for s in range(140)]
    got = sinks.read_latest(spark, table, ["row_key"]).select("row_key", "orderprice", "orderdetailcount")
    assert rows(got) == sorted(want, key=str)


def test_late_pairs_on_stream(spark, tmp_path):
    """The second batch brings an earlier pair of an order; the later pair stays."""

    def line(value, arrival, second):
        return [(value, arrival, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second))]

    paths = {kind: str(tmp_path / kind) for kind in ("order", "order_detail")}
    for arrival, second, amount, num in ((1, 100, "20", 9), (2, 0, "10", 5)):
        order = line(order_line(id=1, amount=amount), arrival, second)
        detail = line(f"{arrival},1,3,sku,1,{num},2020-4-25 18:47:14", arrival, second)
        for kind, rows_of in (("order", order), ("order_detail", detail)):
            spark.createDataFrame(rows_of, LINE).coalesce(1).write.mode("append").parquet(paths[kind])
    sink_of = {"kpis": KV, codes.KEY_TOP_SKU_AMOUNT: KV, codes.TABLE_ORDER_JOIN: (["row_key"], joins.PAIR_ORDER)}
    for read, folder in ((batch, "b"), (stream, "s")):
        lines = {k: read(spark, p) for k, p in paths.items()}
        got = run(spark, "orders_with_details", lines, sink_of, tmp_path / folder, delay="1 hour")
        assert got[codes.TABLE_ORDER_JOIN] == [("1", "1", "20.00", "9")]


def test_restart_between_batches(spark, captured, tmp_path):
    """New files after a restart go on from the stored figures."""
    source = captured("order", 4)
    files = sorted(spark.read.parquet(source).inputFiles())
    path = str(tmp_path / "lines")
    folder = tmp_path / "job"
    for part in (files[:2], files[2:]):
        for file in part:
            spark.read.parquet(file).coalesce(1).write.mode("append").parquet(path)
        got = run(spark, "order_rates", {"order": stream(spark, path)}, {"kpis": KV}, folder)
    want = run(spark, "order_rates", {"order": batch(spark, path)}, {"kpis": KV}, tmp_path / "batch")
    # The order of arrival differs between files, not the totals.
    assert [r for r in got["kpis"] if r[0] != "cancelrate"] == [r for r in want["kpis"] if r[0] != "cancelrate"]


def test_windows_of_a_stream_close_in_append_mode(spark, captured, tmp_path):
    path = captured("produce", 3)
    produce = decode.decode_produce(stream(spark, path)).rows.withWatermark("arrival_ts", "0 seconds")
    got = drain(windows.produce_count_conditional(produce, "1 day"), tmp_path)
    want = windows.produce_count_conditional(decode.decode_produce(batch(spark, path)).rows, "1 day")
    assert rows(got) == rows(want.where(F.col("machine_id") != "flush"))


def test_all_cores_write_a_staged_batch_and_readers_take_it_whole(spark, captured, tmp_path):
    """Batches of the stage have the same number of files, also where some tasks have no rows."""
    paths = {kind: captured(kind, 2) for kind in ("order", "order_detail")}
    lines = {k: stream(spark, p) for k, p in paths.items()}
    flows = jobs.build("orders_with_details", lines, str(tmp_path / "state"), size="30 days", delay="4000 days", files=1)
    table = str(tmp_path / "table")
    sink = {codes.TABLE_ORDER_JOIN: sinks.latest_sink(table, ["row_key"], joins.PAIR_ORDER)}
    queries = run_job(flows, sink, checkpoint=str(tmp_path / "check"), trigger={"availableNow": True})
    for query in queries:
        query.awaitTermination()
    cores = spark.sparkContext.defaultParallelism
    batches = sorted((tmp_path / "state/orders_with_details/staged_order_detail").glob("batch_id=*"))
    assert cores > 1 and len(batches) > 1
    assert [len([f for f in b.iterdir() if f.name.startswith("part-")]) for b in batches] == [cores] * len(batches)
    taken = [s["numInputRows"] for p in queries[-1].recentProgress for s in p["sources"] if "staged_order_detail" in s["description"]]
    assert [n for n in taken if n] == [spark.read.parquet(str(b)).count() for b in batches]


def test_files_of_a_batch_stay_over_restarts(spark, tmp_path):
    folder = str(tmp_path / "stage")
    files = stages.files_a_batch(spark, folder, 1)
    assert stages.files_a_batch(spark, folder, 3) == files == spark.sparkContext.defaultParallelism
    for batch_id in (0, 1, 1):
        stages.append_once(spark.range(3 * batch_id).coalesce(1), batch_id, folder, files)
    assert spark.read.parquet(folder).count() == 3
    assert len(spark.read.parquet(folder).inputFiles()) == 2 * files


class Held:
    """Counts how often a micro-batch is held."""

    held = 0

    def persist(self):
        self.held += 1

    def unpersist(self):
        pass


@pytest.mark.parametrize("wanted", [False, True])
def test_a_batch_that_is_only_staged_is_not_held(wanted):
    batch, done = Held(), []
    sink = {"rejects": lambda rows, batch_id, name: done.append(name)} if wanted else {}
    outputs = {"rejects": lambda rows, batch_id: rows}
    write_outputs(batch, 0, outputs, sink, streamed=True, stage=lambda rows, batch_id: done.append("stage"))
    assert done == ["stage", *sink] and batch.held == wanted


def test_captured_lines_lie_on_disk_once(lines, tmp_path):
    made = lines([f"line {i}" for i in range(20)]).repartition(3)
    for name, capture in (("a", stream_queries.capture), ("b", lambda rows, path: stream_queries.capture_late(rows, path, "5 seconds"))):
        capture(made, str(tmp_path / name))
        assert rows(made.sparkSession.read.parquet(str(tmp_path / name))) == rows(made)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
