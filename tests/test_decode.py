from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from line_rows import order_line, rows
from pyspark.sql import functions as F

from pulseline.operators import decode, kpis, routing, running
from pulseline.operators.ranges import plan_ranges
from pulseline.sources import lines as sources


def reasons(decoded):
    return {r.value: r.reason for r in decoded.rejects.collect()}


def test_trailing_commas_do_not_count(lines):
    got = decode.decode_produce(lines(["7,m1,0000,1,,", "8,m2,0000,0"])).rows
    assert rows(got.select("machine_id", "passed")) == [("m1", "1"), ("m2", "0")]


@pytest.mark.parametrize(
    "created", ["2020-4-25 18:47:14", "2020-04-25 18:47:14", "2020-4-25 18:47:14.0", "2020-4-25 18:47:14 and more"]
)
def test_times_are_read_leniently(lines, created):
    row = decode.decode_orders(lines([order_line(created=created)])).rows.first()
    assert row.create_time == dt.datetime(2020, 4, 25, 18, 47, 14)


def test_out_of_range_time_is_rejected(lines):
    line = order_line(created="2020-13-05 00:00:00")
    assert reasons(decode.decode_orders(lines([line]))) == {line: "bad_time"}


def test_numbers_have_to_be_numbers(lines):
    bad = [order_line(amount="n/a"), order_line(id="x"), order_line(amount="NaN"), order_line(id="99999999999999999999")]
    assert reasons(decode.decode_orders(lines(bad))) == dict.fromkeys(bad, "bad_number")
    detail = "1,2,3,sku,9.50,5.7,2020-4-25 18:47:14"
    assert reasons(decode.decode_order_details(lines([detail]))) == {detail: "bad_number"}
    reading = "1,m,a,b,c,NaN,d"
    assert reasons(decode.decode_environment(lines([reading]))) == {reading: "bad_number"}


def test_amounts_are_exact_decimals(lines):
    amounts = ["0.1", "1.9786518E7", "6665", "-3.25", ".5"]
    got = decode.decode_orders(lines([order_line(amount=a) for a in amounts])).rows.orderBy("arrival")
    want = [Decimal("0.10"), Decimal("19786518.00"), Decimal("6665.00"), Decimal("-3.25"), Decimal("0.50")]
    assert [r.amount for r in got.collect()] == want


def test_short_lines(lines):
    decoded = decode.decode_orders(lines(["bad", "", ",,,"]))
    assert decoded.rows.count() == 0
    assert reasons(decoded) == dict.fromkeys(["bad", "", ",,,"], "short")


def test_strict_decoding_fails_the_job(lines):
    good = decode.decode_produce(lines(["7,m1,0000,1"]), on_bad="fail").rows
    assert good.count() == 1
    with pytest.raises(Exception, match="malformed line: bad"):
        decode.decode_produce(lines(["7,m1,0000,1", "bad"]), on_bad="fail").rows.collect()


def test_date_only(lines):
    both = lines([order_line(created="2020-4-25 18:47:14"), order_line(created="2020-4-25")])
    got = decode.decode_orders(both, date_only=True).rows
    assert {r.create_time for r in got.collect()} == {dt.datetime(2020, 4, 25)}


def test_fields_that_are_not_required_may_be_bad(lines):
    bad = lines([order_line(amount="n/a")])
    row = decode.decode_orders(bad, required=("status", "create_time", "operation_time")).rows.first()
    assert row.amount is None and row.status == "1001"


def test_changes_without_time(lines):
    line = "1,m1,0000,运行,not a time,x,4"
    assert decode.decode_changes(lines([line])).rows.count() == 1
    assert reasons(decode.decode_changes(lines([line]), with_time=True)) == {line: "bad_time"}


def test_event_time_is_the_later_time(lines):
    line = order_line(created="2020-4-25 18:47:14", operated="2020-4-26 00:00:00")
    row = decode.with_event_time(decode.decode_orders(lines([line])).rows).first()
    assert row.event_time == dt.datetime(2020, 4, 26)


def test_reject_counts(lines):
    decoded = decode.decode_orders(lines(["bad", order_line(), order_line(amount="n/a"), "short,line"]))
    assert rows(decode.reject_counts(decoded)) == [("bad_number", 1), ("short", 2)]


def test_flags_are_even(lines):
    changes = decode.decode_changes(lines([f"1,m,0000,预警,t,x,{flag}" for flag in (-2, 0, 3)])).rows
    assert rows(routing.flagged_warnings(changes).select("flag")) == [(-2,), (0,)]


def test_routes(lines):
    statuses = ["1001", "1002", "1003", "1004", "1005", "1006", "1007"]
    orders = decode.decode_orders(lines([order_line(id=s, status=s) for s in statuses])).rows
    routed = routing.route_orders(orders)
    assert rows(routed.select("status", "route")) == [
        ("1001", "sales"), ("1002", "sales"), ("1003", "cancelled"), ("1004", "sales"),
        ("1005", "refund_requested"), ("1006", "refunded"),
    ]
    assert rows(routing.take_route(routed, routing.CANCELLED).select("id")) == [(1003,)]


def test_each_line_is_parsed_once(lines):
    plan = decode.decode_orders(lines([order_line()])).rows.where("status = '1001'").select("id", "amount")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1
    assert text.count("regexp_extract(") == 2


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("7,m1,0000,1\n8,m2,0000,0\n")
    got = sources.read_lines(spark, "text", path=str(tmp_path))
    assert rows(got.select("value")) == [("7,m1,0000,1",), ("8,m2,0000,0",)]
    assert got.select("arrival").distinct().count() == 2
    assert got.where(F.col("arrival_ts").isNull()).count() == 0


def test_text_files_keep_their_order(spark, tmp_path):
    """A small old file, a large one cut into blocks, and a small new one whose name comes first."""
    want = ["a-0", "a-1", *(f"b-{i}" for i in range(60_000)), "", "c"]
    for at, (name, part) in enumerate({"n.txt": want[:2], "o.txt": want[2:-2], "a.txt": want[-2:]}.items()):
        (tmp_path / name).write_text("\n".join(part) + "\n")
        os.utime(tmp_path / name, (1_700_000_000 + at, 1_700_000_000 + at))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = sources.read_lines(spark, "text", path=str(tmp_path)).orderBy("arrival").collect()
        by_path = sources.read_lines(spark, "text", path=str(tmp_path), files_by="path").orderBy("arrival").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.value for r in got] == want
    assert len({r.arrival for r in got}) == len(want)
    assert by_path.value == ""


def test_a_stream_of_text_files_names_a_ledger(spark, tmp_path):
    with pytest.raises(ValueError, match="ledger"):
        sources.read_lines(spark, "text", path=str(tmp_path), stream=True)


def test_white_space_around_numbers(lines):
    reading = decode.decode_environment(lines(["1,m,a,b,c, 39.5 ,d"])).rows.first()
    assert reading.temperature == 39.5
    assert decode.decode_orders(lines([order_line(amount=" 7.5 ")])).rows.first().amount == Decimal("7.50")
    bad = order_line(id=" 7 ")
    assert reasons(decode.decode_orders(lines([bad]))) == {bad: "bad_number"}


def test_kafka_records(spark):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    made = [(None, b"a,b", "t", p, o, dt.datetime(2024, 1, 1, 0, 0, o), 0) for p in (0, 1) for o in (0, 1)]
    got = sources.kafka_lines(spark.createDataFrame(made, schema))
    assert got.select("arrival").distinct().count() == 4
    assert {r.value for r in got.collect()} == {"a,b"}


RECORD = "value binary, partition int, offset bigint, timestamp timestamp"


def test_uneven_partitions_arrive_in_order_of_time(spark):
    """A partition of many lines at a large offset, and one that has just begun; the rate depends on the order."""
    day, big = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), 2**62
    statuses = ["1001", "1003", "1001", "1001", "1003", "1001", "1001", "1001", "1001"]
    made, short = [], 0
    for i, status in enumerate(statuses):
        partition, offset = (65_535, short) if i in (1, 4) else (0, big + i)
        short += partition > 0
        made.append((order_line(id=i, status=status).encode(), partition, offset, day + dt.timedelta(milliseconds=i)))
    lines = sources.kafka_lines(spark.createDataFrame(made[::-1], RECORD))
    assert dict(lines.dtypes)["arrival"] == "decimal(38,0)"
    orders = decode.decode_orders(lines).rows
    assert [r.id for r in orders.orderBy("arrival").collect()] == list(range(len(statuses)))
    for ranges in (None, plan_ranges(orders, "arrival", target_rows=2)):
        rates = running.running_cancel_rate(orders, ranges=ranges).orderBy("arrival").collect()
        assert [(r.id, r.cancels, r.orders) for r in rates] == [(1, 1, 2), (4, 2, 5)]
    assert dict(rows(kpis.order_kpis_latest(orders)))["cancelrate"] == "40.0%"


def test_records_of_one_millisecond_are_told_apart(spark):
    """The largest offset and partition, times before 1970 and far ahead: the order is that of the three parts."""
    times = [dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc) for y in (1969, 1970, 2024, 5000)]
    made = [(b"x", p, o, t) for t in times for p in (0, 1, 99_999) for o in (0, 1, 2**63 - 1)]
    keyed = spark.createDataFrame(made[::-1], RECORD)
    numbers = [r.arrival for r in sources.kafka_lines(keyed.orderBy("timestamp", "partition", "offset")).collect()]
    assert numbers == sorted(set(numbers)) and len(numbers) == len(made)


def test_captured_records_keep_their_number(spark, tmp_path):
    made = [(b"x", 3, 2**62, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))]
    lines = sources.kafka_lines(spark.createDataFrame(made, RECORD))
    lines.write.parquet(str(tmp_path / "lines"))
    assert rows(sources.read_lines(spark, "parquet", path=str(tmp_path / "lines"))) == rows(lines)


def test_kafka_options():
    options = sources.kafka_options("order", "b1:9092", start="latest", stream=True, group="g", max_per_trigger=10)
    assert options == {
        "subscribe": "order", "kafka.bootstrap.servers": "b1:9092", "startingOffsets": "latest",
        "groupIdPrefix": "g", "maxOffsetsPerTrigger": "10",
    }
    with pytest.raises(ValueError):
        sources.kafka_options("order", "b1:9092", start="latest", stream=False)
