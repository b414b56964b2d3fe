from __future__ import annotations

from line_rows import order_line, rows
from pyspark.sql import functions as F

from pulseline.operators import decode, joins, windows


def produce(lines, *readings):
    return decode.decode_produce(lines([f"1,{m},0000,{flag}" for m, flag, _ in readings], [s for *_, s in readings])).rows


def test_window_without_passed_products(lines):
    found = produce(lines, ("a", 0, 0), ("b", 1, 10), ("b", 0, 20))
    assert rows(windows.produce_count_filtered(found).select("machine_id", "cnt")) == [("b", 1)]
    assert rows(windows.produce_count_conditional(found).select("machine_id", "cnt")) == [("a", 0), ("b", 1)]


def test_windows_align_to_the_epoch(lines):
    counts = windows.produce_count_filtered(produce(lines, ("a", 1, 299), ("a", 1, 300), ("a", 1, 599.9)))
    assert rows(counts.select(F.date_format("window_end", "HH:mm:ss"), "cnt")) == [("00:05:00", 1), ("00:10:00", 2)]


def test_latest_window_and_row_key(lines):
    counts = windows.produce_count_filtered(produce(lines, ("a", 1, 0), ("a", 1, 1), ("a", 1, 301)))
    assert rows(windows.produce_latest_window(counts)) == [("totalproduce", "a", "1")]
    assert rows(windows.produce_rowkey(counts)) == [
        ("a-2024-01-01 00:05:00.000", "a", "2"), ("a-2024-01-01 00:10:00.000", "a", "1"),
    ]


def changes(lines, *readings):
    made = [f"1,{m},0000,{status},t,x,{flag}" for m, status, flag, _ in readings]
    return decode.decode_changes(lines(made, [s for *_, s in readings])).rows


def test_flagged_warnings(lines):
    found = changes(lines, ("a", "预警", 2, 0), ("a", "预警", 3, 1), ("a", "运行", 2, 2), ("a", "预警", -2, 179))
    got = windows.warning_count_tumbling(found).select("machine_id", "cnt", "window_end_text")
    assert rows(got) == [("a", 2, "2024-01-01 00:03:00")]


def test_top_warning_machine_per_sliding_window(lines):
    found = changes(lines, ("b", "预警", 1, 0), ("a", "预警", 1, 61), ("b", "预警", 1, 62), ("c", "运行", 1, 63))
    got = rows(windows.warning_top_sliding(found).select(F.date_format("window_end", "HH:mm"), "machine_id", "cnt"))
    assert got == [("00:01", "b", 1), ("00:02", "b", 2), ("00:03", "b", 2), ("00:04", "a", 1)]


def sides(lines):
    orders = lines([order_line(id=1, amount="10"), order_line(id=2)], [0.1, 5])
    details = lines(
        [f"{i},{o},sku,x,1.00,{n},2020-4-25 18:47:14" for i, o, n in ((1, 1, 3), (2, 1, 4), (3, 1, 5), (4, 2, 6))],
        [0.2, 0.9, 1.0, 9],
    )
    return decode.decode_orders(orders).rows, decode.decode_order_details(details).rows


def test_join_inside_the_window(lines):
    orders, details = sides(lines)
    got = joins.order_detail_window_join(orders, details)
    assert rows(got) == [(1, "10.00", "3"), (1, "10.00", "4")]


def test_last_pair_of_an_order(lines):
    orders, details = sides(lines)
    assert rows(joins.pair_cells(joins.order_detail_latest(orders, details))) == [(1, "10.00", "4")]
