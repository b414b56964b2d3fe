"""Merged keyed tables, ranked sums and running values over the batches of a stream."""

from __future__ import annotations

import random

import pytest
from line_rows import order_line, rows
from pyspark.sql import functions as F

from pulseline.operators import decode, running, topk
from pulseline.streaming import folds, keyed, sinks
from pulseline.streaming.keyed import KeyedTable


def pairs(spark, *made):
    return spark.createDataFrame(list(made), "key string, value bigint")


def content(table):
    found = table.content()
    return [] if found is None else rows(found.select("key", "value"))


def files(table):
    return sorted(str(p.relative_to(table.path)) for p in keyed_path(table).rglob("*.parquet"))


def keyed_path(table):
    from pathlib import Path

    return Path(table.path)


def test_batches_change_their_own_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["key"], buckets=16)
    assert table.content() is None and table.pointer() is None
    table.merge(pairs(spark, *[(f"k{i}", 0) for i in range(60)]), 0)
    first = table.pointer()
    assert len(first.buckets) > 10
    table.merge(pairs(spark, ("k7", 1), ("new", 1)), 1)
    second = table.pointer()
    changed = {b for b in second.buckets if second.buckets[b] != first.buckets.get(b)}
    assert changed == set(table.touched(pairs(spark, ("k7", 1), ("new", 1))))
    assert content(table) == rows(pairs(spark, *[(f"k{i}", int(i == 7)) for i in range(60)], ("new", 1)))


def test_reading_costs_the_same_after_many_batches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["key"], buckets=2)
    want = {}
    for i in range(30):
        made = {f"k{(i * 7 + j) % 11}": i for j in range(2)}
        want |= made
        table.merge(pairs(spark, *made.items()).coalesce(1), i)
    assert content(table) == sorted(want.items(), key=str)
    read = table.content()
    assert len(read.inputFiles()) <= 2
    assert "Aggregate" not in read._jdf.queryExecution().executedPlan().toString()
    assert len([n for n in table.folder.names("pointers")]) == keyed.KEPT
    # Of old versions only what the kept pointers name is left.
    assert len(files(table)) <= 2 * keyed.KEPT


def test_repeated_batches_and_a_crash_before_the_swap(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["key"], buckets=4)
    table.merge(pairs(spark, ("a", 1), ("b", 1)), 0)
    with monkeypatch.context() as patch:
        patch.setattr(keyed.Folder, "put", lambda self, name, text: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(pairs(spark, ("a", 2), ("c", 2)), 1)
    assert content(table) == [("a", 1), ("b", 1)]
    left = [n for n in table.folder.names("versions") if n not in table.pointer().buckets.values()]
    assert len(left) == 1
    assert table.merge(pairs(spark, ("a", 2), ("c", 2)), 1)
    assert not set(left) & set(table.folder.names("versions"))
    for again in (0, 1):
        assert not table.merge(pairs(spark, ("a", 9)), again)
    assert content(table) == [("a", 2), ("b", 1), ("c", 2)]
    assert rows(table.content(before=1).select("key", "value")) == [("a", 1), ("b", 1)]


def test_empty_batches_null_keys_and_late_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["key"], order=["value"], buckets=4)
    table.merge(pairs(spark), 0)
    assert content(table) == []
    table.merge(pairs(spark, (None, 5), ("a", 7)), 1)
    table.merge(pairs(spark, (None, 4), ("a", 8)), 2)
    assert content(table) == sorted([(None, 5), ("a", 8)], key=str)


def test_sinks_with_buckets_equal_those_without(spark, tmp_path):
    rng = random.Random(2)
    plain, merged = str(tmp_path / "plain"), str(tmp_path / "merged")
    for batch in range(4):
        made = [(f"k{rng.randrange(9)}", rng.randrange(10**6)) for _ in range(12)]
        frame = pairs(spark, *made).withColumn("n", F.col("value") % 100000)
        for product in ("p", "q"):
            for path, buckets in ((plain, None), (merged, 3)):
                sinks.latest_sink(path, ["key"], "n", buckets)(frame, batch, product)
    want = rows(sinks.read_latest(spark, plain, ["key"]).select("key", "value"))
    assert rows(sinks.read_latest(spark, merged, ["key"]).select("key", "value")) == want


@pytest.mark.parametrize("cuts", [(), (10,), (3, 4, 30)])
def test_ranked_sums_equal_those_of_all_rows(spark, tmp_path, cuts):
    """Sums that shrink lose their place, and every batch holds the keys it has changed only."""
    rng = random.Random(5)
    events = [(f"k{rng.randrange(12)}", rng.randrange(-50, 60)) for _ in range(40)]
    ranking = folds.Ranking(str(tmp_path / "r"), ["key"], {"value": 3})
    ends = [0, *cuts, len(events)]
    sums = {}
    for batch, (a, b) in enumerate(zip(ends, ends[1:])):
        for key, value in events[a:b]:
            sums[key] = sums.get(key, 0) + value
        changed = pairs(spark, *[(k, sums[k]) for k in {k for k, _ in events[a:b]}])
        for _ in range(2):  # the second time is a repeated batch
            got = [tuple(r) for r in ranking.top(changed, batch, "value").collect()]
            assert got == sorted(sums.items(), key=lambda r: (-r[1], r[0]))[:3]


SEQUENCES = [
    (running.running_sales_total, "total"), (running.running_refund_total, "total"),
    (running.running_order_count, "orders"), (running.running_cancel_rate, "cancel_rate"),
]


@pytest.mark.parametrize("operator, column", SEQUENCES)
@pytest.mark.parametrize("cuts", [(1, 5, 5, 30)])
def test_running_values_go_on_over_batches(lines, tmp_path, operator, column, cuts):
    rng = random.Random(3)
    made = [order_line(id=i, status=rng.choice("1001 1002 1003 1005 1006".split()), amount=f"{i}.25") for i in range(40)]
    orders = decode.decode_orders(lines(made)).rows.persist()
    want = rows(operator(orders).select("arrival", "id", column))
    ends, got = [0, *cuts, len(made)], []
    for batch, (a, b) in enumerate(zip(ends, ends[1:])):
        part = orders.where(f"arrival >= {a} AND arrival < {b}")
        for _ in range(2):
            found = rows(operator(part, sums=folds.RunningSums(batch, str(tmp_path / "s"))).select("arrival", "id", column))
        got += found
    assert sorted(got, key=str) == want
    assert operator(orders).schema == operator(orders, sums=folds.RunningSums(0, str(tmp_path / "t"))).schema


@pytest.mark.parametrize("operator", [running.sku_running_quantity, running.sku_running_amount])
@pytest.mark.parametrize("cuts", [(2, 3, 25)])
def test_running_values_per_product_go_on_over_batches(lines, tmp_path, operator, cuts):
    rng = random.Random(4)
    made = [f"{i},{i},n,s{rng.randrange(5)},{i}.5,{rng.randrange(1, 9)},2020-4-25 18:47:14" for i in range(40)]
    made = [",".join([a, b, sku, name, price, num, time]) for a, b, name, sku, price, num, time in (m.split(",") for m in made)]
    details = decode.decode_order_details(lines(made)).rows.persist()
    want = rows(operator(details))
    assert len(want) > 30
    ends, got = [0, *cuts, len(made)], []
    for batch, (a, b) in enumerate(zip(ends, ends[1:])):
        part = details.where(f"arrival >= {a} AND arrival < {b}")
        for _ in range(2):
            found = rows(operator(part, sums=folds.RunningSums(batch, str(tmp_path / "s"))).select(*operator(details).columns))
        got += found
    assert sorted(got, key=str) == want


def test_whole_console(spark, capsys):
    sinks.console(rows=None)(pairs(spark, *[(f"k{i:02}", i) for i in range(30)]), 0, "p")
    assert capsys.readouterr().out.splitlines() == ["key | value"] + [f"k{i:02} | {i}" for i in range(30)]


def test_top_texts_of_a_stream_follow_the_table(spark):
    sums = pairs(spark, ("a", 3), ("b", 9), ("c", 9))
    assert rows(topk.top_k_text(sums.select("key", F.col("value")), 3, "n")) == [("n", "[b:9,c:9,a:3]")]
