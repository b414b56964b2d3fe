from __future__ import annotations

import random

import numpy as np
import pytest
from line_rows import at, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseline.operators import decode, holds, patterns
from pulseline.operators.ranges import plan_ranges

SCHEMA = "machine_id string, arrival_ts timestamp, arrival bigint, status string, temperature double"


def walk_slowly(readings, hold):
    """One reading after the other."""
    alerts, start, last = [], None, None
    for t, match in readings:
        if start is not None and t > start + hold:
            alerts.append((start + hold, last))
            start = None
        if match:
            start, last = (t if start is None else start), t
        else:
            start = None
    return alerts, start, last


readings = st.lists(st.tuples(st.integers(0, 60), st.sampled_from([True, True, True, False])), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(readings, st.integers(1, 25), st.sets(st.integers(0, 60), max_size=6))
def test_stretches_of_any_cut_give_the_same_alerts(found, hold, cuts):
    found = sorted(found, key=lambda r: r[0])
    alerts, pending, _ = walk_slowly(found, hold)
    merged = {}
    for t, match in found:
        merged[t] = (merged.get(t, (False, False))[0] or not match, match)
    parts = {}
    for t in sorted(merged):
        parts.setdefault(sum(t >= c for c in cuts), []).append((t, *merged[t]))
    start = seen = None
    joined, got = None, []
    for part in parts.values():
        t, reset, match = (np.array(column) for column in zip(*part))
        stretch = holds.summarize(t, reset, match, hold)
        more, left, _ = holds.walk(t, reset, match, hold, start, seen)
        assert stretch.after(start, hold) == left
        got += more
        start, seen = left, stretch.last
        joined = stretch if joined is None else holds.join(joined, stretch, hold)
    assert (got, start) == (alerts, pending)
    assert joined.after(None, hold) == pending


def machine(spark, *readings, other_end=None):
    made = [("m", at(s), i, "预警" if match else "运行", 40.0 if match else 30.0) for i, (s, match) in enumerate(readings)]
    if other_end is not None:
        made.append(("other", at(other_end), len(made), "运行", 30.0))
    return spark.createDataFrame(made, SCHEMA)


def alert_seconds(df, hold="30 seconds"):
    alerts = patterns.hold_alerts(df, F.col("status") == "预警", hold)
    found = alerts.select((F.unix_micros("alert_time") - F.unix_micros(F.lit(at(0)))) / 1_000_000).collect()
    return sorted(r[0] for r in found)


def test_hold_ends_exactly_at_the_reset(spark):
    assert alert_seconds(machine(spark, (0, True), (30, False))) == []
    assert alert_seconds(machine(spark, (0, True), (30.000001, False))) == [30]


def test_hold_starts_again_after_an_alert(spark):
    found = machine(spark, (0, True), (20, True), (40, True), (80, True), (81, False))
    assert alert_seconds(found) == [30, 70]


def test_silent_tail(spark):
    assert alert_seconds(machine(spark, (0, True), other_end=31)) == [30]
    assert alert_seconds(machine(spark, (0, True), other_end=30)) == []


def test_last_match_and_message(spark):
    found = machine(spark, (0, True), (20, True), (40, False)).withColumn("start_time", F.col("arrival_ts"))
    row = patterns.warning_held(found).first()
    assert row.message == "2024-01-01 00:00:20:设备m连续30秒为预警状态请尽快处理！"


def test_temperature(spark):
    found = machine(spark, (0, True), (100, True), (200, False))
    assert patterns.temperature_held(found).count() == 1
    assert patterns.temperature_held(machine(spark, (0, True), (100, False), (300, False))).count() == 0


@pytest.fixture(scope="module")
def fleet(spark):
    """One machine reports a third of everything and never leaves the warning state for long; times repeat."""
    picker = random.Random(3)
    made, second = [], 0.0
    for i in range(4000):
        second += picker.choice([0, 1, 1, 2, 7])
        hot = picker.random() < 0.4
        match = picker.random() < (0.999 if hot else 0.6)
        made.append(("hot" if hot else f"m{picker.randrange(60)}", at(second), i, "预警" if match else "运行", 0.0))
    return spark.createDataFrame(made, SCHEMA).repartition(6).persist()


@pytest.mark.parametrize("target", [100, 400])
@pytest.mark.parametrize("hold", ["5 seconds", "60 seconds", "1 hour"])
def test_hot_machines_are_cut_into_ranges(fleet, target, hold):
    condition = F.col("status") == "预警"
    cuts = plan_ranges(fleet, "arrival_ts", target_rows=target, min_ranges=1)
    whole = plan_ranges(fleet, "arrival_ts", min_ranges=1)
    got = patterns.hold_alerts(fleet, condition, hold, ranges=cuts)
    want = patterns.hold_alerts(fleet, condition, hold, ranges=whole)
    assert cuts.count >= 10
    assert rows(got) == rows(want)
    assert want.where("machine_id = 'hot'").count() > 0


@pytest.mark.parametrize("target", [100, 400, 100_000])
def test_transitions_with_hot_machines(fleet, target):
    cuts = plan_ranges(fleet, "arrival", target_rows=target, min_ranges=1)
    got = patterns.transitions_to_running(fleet, ranges=cuts)
    want, state = [], {}
    for r in sorted(fleet.collect(), key=lambda r: r.arrival):
        before, count = state.get(r.machine_id, (None, 0))
        if before == "预警" and r.status == "运行":
            count += 1
            want.append((r.arrival, r.machine_id, before, count))
        state[r.machine_id] = (r.status, count)
    assert rows(got.select("arrival", "machine_id", "previous", "changes")) == sorted(want, key=str)


def test_a_machine_that_starts_running_has_not_changed(lines):
    found = lines([f"1,m,0000,{status},t,x,1" for status in ("运行", "待机", "运行", "运行")])
    got = patterns.transitions_to_running(decode.decode_changes(found).rows)
    assert rows(got.select("previous", "changes")) == [("待机", 1)]


def stretches_of(monkeypatch, operator, readings, hold, target):
    """(alerts, rows of each level of stretches) with keys cut into ranges of `target` rows."""
    kept, cut = [], patterns.cut_lineage
    monkeypatch.setattr(patterns, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    cuts = plan_ranges(readings, "arrival_ts", target_rows=target, min_ranges=1)
    alerts = rows(operator(readings, hold, time="arrival_ts", ranges=cuts))
    return alerts, [df.count() for df in kept if "entries" in df.columns]


def test_many_hot_machines_have_few_stretches(spark, monkeypatch):
    """Their readings lie scattered over ranges that hold those of all machines."""
    picker = random.Random(5)
    made = [(f"m{i % 50}", at(7 * i), i, picker.choice(["预警", "预警", "运行"]), 0.0) for i in range(3000)]
    readings = spark.createDataFrame(made, SCHEMA)
    got, levels = stretches_of(monkeypatch, patterns.warning_held, readings, "10 minutes", 20)
    assert len(levels) == 1 and levels[0] <= 50 + 3000 // 20
    whole = plan_ranges(readings, "arrival_ts", min_ranges=1)
    assert got == rows(patterns.warning_held(readings, "10 minutes", time="arrival_ts", ranges=whole))
    assert len(got) > 50


def test_a_hot_machine_above_the_limit_is_joined_in_a_short_tree(spark, monkeypatch):
    """Its stretches are counted by its own readings, not by those of the others."""
    picker = random.Random(6)
    made = []
    for i in range(4000):
        name = "hot" if i % 4 == 0 else f"m{i % 60}"
        made.append((name, at(i), i, "运行", 39.0 if picker.random() < 0.97 else 20.0))
    readings = spark.createDataFrame(made, SCHEMA)
    got, levels = stretches_of(monkeypatch, patterns.temperature_held, readings, "30 seconds", 40)
    assert levels[0] <= 61 + 4000 // 40 and levels[1:] and levels[1] <= 61 + levels[0] // patterns.FAN_IN
    whole = plan_ranges(readings, "arrival_ts", min_ranges=1)
    assert got == rows(patterns.temperature_held(readings, "30 seconds", ranges=whole))
    assert sum(r[0] == "hot" for r in got) > 10
