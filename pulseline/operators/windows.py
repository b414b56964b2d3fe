"""Counts per machine in time windows. Windows align to the epoch in UTC."""

from __future__ import annotations

from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text
from .routing import flagged_warnings, passed_products, warnings


def window_counts(
    df: DataFrame, size: str, slide: str | None = None, *, time: str = "arrival_ts", count: Column | None = None
) -> DataFrame:
    """(machine_id, window_start, window_end, cnt); `count` is a count aggregate, by default of all rows.

    Counts are added up before the shuffle, so a machine that holds most rows costs no more than any other.
    """
    window = F.window(time, size, slide) if slide else F.window(time, size)
    counts = df.groupBy(window.alias("w"), "machine_id").agg((count if count is not None else F.count("*")).alias("cnt"))
    return counts.select(
        "machine_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt"
    )


def pane_counts(df: DataFrame, size: str, slide: str, *, time: str) -> DataFrame:
    """(pane, machine_id, cnt) in the largest windows that neighbouring sliding windows either share whole or not at all."""
    micros = [pd.Timedelta(length) // pd.Timedelta(microseconds=1) for length in (size, slide)]
    pane = F.window(time, f"{gcd(*micros)} microseconds")
    return df.groupBy(pane.alias("pane"), "machine_id").agg(F.count("*").alias("cnt"))


def produce_count_filtered(produce: DataFrame, size: str = "5 minutes", *, time: str = "arrival_ts") -> DataFrame:
    """Passed products per machine and window; a window without any gives no row."""
    return window_counts(passed_products(produce), size, time=time)


def produce_count_conditional(produce: DataFrame, size: str = "5 minutes", *, time: str = "arrival_ts") -> DataFrame:
    """Passed products per machine and window; a machine with failed products only gives 0."""
    return window_counts(produce, size, time=time, count=F.count_if(F.col("passed") == codes.PASSED))


def produce_latest_window(counts: DataFrame) -> DataFrame:
    """The count of each machine's latest window, as a (key, field, value) row."""
    latest = counts.groupBy("machine_id").agg(F.max_by("cnt", "window_end").alias("cnt"))
    return latest.select(
        F.lit(codes.HASH_PRODUCED).alias("key"),
        F.col("machine_id").alias("field"),
        F.col("cnt").cast("string").alias("value"),
    )


def produce_rowkey(counts: DataFrame) -> DataFrame:
    """(row_key, machine_id, total_produce) text cells; the row key is `machine-window end`."""
    end = text.time_text(F.col("window_end"), codes.TIME_FORMAT_MILLIS)
    return counts.select(
        F.concat_ws("-", "machine_id", end).alias("row_key"),
        "machine_id",
        F.col("cnt").cast("string").alias("total_produce"),
    )


def warning_count_tumbling(changes: DataFrame, size: str = "3 minutes", *, time: str = "arrival_ts") -> DataFrame:
    """Flagged warnings per machine and window, with the window's end as text."""
    counts = window_counts(flagged_warnings(changes), size, time=time)
    return counts.select("machine_id", "cnt", text.time_text(F.col("window_end")).alias("window_end_text"), "window_end")


def warning_top_sliding(
    changes: DataFrame, size: str = "3 minutes", slide: str = "1 minute", *, time: str = "arrival_ts"
) -> DataFrame:
    """The machine with most warnings per sliding window; ties go to the smaller machine id.

    Three grouped aggregates, all with partial sums; a stream can chain them in append mode. Rows are counted once,
    per pane; a window's count is the sum of its panes.
    """
    panes = pane_counts(warnings(changes), size, slide, time=time)
    window = F.window(F.window_time("pane"), size, slide)
    counts = panes.groupBy(window.alias("w"), "machine_id").agg(F.sum("cnt").alias("cnt"))
    best = counts.groupBy("w").agg(F.min(F.struct((-F.col("cnt")).alias("rank"), "machine_id")).alias("best"))
    return best.select(
        F.col("w.end").alias("window_end"),
        F.col("best.machine_id").alias("machine_id"),
        (-F.col("best.rank")).alias("cnt"),
    )


def warning_top_values(top: DataFrame) -> DataFrame:
    """(key, field, value) rows: window end to machine."""
    return top.select(
        F.lit(codes.HASH_TOP_WARNING).alias("key"),
        text.time_text(F.col("window_end")).alias("field"),
        F.col("machine_id").alias("value"),
    )
