"""Cutting a long ordered sequence into ranges, so that no task holds more than one range of it.

A running value over all rows, or over one key that holds a large share of them, cannot be one window partition.
Its rows are cut into ranges of the order column with about equal row counts; the ranges are worked on in parallel
and each gets a carry from the ranges before it. The cuts are plain numbers that are computed once, so every pass
over the rows agrees on them. Their number is bounded; beyond it, what lies between two cuts is divided evenly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compute_once
from ..session import cut_lineage

TARGET_ROWS = 4_000_000
SAMPLE_PER_RANGE = 200
# Cuts that the driver finds in a sample and that every task gets.
MAX_CUTS = 4_096
# Keys that every task gets; more of them are joined through a shuffle.
MAX_SENT_KEYS = 50_000
RANGE = "_range"


@dataclass(frozen=True)
class Ranges:
    """Cut points of an order column; a range holds about `target_rows` rows of the frame they were made from.

    The rows between two cuts are `parts` ranges of the same width. The first of them begins at `low`, the last one
    ends at `high`; what lies outside belongs to the nearest range.
    """

    rows: int
    target_rows: int
    cuts: list[float] = field(default_factory=list)
    parts: int = 1
    low: float = 0.0
    high: float = 0.0

    @property
    def count(self) -> int:
        return (len(self.cuts) + 1) * self.parts


def order_number(df: DataFrame, order: str) -> Column:
    """The order column as a number; times count in microseconds."""
    number = F.unix_micros(order) if dict(df.dtypes)[order] == "timestamp" else F.col(order)
    return number.cast("double")


def plan_ranges(df: DataFrame, order: str, *, target_rows: int = TARGET_ROWS, min_ranges: int | None = None) -> Ranges:
    """Cut points for `order`, from a row count and a sample of that one column.

    The number of ranges grows with the rows, so a range stays as small at any size. The sample only places the cuts:
    SAMPLE_PER_RANGE rows for each of them. More than MAX_CUTS ranges are even parts between fewer cuts, so what the
    driver holds is bounded; a range may hold more than `target_rows` then where the rows are uneven, but no more than
    lie between two cuts.
    `min_ranges` defaults to the cores of the session.
    """
    number = df.select(order_number(df, order).alias("n"))
    rows = number.count()
    wanted = max(min_ranges or df.sparkSession.sparkContext.defaultParallelism, -(-rows // target_rows))
    wanted = min(wanted, max(rows, 1))
    if wanted <= 1:
        return Ranges(rows, target_rows)
    parts = -(-wanted // MAX_CUTS)
    between = -(-wanted // parts)
    fraction = min(1.0, SAMPLE_PER_RANGE * between / rows)
    sample = number if fraction == 1.0 else number.sample(fraction, seed=1)
    probabilities = [i / between for i in range(1, between)]
    cuts = sorted(set(sample.approxQuantile("n", probabilities, 1 / (10 * between))))
    if parts == 1 or not cuts:
        return Ranges(rows, target_rows, cuts)
    low, high = number.agg(F.min("n"), F.max("n")).first()
    return Ranges(rows, target_rows, cuts, parts, low, high)


def with_range(df: DataFrame, order: str, ranges: Ranges, name: str = RANGE) -> DataFrame:
    """Adds the number of the row's range; ranges follow the order, and equal order values share one."""
    if not ranges.cuts:
        return df.withColumn(name, F.lit(0))
    cut = Bucketizer(
        splits=[float("-inf"), *ranges.cuts, float("inf")], inputCol="_number", outputCol=name, handleInvalid="keep"
    )
    tagged = cut.transform(df.withColumn("_number", order_number(df, order))).withColumn(name, F.col(name).cast("int"))
    if ranges.parts == 1:
        return tagged.drop("_number")
    edges = [ranges.low, *ranges.cuts, ranges.high]
    between = [(i, a, ranges.parts / (b - a) if b > a else 0.0) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    places = df.sparkSession.createDataFrame(between, f"`{name}` int, _begin double, _parts double")
    part = F.floor((F.col("_number") - F.col("_begin")) * F.col("_parts"))
    inside = F.coalesce(F.least(F.greatest(part, F.lit(0)), F.lit(ranges.parts - 1)), F.lit(0))
    placed = tagged.join(F.broadcast(places), name, "left")
    return placed.withColumn(name, (F.col(name) * ranges.parts + inside).cast("int")).select(*df.columns, name)


def shuffled_once(df: DataFrame, *keys: str) -> DataFrame:
    """`df` shuffled by `keys`, for plans that use it twice.

    Both uses need the same columns of the shuffle (the generator keeps the optimizer from pruning them for one of
    them), so Spark runs it once and reads its output twice. Aggregates, windows and joins on the keys need no other
    shuffle.
    """
    return compute_once(df.repartition(*keys), keys, {c: f"`{c}`" for c in df.columns if c not in keys})


def hot_keys(df: DataFrame, key: str, ranges: Ranges) -> DataFrame | None:
    """Keys with more than `target_rows` rows, or None.

    There are at most rows / target_rows of them, one in four million rows. They stay in the shared folder; up to
    MAX_SENT_KEYS are marked to be broadcast.
    """
    if ranges.rows <= ranges.target_rows:
        return None
    counts = df.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > ranges.target_rows)
    hot = cut_lineage(counts.select(key))
    found = hot.count()
    if not found:
        return None
    return F.broadcast(hot) if found <= MAX_SENT_KEYS else hot


def split_hot(df: DataFrame, key: str, order: str, ranges: Ranges) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with their range); the second is None when no key is hot."""
    hot = hot_keys(df, key, ranges)
    if hot is None:
        return df, None
    cold_rows = df.join(hot, key, "left_anti")
    hot_rows = df.join(hot, key, "left_semi")
    return cold_rows, with_range(hot_rows, order, ranges)
