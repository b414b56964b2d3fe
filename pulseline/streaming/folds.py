"""Figures and running values that go on over the batches of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.kpis import kpi_values, order_kpis
from ..operators.ranges import Ranges
from ..operators.running import running_sums
from .keyed import KeyedTable

ADDED = ("sales_total", "refund_total", "sales", "refund_requests", "orders", "cancels")


def add_kpis(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row of figures followed by another; a figure missing in one row is taken from the other.

    The cancel rate stays at the last cancellation: its denominator is all orders up to there.
    """
    rows = old.withColumn("part", F.lit(0)).unionByName(new.withColumn("part", F.lit(1)))
    first = F.max(F.when(F.col("part") == 0, F.col("orders")))
    at_new = F.max(F.when(F.col("part") == 1, F.col("orders_at_cancel")))
    at_old = F.max(F.when(F.col("part") == 0, F.col("orders_at_cancel")))
    types = dict(old.dtypes)
    return rows.agg(
        *[F.sum(name).cast(types[name]).alias(name) for name in ADDED],
        F.coalesce(first + at_new, at_old).alias("orders_at_cancel"),
    )


def fold_kpis(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
    """(key, value) rows after this batch.

    Each batch is summed up in parallel to one row, added to the row of the batch before, and kept under its batch
    id, so a repeated batch starts from the same row again.
    """
    spark = batch.sparkSession
    figures = order_kpis(batch)
    if batch_id > 0:
        figures = add_kpis(spark.read.parquet(f"{folder}/batch_id={batch_id - 1}"), figures)
    place = f"{folder}/batch_id={batch_id}"
    figures.write.mode("overwrite").parquet(place)
    return kpi_values(spark.read.parquet(place))


class RunningSums:
    """`running_sums` for one batch of a stream: the sums inside the batch, on top of those of the batches before.

    Over all rows, what a batch adds is one row of totals; those up to here are kept under the batch's id. Per key, the
    totals are a keyed table: a batch reads and rewrites the buckets of its own keys only. Both leave what a batch
    started from, so a repeated batch gives the same rows and totals again. Rows count in the order of the batches, and
    within a batch in that of `order`.
    """

    def __init__(self, batch_id: int, folder: str):
        self.batch_id, self.folder = batch_id, folder

    def __call__(
        self, df: DataFrame, order: str, increments: dict[str, Column], *, key: str | None = None, ranges: Ranges | None = None
    ) -> DataFrame:
        sums = running_sums(df, order, increments, key=key, ranges=ranges)
        added = [F.sum(c).alias(name) for name, c in increments.items()]
        if key is None:
            return self._all_rows(sums, df.agg(*added), list(increments))
        return self._per_key(sums, df.groupBy(key).agg(*added), list(increments), key)

    def _all_rows(self, sums: DataFrame, added: DataFrame, names: list[str]) -> DataFrame:
        spark = sums.sparkSession
        types = dict(added.dtypes)
        before = added.limit(0)
        if self.batch_id > 0:
            before = spark.read.parquet(f"{self.folder}/batch_id={self.batch_id - 1}")
        totals = before.unionByName(added).agg(*[F.sum(n).cast(types[n]).alias(n) for n in names])
        totals.write.mode("overwrite").parquet(f"{self.folder}/batch_id={self.batch_id}")
        start = before.agg(*[F.sum(n).alias(n) for n in names]).first()  # one row of totals
        zero = {n: F.lit(start[n]) if start[n] is not None else F.lit(0) for n in names}
        return sums.withColumns({n: (F.col(n) + zero[n]).cast(dict(sums.dtypes)[n]) for n in names})

    def _per_key(self, sums: DataFrame, added: DataFrame, names: list[str], key: str) -> DataFrame:
        table = KeyedTable(sums.sparkSession, self.folder, [key])
        known = table.content(before=self.batch_id, only=table.touched(added))
        if known is None:
            table.merge(added, self.batch_id)
            return sums
        types = dict(added.dtypes)
        before = known.select(key, *[F.col(n).alias(f"_{n}") for n in names])

        def onto(frame: DataFrame) -> DataFrame:
            joined = frame.join(before, key, "left")
            more = {n: (F.col(n) + F.coalesce(f"_{n}", F.lit(0))).cast(dict(frame.dtypes)[n]) for n in names}
            return joined.withColumns(more).drop(*[f"_{n}" for n in names])

        table.merge(onto(added).select(key, *[F.col(n).cast(types[n]) for n in names]), self.batch_id)
        return onto(sums)


class Ranking:
    """Sums per key of a stream in update mode, with the largest ones at hand.

    A batch holds the keys it has changed, with their sums up to here; they go into a keyed table, which keeps the k
    largest of each bucket. A decreasing sum is no special case, since the buckets hold all keys.
    """

    def __init__(self, folder: str, keys: list[str], tops: dict[str, int]):
        self.folder, self.keys, self.tops = folder, keys, tops

    def top(self, batch: DataFrame, batch_id: int, column: str) -> DataFrame:
        """(keys, value): the k largest by `column` after this batch."""
        tops = {name: (name, k) for name, k in self.tops.items()}
        table = KeyedTable(batch.sparkSession, self.folder, self.keys, tops=tops)
        table.merge(batch, batch_id)
        return table.top(column).select(*self.keys, F.col(column).alias("value"))
