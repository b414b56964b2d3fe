"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


class Recent(dict):
    """Results per key, made by `make` when first asked for, at most twice `limit` of them.

    When `limit` are held they become the old ones, and the old ones before them are forgotten; an old one that is
    asked for again is taken over. What is often asked for stays, and results do not depend on any of it.
    """

    limit = 200_000

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
        self[key] = made
        return made


#: Bytes of one Arrow batch of texts, as a worker holds it (the longest text alone may be more).
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> SparkSession:
    """Cap the bytes, not only the rows, of the batches that Python workers get; a cap set by the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def unused_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores appended until no column of `df` has that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that fill a partition of a small table between jobs, and how many partitions it keeps in any case.
FULL, FEW = 20_000, 8


def partitions_of(rows: int) -> int:
    return max(FEW, -(-rows // FULL))


def settled(df: DataFrame) -> DataFrame:
    """`df` checkpointed, and read in no more partitions than its rows fill.

    Every task of a shuffle writes files however little it has, so jobs on small tables pay for partitions, not rows.
    Adaptive execution merges small partitions only inside one job and only where the session lets it. Rows are counted
    while they are written; the count decides on nothing but partitions.
    """
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return out.coalesce(partitions_of(seen.get["rows"]))


def label_examples(
    documents: DataFrame, labels: DataFrame, label: str, learn_from: Column, limit: int, *columns: str
) -> DataFrame:
    """At most `limit` labelled rows, `limit // 2` of each class, with `doc_id`, `_label` and the given columns.

    `learn_from` is a condition on `doc_id` that keeps held-out rows away. The rows are those with the smallest hashes
    of doc_id, so the choice is the same however the tables are partitioned. `limit` bounds what a fit reads; labels
    that are null or contradict each other for one doc_id are left out.
    """
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn_from)
        .groupBy("doc_id")
        .agg(F.min(label).alias("_label"), F.max(label).alias("_other"))
        .where("_label = _other")
        .select("doc_id", "_label", F.xxhash64("doc_id").alias("_order"))
    )
    halves = [
        one.where(F.col("_label") == value).orderBy("_order", "doc_id").limit(limit // 2).drop("_order")
        for value in (0, 1)
    ]
    # At most `limit` rows of two numbers: a proven size.
    picked = F.broadcast(cut_lineage(halves[0].unionByName(halves[1])))
    return documents.join(picked, "doc_id").select("doc_id", "_label", *columns)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def numbered(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds running sums over all rows in the given total order, each without the row itself (0 for the first).

    Rows are range-partitioned by the order once and checkpointed, so the cut points stay what they are; each
    partition is summed up, and only one row per partition meets in one task. `_part` is left in the result.
    """
    part = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    part = cut_lineage(part)
    totals = part.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, a number the session sets.
    carry = F.broadcast(totals.select("_part", *[F.sum(n).over(before).alias(f"_before_{n}") for n in sums]))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return part.join(carry, "_part").select(
        *part.columns,
        *[
            (F.coalesce(F.sum(c).over(inside), zero) + F.coalesce(F.col(f"_before_{n}"), zero)).alias(n)
            for n, c in sums.items()
        ],
    )


def evaluated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`df` with new columns that are evaluated once per row.

    The optimizer copies a plain projection into every later expression that uses it, but not a generator.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
