"""Sinks. Each works on one batch of rows, so that it serves batch jobs and `foreachBatch` alike.

Latest-value tables (key to value, hash field to value, row key to cells) are parquet folders with one partition per
product and batch, each holding the batch's last row per key. Writing a batch again replaces its own partition and
nothing else, so a replayed batch changes nothing, and a lost executor or driver leaves older batches untouched. The
table's content is one row per key: the last by the sink's `order`, which the table keeps in the column `_order`, and
then by batch id. So a late row that an earlier batch has overtaken stays behind it. All products of a table have an
order, or none has.

With `buckets`, such a table is merged instead (see `keyed`): each batch rewrites the hash buckets its keys fall in, and
reading costs the same after any number of batches. `read_latest` reads both kinds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import Folder, KeyedTable, read_products

# Rows per insert, and the time between two batches of a JDBC sink.
JDBC_BATCH_ROWS = "100"
JDBC_INTERVAL = "3 seconds"

# Takes the rows of a batch, the batch id, and the product's name.
Sink = Callable[[DataFrame, int, str], None]
PARTS = ["product", "batch_id"]
ORDER = "_order"
# Where a compacted table's content lies.
BASE_PRODUCT, BASE_BATCH = "compacted-base", -1
# Below it the tables of merged products lie.
MERGED = "merged"


def last_per_key(rows: DataFrame, keys: list[str], order: str | list[str], kept: tuple[str, ...] = ()) -> DataFrame:
    """The last row of each key by `order`, without the order columns but those in `kept`.

    A partial aggregate, so a hot key is reduced before the shuffle.
    """
    order = [order] if isinstance(order, str) else order
    cells = [c for c in rows.columns if c not in keys and (c in kept or c not in order)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*cells), F.struct(*order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cells])


def write_latest(rows: DataFrame, batch_id: int, product: str, path: str) -> None:
    """`rows` has one row per key."""
    rows.write.mode("overwrite").parquet(f"{path}/product={product}/batch_id={batch_id}")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    merged = read_products(spark, f"{path}/{MERGED}", keys, ORDER) if MERGED in Folder(spark, path).names() else None
    if merged is not None:
        return merged
    return _content(spark, path, keys).drop(ORDER)


def _content(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    table = spark.read.parquet(path)
    order = [ORDER] if ORDER in table.columns else []
    return last_per_key(table, keys, [*order, *PARTS[::-1]], kept=(ORDER,))


def compact_latest(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Write the table's content to a new folder, to go on from there with the next batches.

    The content becomes the base, under a product and a batch id that no batch has: a batch that is replayed after the
    compaction writes its own partition beside the base, which stays below every batch.
    """
    _content(spark, path, keys).write.parquet(f"{target}/product={BASE_PRODUCT}/batch_id={BASE_BATCH}")


def latest_sink(
    path: str, keys: list[str], order: str | list[str] | None = None, buckets: int | None = None
) -> Sink:
    """A latest-value table under any keys. Without `order`, a batch has one row per key already.

    `buckets` makes it a merged table of so many hash buckets per product.
    """
    columns = [order] if isinstance(order, str) else order

    def write(batch: DataFrame, batch_id: int, product: str) -> None:
        if columns:
            ordered = batch.withColumn(ORDER, F.struct(*columns))
            batch = last_per_key(ordered, keys, [ORDER, *columns], kept=(ORDER,))
        if buckets is None:
            write_latest(batch, batch_id, product, path)
        else:
            kept = [ORDER] if columns else None
            KeyedTable(batch.sparkSession, f"{path}/{MERGED}/{product}", keys, order=kept, buckets=buckets).merge(batch, batch_id)

    return write


def kv_set(path: str, order: str | list[str] | None = None, buckets: int | None = None) -> Sink:
    """(key, value) rows: the last value of each key. Without `order`, a batch has one row per key already."""
    return latest_sink(path, ["key"], order, buckets)


def kv_hset(path: str, order: str | list[str] | None = None, buckets: int | None = None) -> Sink:
    """(key, field, value) rows: the last value of each field of each hash."""
    return latest_sink(path, ["key", "field"], order, buckets)


def row_upsert(path: str, order: str | list[str] | None = None, buckets: int | None = None) -> Sink:
    """(row_key, text cells) rows: the last cells of each row key."""
    return latest_sink(path, ["row_key"], order, buckets)


def jdbc_options(url: str, table: str, **options: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": JDBC_BATCH_ROWS, **options}


def jdbc_append(url: str, table: str, **options: str) -> Sink:
    """Append rows of text cells to a database table; a batch that fails halfway is inserted again."""

    def write(batch: DataFrame, batch_id: int, product: str) -> None:
        text_cells(batch).write.format("jdbc").mode("append").options(**jdbc_options(url, table, **options)).save()

    return write


def text_cells(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def rows_append(path: str) -> Sink:
    """All rows of each batch, for products that are sequences; a batch that is repeated replaces its own rows."""

    def write(batch: DataFrame, batch_id: int, product: str) -> None:
        write_latest(batch, batch_id, product, path)

    return write


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that `rows_append` has written."""
    return spark.read.parquet(path).drop(*PARTS)


def console(rows: int | None = 20) -> Sink:
    """Print the first rows of each batch, or all of them (`rows=None`), which come to the driver one partition at a time."""

    def write(batch: DataFrame, batch_id: int, product: str) -> None:
        if rows is not None:
            batch.show(rows, truncate=False)
            return
        print(" | ".join(batch.columns))
        for row in batch.toLocalIterator():
            print(" | ".join(map(str, row)))

    return write
