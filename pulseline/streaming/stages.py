"""Rows that one query leaves in a folder, batch by batch, and that others read as a stream.

    <folder>/batch_id=<n>/    the rows of a batch, put there by one rename

A batch that is repeated finds its rows in place and writes nothing, so readers see every row once. Where readers are to
take one batch at a time, all batches have the same number of files, and readers take as many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from .keyed import Folder

BATCH = "batch_id"
# Holds the number of files of each batch, so that it stays over restarts.
FILES = "_files"


def files_a_batch(spark: SparkSession, folder: str, files: int) -> int:
    """The number of files that each batch in the folder has: `files` for each core that there was at first."""
    place = Folder(spark, folder)
    if FILES not in place.names():
        place.make()
        place.put(FILES, str(files * spark.sparkContext.defaultParallelism))
    return int(place.read(FILES))


def append_once(rows: DataFrame, batch_id: int, folder: str, files: int | None = None) -> None:
    """The rows of a batch, in exactly `files` files if given, unless they are there already.

    A batch that died halfway is written anew.
    """
    place, name = Folder(rows.sparkSession, folder), f"{BATCH}={batch_id}"
    if name in place.names():
        return
    draft = f"_draft-{batch_id}"  # readers pass over such a name
    spread = rows if files is None else rows.coalesce(files)
    spread.write.mode("overwrite").options(compression="zstd", maxRecordsPerFile=0).parquet(f"{folder}/{draft}")
    if files is not None:
        _fill_up(rows, place, draft, files)
    place.rename(draft, name)


def _fill_up(rows: DataFrame, place: Folder, draft: str, files: int) -> None:
    """Files without rows for the tasks that had none."""

    def parts() -> list[str]:
        return [n for n in place.names(draft) if not n.startswith(("_", "."))]

    found = parts()
    if len(found) == files:
        return
    rows.limit(0).write.mode("append").parquet(f"{place.path}/{draft}")
    (empty,) = set(parts()) - set(found)
    for i in range(len(found) + 1, files):
        place.copy(f"{draft}/{empty}", f"{draft}/part-empty-{i}.parquet")


def staged_stream(spark: SparkSession, folder: str, schema: StructType, **options: str) -> DataFrame:
    """What `append_once` has put into the folder, and will put there."""
    Folder(spark, folder).make()
    # The folder may be empty still, so Spark is told of the batch that is in the rows' paths.
    whole = StructType([*schema.fields, StructField(BATCH, IntegerType())])
    return spark.readStream.schema(whole).options(**options).parquet(folder).select(*schema.names)
