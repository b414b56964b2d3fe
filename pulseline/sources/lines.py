"""Raw line sources. Every source gives the same three columns.

value       the line
arrival     a unique whole number that grows in arrival order: BIGINT, or DECIMAL(38) where three parts make it up
arrival_ts  when the line arrived
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ..streaming.keyed import Folder
from ..streaming.stages import BATCH, append_once, staged_stream

# Digits of a Kafka record's place in its topic: of the offset, and of the partition above it. The time in milliseconds
# stands above both, with up to 14 digits, so the whole fits a DECIMAL(38).
OFFSET_DIGITS, PARTITION_DIGITS = 19, 5

# The place of a line in a text file counts in bytes, below this bit; the number of the file stands above it.
FILE_BITS = 40
FILE_NAME, FILE_TIME = "_metadata.file_path AS _file", "_metadata.file_modification_time AS _time"
FILE_BLOCK = "_metadata.file_block_start AS _block"
LINE = StructType().add("value", "string").add("arrival", "long").add("arrival_ts", "timestamp")
FILE = StructType().add("_file", "string").add("_time", "timestamp").add("_number", "long").add(BATCH, "integer")
FILE_ORDERS = {"time": ["_time", "_file"], "path": ["_file"]}


def read_kafka(
    spark: SparkSession,
    topic: str,
    brokers: str,
    *,
    start: str = "latest",
    stream: bool = True,
    group: str | None = None,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Lines of a topic, from the latest or the earliest offset, as a stream or as a bounded read."""
    reader = spark.readStream if stream else spark.read
    settings = kafka_options(topic, brokers, start=start, stream=stream, group=group, max_per_trigger=max_per_trigger)
    return kafka_lines(reader.format("kafka").options(**settings, **options).load())


def kafka_options(
    topic: str, brokers: str, *, start: str, stream: bool, group: str | None = None, max_per_trigger: int | None = None
) -> dict[str, str]:
    if not stream and start == "latest":
        raise ValueError("a bounded read starts at 'earliest' or at named offsets")
    settings = {"subscribe": topic, "kafka.bootstrap.servers": brokers, "startingOffsets": start}
    if group:
        # A prefix: the queries of a job read the topic each for itself, not as members of one group.
        settings["groupIdPrefix"] = group
    if max_per_trigger:
        settings["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return settings


def kafka_lines(records: DataFrame) -> DataFrame:
    """Value-only text of Kafka records.

    Lines arrive in the order of (time, partition, offset), whatever each partition holds. The time is the record's
    timestamp: of the broker on topics with `message.timestamp.type=LogAppendTime`, else of the producer. The three
    are digits of one number, so operators sort, compare and cut it into ranges like any other.
    """
    time = F.unix_millis("timestamp").cast("decimal(14,0)")
    place = F.col("partition").cast("decimal(10,0)") * power_of_ten(OFFSET_DIGITS) + F.col("offset").cast("decimal(19,0)")
    arrival = time * power_of_ten(OFFSET_DIGITS + PARTITION_DIGITS) + place
    return records.select(
        F.col("value").cast("string").alias("value"),
        arrival.cast("decimal(38,0)").alias("arrival"),
        F.col("timestamp").cast("timestamp").alias("arrival_ts"),
    )


def power_of_ten(digits: int) -> Column:
    return F.lit("1" + "0" * digits).cast(f"decimal({digits + 1},0)")


def read_files(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    schema: StructType | str | None = None,
    value: str | Column = "value",
    arrival: str | Column | None = "arrival",
    arrival_ts: str | Column | None = "arrival_ts",
    stream: bool = False,
    files_by: str = "time",
    ledger: str | None = None,
    **options,
) -> DataFrame:
    """Captured lines from files, as a stream or as a batch.

    `value`, `arrival` and `arrival_ts` name (or compute) the columns. Plain text files hold the line only: there
    the arrival time is the file's modification time, and lines arrive file by file, in the order of the files' time
    (`files_by="time"`) or of their paths alone (`"path"`). A stream of text files keeps the files' numbers in the folder
    `ledger` (see `text_stream`, which takes `trigger` and `max_files` too).
    """
    if format == "text":
        if stream:
            if ledger is None:
                raise ValueError("a stream of text files keeps its arrival order in a folder; name it with ledger=")
            return text_stream(spark, path, ledger, files_by=files_by, **options)
        return text_lines(spark, path, files_by, options)
    reader = (spark.readStream if stream else spark.read).format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(path)
    number = _column(arrival)
    wide = isinstance(raw.select(number).schema[0].dataType, DecimalType)  # captured from a topic
    return raw.select(
        _column(value).cast("string").alias("value"),
        number.cast("decimal(38,0)" if wide else "bigint").alias("arrival"),
        _column(arrival_ts).cast("timestamp").alias("arrival_ts"),
    )


def text_lines(spark: SparkSession, path: str, files_by: str, options: dict[str, str]) -> DataFrame:
    """Lines of text files: `arrival` is made of the file's number and of the line's place in the file.

    A file's blocks are numbered by themselves, so a large file is never one task. A line takes at least one byte, so
    a block's start plus the line's number in it is a place that no other block reaches; files that are compressed and
    yet cut into blocks (bzip2) are not supported. Only one row per file meets in one task.
    """
    files = spark.read.format("binaryFile").options(**options).load(path).selectExpr(FILE_NAME, FILE_TIME)
    lines = spark.read.format("text").options(**options).load(path).selectExpr("value", FILE_NAME, FILE_BLOCK)
    return numbered_lines(lines, numbered_files(files, files_by))


def numbered_files(files: DataFrame, files_by: str, first: int = 0) -> DataFrame:
    """(_file, _time, _number): files by their order, from `first` on. One row per file meets in one task."""
    number = F.row_number().over(Window.orderBy(*FILE_ORDERS[files_by])) - 1 + F.lit(first)
    return files.select("_file", "_time", number.cast("bigint").alias("_number"))


def numbered_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Lines (value, _file, _block) as they are read, with the arrival that their file's number and their place give."""
    read = lines.select("value", "_file", "_block", F.monotonically_increasing_id().alias("_id"))
    in_block = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_id"))
    # The first block may hold one line more than bytes: one that begins where the next block does.
    place = F.col("_block") + in_block - F.when(F.col("_block") == 0, 1).otherwise(0)
    placed = read.select("value", "_file", place.alias("_place"))
    return placed.join(files, "_file").select(
        "value",
        (F.shiftleft("_number", FILE_BITS) + F.col("_place")).alias("arrival"),
        F.col("_time").cast("timestamp").alias("arrival_ts"),
    )


def text_stream(
    spark: SparkSession, path: str, ledger: str, *, files_by: str = "time", trigger: dict | None = None,
    max_files: int | None = None, **options: str,
) -> DataFrame:
    """Lines of text files as a stream, with arrival numbers that stay over restarts.

    A query of its own follows the folder. It gives the files of a micro-batch the next numbers, in their order, writes
    these to `<ledger>/files` and the numbered lines to `<ledger>/lines`, both once per batch; the stream returned
    reads those lines. So a file's number never changes, a restarted query goes on where it was, and any number of
    streams may read the same ledger. A file arrives in the batch that finds it, also if its time is older than that
    of files before. With `trigger={"availableNow": True}` all files there are have been numbered on return; else the
    query goes on and is found under its name, the ledger's path, in `spark.streams.active`.
    """
    files, lines = f"{ledger}/files", f"{ledger}/lines"
    source = spark.readStream.format("text").options(**options)
    if max_files:
        source = source.option("maxFilesPerTrigger", str(max_files))
    found = source.load(path).selectExpr("value", FILE_NAME, FILE_TIME, FILE_BLOCK)

    def number(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = session.read.schema(FILE).parquet(files)
        if not known.where(F.col(BATCH) == batch_id).limit(1).count():
            top = known.agg(F.max("_number")).scalar()
            first = session.range(1).select((F.coalesce(top, F.lit(-1)) + 1).alias("n")).first()["n"]
            append_once(numbered_files(batch.select("_file", "_time").distinct(), files_by, first), batch_id, files)
        own = session.read.schema(FILE).parquet(files).where(F.col(BATCH) == batch_id).drop(BATCH)
        append_once(numbered_lines(batch, own), batch_id, lines)

    running = [query for query in spark.streams.active if query.name == ledger]
    if not running:
        Folder(spark, files).make()
        writer = found.writeStream.foreachBatch(number).queryName(ledger)
        query = writer.option("checkpointLocation", f"{ledger}/checkpoint").trigger(
            **(trigger or {"processingTime": "3 seconds"})
        ).start()
        if trigger and "availableNow" in trigger:
            query.awaitTermination()
    return staged_stream(spark, lines, LINE)


def _column(c: str | Column | None) -> Column:
    if c is None:
        return F.lit(None)
    return F.col(c) if isinstance(c, str) else c


def read_lines(spark: SparkSession, source: str, **options) -> DataFrame:
    """`source="kafka"` or a file format name."""
    if source == "kafka":
        return read_kafka(spark, **options)
    return read_files(spark, format=source, **options)
