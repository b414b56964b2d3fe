"""Token ids in binary files whose blocks are turned into bit or byte planes before compression.

A file holds documents in the order of their ids:

    "IDPLANE1"                                  8 bytes
    blocks                                      zstandard frames, one per plane, one block after the other
    index                                       one zstandard frame of little-endian 64-bit numbers, see below
    place of the index, its length, its crc32   three 64-bit numbers
    "IDPLANE1"                                  8 bytes

A block is a fixed number of values (the last one of its kind may have fewer): token ids (32 bits, kind 0), or document
ids, document lengths and null marks (64 bits, kind 1 to 3). Its values are transposed, so that plane j has bit j
(or byte j) of every value; planes of high bits are almost constant and vanish. The index has a row per block: kind,
place in the file, number of values, crc32 of the values, bits of a plane (1 or 8), and the length of each plane's
frame. With it any range of ids is read by itself.

A data set is a folder of such files and a Parquet table `manifest` with one row per file: its number in document order,
name, ids and documents. Only files it names count, so a file that a lost or repeated task has left is never read.

Files are written and read by the executors through `pyarrow.fs`, so the folder has to be one that it can open.

Defined results: a null or empty text has the end id alone. Rows without a document id come first, with a null id.
Rows of one id are ordered by a hash of their text; each is a document of its own. An empty table gives a manifest
without rows. Extra columns are not read. A long text is coded in blocks; reading it needs one block at a time.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches
from .word_ids import WordIds

MAGIC = b"IDPLANE1"
BLOCK_VALUES = 1 << 16
TOKENS, DOC_IDS, LENGTHS, NULLS = range(4)
TYPES = {TOKENS: np.dtype("<u4"), DOC_IDS: np.dtype("<i8"), LENGTHS: np.dtype("<i8"), NULLS: np.dtype("<i8")}
LEVEL = 3
MANIFEST = "part long, name string, ids long, documents long"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def planes(values: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block, lowest first; `bits` of each value (1 or 8) go to one plane."""
    width = values.dtype.itemsize
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width)
    if bits == 8:
        return [row.tobytes() for row in np.ascontiguousarray(rows.T)]
    each = np.unpackbits(rows, axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(np.ascontiguousarray(each.T), axis=1, bitorder="little")]


def unplaned(parts: list[bytes], count: int, kind: np.dtype, bits: int) -> np.ndarray:
    """The values whose planes these are."""
    rows = np.stack([np.frombuffer(p, np.uint8) for p in parts])
    if bits == 1:
        each = np.unpackbits(rows, axis=1, count=count, bitorder="little")
        rows = np.packbits(np.ascontiguousarray(each.T), axis=1, bitorder="little")
    else:
        rows = rows.T
    return np.ascontiguousarray(rows).reshape(-1).view(kind)


class PlaneWriter:
    """Writes one file to an open stream."""

    def __init__(self, stream, bits: int = 8, block: int = BLOCK_VALUES):
        self.stream, self.bits, self.block = stream, bits, block
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.held: dict[int, list[np.ndarray]] = {kind: [] for kind in TYPES}
        self.waiting = dict.fromkeys(TYPES, 0)
        self.index: list[int] = []
        self.place = 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.place += len(data)

    def add(self, kind: int, values: np.ndarray) -> None:
        """More values of a kind; every full block is written at once."""
        self.held[kind].append(values.astype(TYPES[kind], copy=False))
        self.waiting[kind] += len(values)
        if self.waiting[kind] >= self.block:
            joined = np.concatenate(self.held[kind])
            full = len(joined) - len(joined) % self.block
            for first in range(0, full, self.block):
                self._block(kind, joined[first : first + self.block])
            self.held[kind], self.waiting[kind] = [joined[full:].copy()], len(joined) - full

    def _block(self, kind: int, values: np.ndarray) -> None:
        frames = [self.packer.compress(p) for p in planes(values, self.bits)]
        self.index += [kind, self.place, len(values), zlib.crc32(values.tobytes()), self.bits, len(frames)]
        self.index += map(len, frames)
        self._write(b"".join(frames))

    def close(self) -> None:
        """Writes what is left, the index and the end of the file."""
        for kind, held in self.held.items():
            if self.waiting[kind]:
                self._block(kind, np.concatenate(held))
        index = self.packer.compress(np.array(self.index, "<i8").tobytes())
        self._write(index + np.array([self.place, len(index), zlib.crc32(index)], "<i8").tobytes() + MAGIC)


class PlaneReader:
    """Reads one file from a seekable stream; `index` has (place, values, crc32, bits, plane lengths) per kind."""

    def __init__(self, stream, size: int):
        self.stream = stream
        self.unpacker = zstandard.ZstdDecompressor()
        tail = self._read(size - 32, 32)
        place, length, check = np.frombuffer(tail[:24], "<i8").tolist()
        packed = self._read(place, length)
        if tail[24:] != MAGIC or zlib.crc32(packed) != check:
            raise ValueError("not a whole file of id planes")
        numbers = np.frombuffer(self.unpacker.decompress(packed), "<i8").tolist()
        self.index: dict[int, list[tuple]] = {kind: [] for kind in TYPES}
        at = 0
        while at < len(numbers):
            kind, place, count, crc, bits, frames = numbers[at : at + 6]
            self.index[kind].append((place, count, crc, bits, numbers[at + 6 : at + 6 + frames]))
            at += 6 + frames

    def _read(self, place: int, length: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(length)

    def block(self, kind: int, number: int) -> np.ndarray:
        place, count, crc, bits, lengths = self.index[kind][number]
        data = self._read(place, sum(lengths))
        cuts = np.cumsum([0, *lengths]).tolist()
        parts = [self.unpacker.decompress(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        values = unplaned(parts, count, TYPES[kind], bits)
        if zlib.crc32(values.tobytes()) != crc:
            raise ValueError(f"block {number} of kind {kind} is damaged")
        return values

    def blocks(self, kind: int) -> Iterator[np.ndarray]:
        return (self.block(kind, i) for i in range(len(self.index[kind])))

    def ids(self, first: int, last: int) -> np.ndarray:
        """Token ids number `first` to `last - 1` of the file; only the blocks that hold them are read."""
        ends = np.cumsum([count for _, count, *_ in self.index[TOKENS]])
        out, at = [np.zeros(0, TYPES[TOKENS])], int(np.searchsorted(ends, first, side="right"))
        while at < len(ends) and (begin := int(ends[at]) - self.index[TOKENS][at][1]) < last:
            out.append(self.block(TOKENS, at)[max(first - begin, 0) : last - begin])
            at += 1
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(document id, number of ids, crc32 of the ids) in order; one block of ids is held at a time."""
        tokens, left = self.blocks(TOKENS), np.zeros(0, TYPES[TOKENS])
        for ids, lengths, nulls in zip(self.blocks(DOC_IDS), self.blocks(LENGTHS), self.blocks(NULLS)):
            for doc_id, length, null in zip(ids.tolist(), lengths.tolist(), nulls.tolist()):
                crc, missing = 0, length
                while missing:
                    if not len(left):
                        left = next(tokens)
                    crc = zlib.crc32(left[:missing].tobytes(), crc)
                    taken = min(missing, len(left))
                    left, missing = left[taken:], missing - taken
                yield (None if null else doc_id), length, crc


def store(folder: str):
    """(file system, path) of a folder, given as a path or a URI."""
    from pyarrow import fs

    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def write_ids(
    documents: DataFrame, folder: str, tokenizer_path: str, end_id: int, *, key: str = "doc_id", text: str = "text",
    bits: int = 8, block: int = BLOCK_VALUES,
) -> None:
    """Encodes `text`, appends `end_id` to each document, and writes files in ascending order of `key`.

    Texts are shuffled once by ranges of the key, which are as many as the session's shuffle partitions, and encoded
    behind the shuffle; each range is one file. A hash of the text and the row's number cut a key that many rows share.
    """
    spark = bound_batches(documents.sparkSession)
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    held = spark.sparkContext.broadcast(WordIds(tokenizer_path))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, total, count = None, 0, 0
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.planes"
        system, path = store(folder)
        stream = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                stream = system.open_output_stream(f"{path}/{name}", compression=None)
                writer = PlaneWriter(stream, bits, block)
            ids, cuts = held.value.of(batch.column(1))
            # The end id goes behind each document's last id.
            closed = np.insert(ids, cuts[1:], np.uint32(end_id))
            keys = batch.column(0)
            writer.add(TOKENS, closed)
            writer.add(DOC_IDS, keys.fill_null(0).to_numpy(zero_copy_only=False))
            writer.add(LENGTHS, np.diff(cuts) + 1)
            writer.add(NULLS, keys.is_null().to_numpy(zero_copy_only=False))
            total, count = total + len(closed), count + batch.num_rows
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "name": name, "ids": total, "documents": count}],
                pa.schema([("part", pa.int64()), ("name", pa.string()), ("ids", pa.int64()), ("documents", pa.int64())]),
            )

    system, path = store(folder)
    system.create_dir(path, recursive=True)
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from the files."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file, which are as many as the shuffle partitions they were written with.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("name", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(folder)
        names = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{path}/{name}") as stream:
                    made: list[tuple] = []
                    for doc_id, length, crc in PlaneReader(stream, stream.size()).documents():
                        made.append((doc_id, start, length, crc))
                        start += length
                        if len(made) == BLOCK_VALUES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], schema=names)
                            made = []
                    if made:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], schema=names)

    dealt = files.repartition(max(1, manifest.count()))
    return dealt.mapInArrow(read, DIGEST)
