"""Keyed tables that batches are merged into: hash buckets, versioned folders, and a pointer to what is current.

    <table>/versions/<version>/rows/_bucket=<b>/    rows of a bucket, one per key
    <table>/versions/<version>/top_<name>/          the k largest rows of each of the version's buckets
    <table>/pointers/<version>                      which version holds each bucket, and the last batch

A batch rewrites the buckets its keys fall in, as a new version, and then puts a new pointer in place, which is one
rename. Until then the table is what it was, so a batch that dies halfway leaves folders that nothing points to and is
done again. A batch id that the pointer has seen changes nothing. Reading takes one row per key as it stands, however
many batches there were.

The last pointers stay, so a reader may go on with what it has opened for KEPT further batches, and a batch that is
repeated after its merge finds the content from before it. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET, BATCH = "_bucket", "_batch"
BUCKETS = 64
KEPT = 3


class Folder:
    """Files of a folder in whatever store Spark's own file system reaches; used on the driver for small files only."""

    def __init__(self, spark: SparkSession, path: str):
        self.java = spark._jvm
        self.path = path.rstrip("/")
        self.system = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.java.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        place = self._at(name)
        if not self.system.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(place))

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(name))
        try:
            return self.java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, content: str) -> None:
        """A whole file at once: written under another name and renamed."""
        draft = f"{name}-{uuid.uuid4().hex}.tmp"
        stream = self.system.create(self._at(draft))
        try:
            stream.write(content.encode())
        finally:
            stream.close()
        self.rename(draft, name)

    def make(self) -> None:
        self.system.mkdirs(self._at(""))

    def rename(self, name: str, to: str) -> None:
        if not self.system.rename(self._at(name), self._at(to)):
            raise FileExistsError(f"{self.path}/{to}")

    def copy(self, name: str, to: str) -> None:
        self.java.org.apache.hadoop.fs.FileUtil.copy(
            self.system, self._at(name), self.system, self._at(to), False, self.system.getConf()
        )

    def remove(self, name: str = "") -> None:
        self.system.delete(self._at(name), True)


@dataclass(frozen=True)
class Pointer:
    """The table as it stands after a batch: the version that holds each bucket."""

    version: int
    batch: int
    schema: str
    buckets: dict[int, str]

    @classmethod
    def parse(cls, content: str) -> Pointer:
        found = json.loads(content)
        return cls(**found | {"buckets": {int(b): v for b, v in found["buckets"].items()}})


class KeyedTable:
    """`tops` names rankings the table keeps: name to (column, k), largest first, ties by key."""

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], *, order: list[str] | None = None,
        buckets: int = BUCKETS, tops: dict[str, tuple[str, int]] | None = None,
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.order, self.buckets, self.tops = order or [], buckets, tops or {}
        self.folder = Folder(spark, path)

    # What is current.

    def pointer(self, before: int | None = None) -> Pointer | None:
        """The newest pointer; with `before`, the newest one of an earlier batch."""
        for name in reversed([n for n in self.folder.names("pointers") if n.isdigit()]):
            found = Pointer.parse(self.folder.read(f"pointers/{name}"))
            if before is None or found.batch < before:
                return found
        return None

    def content(self, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """One row per key, with the batch it is from; None if there has been no batch yet. `only` names buckets."""
        return self._rows(self.pointer(before), only)

    def _rows(self, at: Pointer | None, only: list[int] | None = None) -> DataFrame | None:
        if at is None:
            return None
        wanted = at.buckets if only is None else {b: at.buckets[b] for b in only if b in at.buckets}
        return self._read(wanted, "rows", StructType.fromJson(json.loads(at.schema)))

    def _read(self, wanted: dict[int, str], part: str, schema: StructType) -> DataFrame:
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/versions/{version}/{part}/{BUCKET}={b}" for b, version in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def top(self, name: str) -> DataFrame | None:
        """The k largest rows of the table: of k rows of each bucket, the k largest."""
        at = self.pointer()
        if at is None:
            return None
        column, k = self.tops[name]
        rows = self._read(at.buckets, f"top_{name}", StructType.fromJson(json.loads(at.schema)))
        return rows.orderBy(F.desc(column), *self.keys).limit(k)

    # Merging.

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that these rows fall in: a few numbers, at most as many as the table has buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def merge(self, rows: DataFrame, batch: int) -> bool:
        """Put `rows` in place, the last row of each key by `order` and batch; False if the batch has been merged."""
        now = self.pointer()
        if now is not None and batch <= now.batch:
            return False
        fresh = rows.withColumn(BATCH, F.lit(batch).cast("bigint")).persist()
        try:
            touched = self.touched(fresh)
            version = f"{(now.version if now else 0) + 1:012d}-{uuid.uuid4().hex}"
            if touched:
                old = self._rows(now, touched)
                self._write(fresh if old is None else old.unionByName(fresh), touched, version)
        finally:
            fresh.unpersist()
        buckets = (now.buckets if now else {}) | dict.fromkeys(touched, version)
        made = Pointer(now.version + 1 if now else 1, batch, fresh.schema.json(), buckets)
        self.folder.put(f"pointers/{made.version:012d}", json.dumps(asdict(made)))
        self._clean()
        return True

    def _write(self, rows: DataFrame, touched: list[int], version: str) -> None:
        cells = [c for c in rows.columns if c not in self.keys]
        # Reduced within each task, then one shuffle by bucket, which also serves the last reduction.
        placed = rows.withColumn(BUCKET, self.bucket()).repartition(len(touched), BUCKET)
        last = F.max_by(F.struct(*cells), F.struct(*self.order, BATCH)).alias("_last")
        merged = placed.groupBy(BUCKET, *self.keys).agg(last).select(BUCKET, *self.keys, "_last.*")
        merged.select(BUCKET, *rows.columns).write.partitionBy(BUCKET).parquet(f"{self.path}/versions/{version}/rows")
        for name, (column, k) in self.tops.items():
            written = self.spark.read.parquet(f"{self.path}/versions/{version}/rows")
            best = Window.partitionBy(BUCKET).orderBy(F.desc(column), *self.keys)
            ranked = written.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).drop("_rank")
            ranked.write.partitionBy(BUCKET).parquet(f"{self.path}/versions/{version}/top_{name}")

    def _clean(self) -> None:
        """Remove old pointers, and the buckets and versions that only they have named or that nothing names."""
        names = [n for n in self.folder.names("pointers") if n.isdigit()]
        kept = [Pointer.parse(self.folder.read(f"pointers/{n}")) for n in names[-KEPT:]]
        named = {(b, v) for p in kept for b, v in p.buckets.items()}
        parts = ["rows", *[f"top_{name}" for name in self.tops]]
        for name in names[:-KEPT]:
            old = Pointer.parse(self.folder.read(f"pointers/{name}"))
            for b, v in old.buckets.items():
                if (b, v) not in named:
                    for part in parts:
                        self.folder.remove(f"versions/{v}/{part}/{BUCKET}={b}")
            self.folder.remove(f"pointers/{name}")
        used = {v for _, v in named}
        for version in self.folder.names("versions"):
            if version not in used and int(version.split("-")[0]) <= kept[-1].version:
                self.folder.remove(f"versions/{version}")


def read_products(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame | None:
    """The content of all products' tables under `path`, the last row per key by `order` (if kept), batch and product."""
    products = Folder(spark, path).names()
    found = [(p, KeyedTable(spark, f"{path}/{p}", keys).content()) for p in products]
    frames = [rows.withColumn("_product", F.lit(p)) for p, rows in found if rows is not None]
    if not frames:
        return None
    rows = reduce(DataFrame.unionByName, frames)
    columns = [c for c in rows.columns if c not in (BATCH, "_product", order)]
    if len(frames) == 1:  # one row per key as it is
        return rows.select(*columns)
    rank = F.struct(*[c for c in (order, BATCH, "_product") if c in rows.columns])
    cells = [c for c in columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*cells), rank).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cells])
