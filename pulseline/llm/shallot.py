"""Exact centroid clustering by Shallot search.

Every vector remembers its centroid, its second nearest one, an upper bound of the distance to the first and a lower
bound of the distances to all others. Centroids that move loosen the bounds by what they moved. A vector whose bounds
still part the two, or whose upper bound is below half the way from its centroid to the nearest other one, keeps its
centroid without another look. For the others the exact distances to the two remembered centroids are taken, the
search starts from the closer one, and visits that centroid's neighbours in ascending order of their distance to it. Only
centroids within (distance to the start) + (second best distance) of the start can be nearest or second nearest, and
this ball shrinks whenever the scan finds a closer one. Bounds are floating-point numbers widened by more than their
error; the centroids that are left are compared by squared distances in whole numbers, ties to the smaller number.

A round is one pass over the remembered state, vectors included, which is checkpointed, and a sum per centroid and
component: partial sums per task, then one row per centroid. Only the centroids reach the driver.

Defined results: vectors of another length, null vectors, and those with a null, non-finite or larger than 64-bit
component take no part. Repeated rows are clustered each. A vector without an id is clustered, and starts a centroid only
when vectors with ids are too few. With fewer vectors than centroids there are as many centroids as vectors. An empty
table gives an empty result. Extra columns are not read. A distance or inertia that is no 64-bit number is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Squared distances of components up to this size fit 64 bits for some thousand components; others take Python numbers.
SAFE = 1 << 24
#: More than the relative error of a distance in floating-point numbers, and of a sum of a few of them.
SLACK = 1e-9
LONGEST = 2**63 - 1
STATE = "vec_id long, vector binary, cluster int, second int, upper double, lower double"
SUMS = "cluster int, n long, sums array<decimal(38,0)>"


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a and b, as whole numbers."""
    d = a - b
    return (d * d).sum(axis=-1)


def roots(values: np.ndarray) -> np.ndarray:
    return np.sqrt(values.astype(np.float64))


class Centroids(NamedTuple):
    """Centroids with what the search needs: the others by distance, how far each is, and how far each has moved."""

    place: np.ndarray
    near: np.ndarray
    far: np.ndarray
    moved: np.ndarray

    @classmethod
    def of(cls, place: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        between = np.stack([roots(squares(place, p)) for p in place])
        np.fill_diagonal(between, -1.0)  # each comes first among its own neighbours
        near = np.argsort(between, axis=1, kind="stable").astype(np.int32)
        far = np.take_along_axis(between, near, axis=1)
        far[:, 0] = 0.0
        moved = np.zeros(len(place)) if before is None else roots(squares(place, before))
        return cls(place, near, far, moved)


def closer(d_a, a, d_b, b):
    """Whether centroid a at squared distance d_a comes before b at d_b."""
    return (d_a < d_b) | ((d_a == d_b) & (a < b))


def search(x: np.ndarray, first: np.ndarray, second: np.ndarray, c: Centroids):
    """(nearest, its squared distance, second nearest, its squared distance) of each vector; `first` and `second`
    are two different centroids to begin with."""
    d1, d2 = squares(x, c.place[first]), squares(x, c.place[second])
    swap = closer(d2, second, d1, first)
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, reach = first.copy(), roots(d1)
    known = second.copy()
    active = np.arange(len(x))
    for rank in range(1, len(c.place)):
        ball = (reach[active] + roots(d2[active])) * (1 + SLACK) + SLACK
        active = active[c.far[start[active], rank] <= ball]
        if not len(active):
            break
        other = c.near[start[active], rank]
        fresh = other != known[active]
        at, other = active[fresh], other[fresh]
        if not len(at):
            continue
        d = squares(x[at], c.place[other])
        best = closer(d, other, d1[at], first[at])
        better = ~best & closer(d, other, d2[at], second[at])
        won = at[best]
        second[won], d2[won] = first[won], d1[won]
        first[won], d1[won] = other[best], d[best]
        second[at[better]], d2[at[better]] = other[better], d[better]
    return first, d1, second, d2


def narrow(vector: np.ndarray) -> bytes:
    """A vector's bytes in the narrowest of 16, 32 or 64 bits."""
    top = max(abs(int(vector.min())), abs(int(vector.max())))
    return vector.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8").tobytes()


def unpacked(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch; as Python numbers if their squares could pass 64 bits."""
    held = vectors.to_pylist()
    sizes = np.array([len(v) for v in held], np.int64)
    out = np.empty((len(held), width), np.int64)
    for size in (2, 4, 8):
        at = np.flatnonzero(sizes == size * width)
        if len(at):
            out[at] = np.frombuffer(b"".join(held[i] for i in at), f"<i{size}").reshape(-1, width)
    return out if not out.size or np.abs(out).max() <= SAFE and out.min() > -SAFE else out.astype(object)


def kept_vectors(vectors: DataFrame, key: str, column: str, width: int, scale: int) -> DataFrame:
    """(vec_id, v): whole-number vectors of the rows that take part."""
    scaled = F.transform(F.col(column), lambda x: F.lit(scale) * x.cast("double"))
    size = float(2**63)
    whole = F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (x >= -size) & (x < size))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.when(F.size(column) == width, scaled).alias("s"))
    return rows.where(F.col("s").isNotNull() & whole).select("vec_id", F.transform("s", lambda x: F.floor(x)).alias("v"))


def first_centroids(kept: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of `seed:id`; `count` rows at most."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(order.alias("hash"), "v").orderBy(F.col("hash").asc_nulls_last(), "v").limit(count).collect()
    return np.array([r["v"] for r in rows], object)


def with_type(place: np.ndarray) -> np.ndarray:
    """Centroids as 64-bit numbers where their distances are safe in them."""
    safe = all(-SAFE < x <= SAFE for x in place.ravel())
    return place.astype(np.int64) if safe else place


def settled(state: DataFrame, centroids: Centroids, width: int) -> DataFrame:
    """The state of every vector after a look at the moved centroids. The first time `cluster` is null."""
    held = state.sparkSession.sparkContext.broadcast(centroids)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Centroids = held.value
        single = len(c.place) == 1
        half = c.far[:, 1] / 2 if not single else None
        # Of all other centroids the one that has moved most loosens a lower bound.
        order = np.argsort(-c.moved)
        for batch in batches:
            x = unpacked(batch.column("vector"), width)
            n = len(x)
            place = c.place if x.dtype == object or c.place.dtype == object else c.place.astype(np.int64)
            if place.dtype == object:
                x = x.astype(object)
            if single:
                first, second, upper, lower = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
            else:
                if batch.column("cluster").null_count:
                    first, second = np.zeros(n, np.int32), np.ones(n, np.int32)
                    upper, lower = np.full(n, np.inf), np.zeros(n)
                else:
                    first, second, upper, lower = (
                        batch.column(i).to_numpy(zero_copy_only=False).copy()
                        for i in ("cluster", "second", "upper", "lower")
                    )
                    upper = (upper + c.moved[first]) * (1 + SLACK)
                    most = np.where(first == order[0], c.moved[order[1]], c.moved[order[0]])
                    lower = (lower - most) * (1 - SLACK) - SLACK * most
                bound = np.maximum(lower, half[first] * (1 - SLACK))
                at = np.flatnonzero(upper >= bound)
                upper[at] = roots(squares(x[at], c.place[first[at]])) * (1 + SLACK)
                at = at[upper[at] >= bound[at]]
                a, d1, b, d2 = search(x[at], first[at], second[at], c)
                first[at], second[at] = a, b
                upper[at], lower[at] = roots(d1) * (1 + SLACK), roots(d2) * (1 - SLACK)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("vector"), pa.array(first.astype(np.int32)),
                    pa.array(second.astype(np.int32)), pa.array(upper), pa.array(lower),
                ],
                ["vec_id", "vector", "cluster", "second", "upper", "lower"],
            )

    return state.mapInArrow(step, STATE)


def cluster_sums(state: DataFrame, count: int, width: int) -> DataFrame:
    """(cluster, dim, n, total): one partial row per task and centroid, summed up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, width), object)
        sizes = np.zeros(count, np.int64)
        for batch in batches:
            x, own = unpacked(batch.column("vector"), width), batch.column("cluster").to_numpy()
            for j in np.unique(own):
                rows = x[own == j]
                # A batch of 64-bit numbers within SAFE cannot pass 64 bits in a sum.
                sums[j] += rows.sum(axis=0).astype(object)
                sizes[j] += len(rows)
        used = np.flatnonzero(sizes)
        if len(used):
            cells = [[int(v) for v in sums[j]] for j in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(sizes[used]), pa.array(cells, pa.list_(pa.decimal128(38, 0)))],
                ["cluster", "n", "sums"],
            )

    rows = state.select("vector", "cluster").mapInArrow(partial, SUMS)
    each = rows.select("cluster", "n", F.posexplode("sums").alias("dim", "value"))
    # Room for 38 digits stays: the sum of some billions of partial sums is far from it.
    return each.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("value").cast("string").alias("total"))


def distances(state: DataFrame, centroids: Centroids, width: int) -> DataFrame:
    """vec_id, cluster, and the squared distance as text, since it may be larger than a long."""
    held = state.sparkSession.sparkContext.broadcast(centroids)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = held.value.place
        for batch in batches:
            x, own = unpacked(batch.column("vector"), width), batch.column("cluster")
            d = squares(x.astype(object) if place.dtype == object else x, place[own.to_numpy()])
            exact = pa.array([int(v) if v < 10**38 else None for v in d.tolist()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), own, exact], ["vec_id", "cluster", "exact"])

    return state.select("vec_id", "vector", "cluster").mapInArrow(step, "vec_id long, cluster int, exact decimal(38,0)")


def next_place(place: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Every non-empty centroid at the floor of its mean; one row per centroid and component comes to the driver."""
    moved = place.astype(object)
    for row in sums.collect():
        moved[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return moved


def clustered(
    vectors: DataFrame, count: int, rounds: int, *, width: int, scale: int, seed: int = 1, key: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    kept = kept_vectors(vectors, key, column, width, scale)
    place = first_centroids(kept, count, seed)
    if not len(place):
        none = kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(n) for n in
                           ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
        return none.where("false")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, own = batch.num_rows, batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            empty = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.float64())]
            packed = pa.array([narrow(v) for v in own], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), packed, *empty], ["vec_id", "vector", "cluster", "second", "upper", "lower"]
            )

    centroids = Centroids.of(with_type(place))
    state = kept.mapInArrow(pack, STATE)
    for _ in range(rounds):
        state = cut_lineage(settled(state, centroids, width))
        moved = next_place(centroids.place, cluster_sums(state, len(place), width))
        centroids = Centroids.of(with_type(moved), centroids.place)
    found = cut_lineage(distances(settled(state, centroids, width), centroids, width))

    sums = dict(found.groupBy("cluster").agg(F.sum("exact")).collect())
    total = sum(sums.values())
    rows = []
    for i, p in enumerate(centroids.place):
        name = hashlib.sha256(",".join(str(int(v)) for v in p).encode()).hexdigest()
        rows.append((i, *[int(v) if v is not None and v <= LONGEST else None for v in (sums.get(i), total)], name))
    shape = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per centroid: a proven size.
    small = F.broadcast(vectors.sparkSession.createDataFrame(rows, shape))
    distance = F.when(F.col("exact") <= F.lit(LONGEST), F.col("exact")).cast("long").alias("distance")
    return found.join(small, "cluster").select(
        "vec_id", "cluster", distance, "cluster_inertia", "inertia", "centroid_sha256"
    )
