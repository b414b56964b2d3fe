"""Exact top-k search by inner product over descending norms.

Vectors become integers, floor(scale * x). All vectors are rotated onto the principal axes of the whole table (the
eigenvectors of its second-moment matrix, which are the right singular vectors), so the leading coordinates carry most
of every product. Rows are cut into blocks by descending length. A block meets a block of queries in one task and is
worked through piece by piece: products of the leading coordinates, plus the product of the residual lengths
(Cauchy-Schwarz), bound a score from above, and only pairs whose bound reaches the query's tenth best score so far get
their exact integer product. A piece whose longest vector cannot reach it for any query ends the block.

The queries are a stated set and meet the rows in blocks; what is kept per query and block is k rows. The block of the
longest vectors comes first; its k-th best scores tell for each query which blocks are too short to matter, and those
are never sent to meet it.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without
an id; shorter vectors count as padded with zeros. Repeated rows each count as candidates; a query that is repeated
with the same vector is asked once, and different vectors of one id are queries of their own, each with its list. A
query's own row (the same id) is no candidate. Ties go to the smaller id. Scores are exact whole numbers; those beyond
64 bits become the ends of that range, as do components beyond 64 bits. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import numbered

#: Rows of a data block and of a query block: what one task holds of either side.
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
#: Rows worked through at once inside a block.
PIECE_ROWS = 1_024
#: Share of the squared lengths that the leading coordinates should hold.
LEADING_SHARE = 0.6
#: More than what rounding adds to a bound, as a share of the product of the lengths.
SLACK = 1e-9
#: Below it, sums of products are exact in doubles.
EXACT = 2.0**53
#: Ends of the scores; one below the least stands for no score.
LEAST, MOST = -(2**63) + 1, 2**63 - 1
BEST = "query long, query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """key, `v` (integers as doubles) and `norm`, for the rows whose vector is whole and finite."""
    exact = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = (
        (F.size(vector) > 0)
        & ~F.exists(exact, lambda x: x.isNull())
        & ~F.exists(exact, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    )
    scaled = F.transform(exact, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    picked = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & whole)
    return picked.select(F.col(key).cast("long").alias("id"), scaled.alias("v")).withColumn("norm", norm)


def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The partition's sum of outer products, as one row."""
    total = np.zeros((0, 0))
    for batch in batches:
        if len(batch):
            m = matrix(batch["v"])
            total = padded(total, m.shape[1])
            total[: m.shape[1], : m.shape[1]] += m.T @ m
    if total.size:
        yield pd.DataFrame({"row": range(len(total)), "sums": list(total)})


def padded(square: np.ndarray, width: int) -> np.ndarray:
    grow = max(0, width - len(square))
    return np.pad(square, ((0, grow), (0, grow)))


def matrix(vectors: pd.Series, width: int = 0) -> np.ndarray:
    """The vectors as rows; shorter ones are padded with zeros."""
    width = max([width, *(len(v) for v in vectors)])
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def rotation(vectors: DataFrame) -> tuple[np.ndarray, int]:
    """Principal axes as columns, strongest first, and how many of them lead; one small matrix reaches the driver."""
    sums: dict[int, np.ndarray] = {}
    parts = vectors.select("v").mapInPandas(moments, "row int, sums array<double>")
    width = parts.agg(F.max(F.size("sums"))).first()[0]
    if not width:
        return np.zeros((0, 0)), 0
    totals = parts.select("row", F.posexplode("sums").alias("col", "x")).groupBy("row", "col").agg(F.sum("x").alias("x"))
    square = np.zeros((width, width))
    for row, col, x in totals.collect():
        square[row, col] = x
    values, axes = np.linalg.eigh(square)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(axes), int(min(width, np.searchsorted(share, LEADING_SHARE) + 1))


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int, axes: np.ndarray, lead: int) -> pd.DataFrame:
    """The k best candidates of one data block for each query of one query block."""
    if not len(queries) or not len(rows):
        return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
    rows = rows.sort_values(["norm", "id"], ascending=[False, True], kind="stable")
    width = len(axes)
    q, x = matrix(queries["v"], width), matrix(rows["v"], width)
    small = np.abs(q).max() * np.abs(x).max() * width < EXACT
    qid, xid = queries["id"].to_numpy(), rows["id"].to_numpy()
    qr, xr = q @ axes, x @ axes
    q_rest = np.sqrt((qr[:, lead:] ** 2).sum(axis=1))
    x_rest = np.sqrt((xr[:, lead:] ** 2).sum(axis=1))
    q_norm, x_norm = queries["norm"].to_numpy(), rows["norm"].to_numpy()
    slack = SLACK * (1 + q_norm * x_norm[0])  # what rounding can add to a bound
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    scores = np.full((len(q), k), LEAST - 1)
    floor = queries["floor"].to_numpy(dtype=float)
    for at in range(0, len(x), PIECE_ROWS):
        piece = slice(at, at + PIECE_ROWS)
        least = np.maximum(scores[:, -1].astype(float), floor)
        least[least <= float(LEAST)] = -np.inf  # no score yet, or one that was cut off there
        open_ = np.flatnonzero(q_norm * x_norm[at] + slack >= least)
        if not len(open_):
            break
        bound = qr[open_, :lead] @ xr[piece, :lead].T + np.outer(q_rest[open_], x_rest[piece])
        near = bound + slack[open_, None] >= least[open_, None]
        near &= qid[open_, None] != xid[None, piece]
        for i in np.flatnonzero(near.any(axis=1)):
            own, who = open_[i], at + np.flatnonzero(near[i])
            products = (x[who] @ q[own]).astype(np.int64) if small else whole_products(x[who], q[own])
            all_scores = np.concatenate([scores[own], products])
            all_ids = np.concatenate([ids[own], xid[who]])
            first = np.lexsort((all_ids, ~all_scores))[:k]
            scores[own], ids[own] = all_scores[first], all_ids[first]
    found = scores >= LEAST
    asked = np.repeat(np.arange(len(q)), found.sum(axis=1))
    return pd.DataFrame({
        "query": queries["query"].to_numpy()[asked], "query_id": qid[asked], "vec_id": ids[found], "score": scores[found],
    })


def whole_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of any size in whole numbers, cut off at the ends of 64 bits."""
    whole = [int(v) for v in query]
    products = [sum(int(v) * w for v, w in zip(row, whole)) for row in rows]
    return np.array([min(max(p, LEAST), MOST) for p in products], dtype=np.int64)


def top_inner_products(
    df: DataFrame, is_query: str, k: int, *, key: str = "vec_id", vector: str = "embedding", scale: int = 1024
) -> DataFrame:
    """Each query's k best rows: query_id, rank, vec_id, score. `is_query` is a SQL condition on `id`."""
    vectors = cut_lineage(integer_vectors(df, key, vector, scale))
    axes, lead = rotation(vectors)
    placed = numbered(vectors, [F.desc("norm"), F.col("id"), F.col("v")], {"_place": F.lit(1)})
    rows = placed.select("id", "v", "norm", F.floor(F.col("_place") / BLOCK_ROWS).alias("block"))
    asked = placed.where(is_query).select("id", "v", "norm").dropDuplicates(["id", "v"])
    asked = numbered(asked, [F.col("id"), F.col("v")], {"query": F.lit(1)}).select("query", "id", "v", "norm")
    asked = cut_lineage(asked)
    blocks = cut_lineage(rows.groupBy("block").agg(F.max("norm").alias("norm")))

    def meet(queries: DataFrame, data: DataFrame) -> DataFrame:
        def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            return best_in_block(queries, rows, k, axes, lead)

        by = ["query_block", "block"]
        queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # both sides come from one table
        return queries.groupBy(*by).cogroup(data.groupBy(*by)).applyInPandas(best, BEST)

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # The longest vectors first: their k-th best score is a floor for all other blocks.
    first_asked = asked.select(
        "*", F.floor(F.col("query") / QUERY_ROWS).alias("query_block"), F.lit(0).cast("long").alias("block"),
        F.lit(float("-inf")).alias("floor"),
    )
    last = first_asked.agg(F.max("query_block")).first()[0] or 0
    everyone = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("query_block")
    first = cut_lineage(meet(first_asked, rows.where("block = 0").select("*", everyone)))
    if blocks.count() <= 1:
        return _shaped(ranked(first))
    floors = ranked(first).where(F.col("rank") == k).groupBy("query").agg(F.max("score").cast("double").alias("floor"))
    asked = asked.join(floors, "query", "left").fillna(float("-inf"), ["floor"])
    asked, needed = reached(asked, blocks)
    others = meet(
        asked.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("until"))).alias("block")),
        rows.join(needed, "block").select(*rows.columns, F.explode(F.sequence(F.lit(0).cast("long"), "up_to")).alias("query_block")),
    )
    return _shaped(ranked(first.unionByName(others)))


def reached(asked: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The queries that need more blocks than the first, in new query blocks, and the query blocks per block.

    A query needs the blocks whose longest vector times its own length reaches its floor; with blocks by descending
    length these are the blocks 1 to `until`. Queries are put into blocks by descending `until`, so a block of rows is
    needed by the query blocks 0 to `up_to`. Lengths of blocks and queries are counted along one sorted list; no block
    meets a query for it.
    """
    # The block's bound is norm * (length + slack) + slack; the least length for it, taken a little too short.
    needs = (F.col("floor") - 2 * SLACK) / (F.col("norm") * (1 + 2 * SLACK))
    needs = F.when(F.col("norm") * F.col("floor") > 0, needs).otherwise(float("-inf"))
    needs = F.when((F.col("norm") == 0) & (F.col("floor") > 0), float("inf")).otherwise(needs) * (1 - 2 * SLACK)
    marks = blocks.select(F.lit(None).cast("long").alias("query"), "norm", F.lit(0).alias("kind")).unionByName(
        asked.select("query", needs.alias("norm"), F.lit(1).alias("kind"))
    )
    order = [F.desc("norm"), F.col("kind"), F.col("query")]
    counted = numbered(marks, order, {"longer": (F.col("kind") == 0).cast("long")}).where("kind = 1")
    until = counted.select("query", (F.col("longer") - 1).alias("until")).where("until >= 1")
    asked = numbered(asked.join(until, "query"), [F.desc("until"), F.col("query")], {"_at": F.lit(1)})
    asked = cut_lineage(asked.select(
        "query", "id", "v", "norm", "floor", "until", F.floor(F.col("_at") / QUERY_ROWS).alias("query_block")
    ))
    ends = asked.groupBy("query_block").agg(F.max("until").alias("until"))
    pairs = ends.select("query_block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("until"))).alias("block"))
    return asked, pairs.groupBy("block").agg(F.max("query_block").alias("up_to"))


def _shaped(ranked: DataFrame) -> DataFrame:
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
