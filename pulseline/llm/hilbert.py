"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised by its own quantiles, strings by the ranks of whole values (both order-preserving, over all
rows), the cells are visited in the order
of a Hilbert curve, and the visiting order is cut into runs of near-equal bytes. A shard is then a compact region in
every dimension, so minimum and maximum values per file prune well for filters on any of them.

Defined results: null text has no bytes and crc32 0; a null dimension value sorts before all others; rows that agree
in everything are told apart arbitrarily but each gets its own slot; an empty table gives an empty result. Only the
named columns are read, so extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered

BITS = 8
SIZE_OVERHEAD = 16


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of `cells` (n rows, one column per dimension, values below 2**bits).

    The axes-to-transpose transform works on all rows at once: from the highest bit down, a set bit of a dimension
    inverts the lower bits of the first one, a clear bit swaps them; a Gray decode and interleaving the bits follow.
    """
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            has = (x[i] & q) != 0
            swap = np.where(has, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(has, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    gray = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        gray = np.where((x[n - 1] & q) != 0, gray ^ (q - one), gray)
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << one) | (((x[i] ^ gray) >> np.uint64(b)) & one)
    return index.astype(np.int64)


def order_number(column: str) -> Column:
    """An order-preserving number for a column that is no string."""
    return F.coalesce(F.col(column).cast("double"), F.lit(float("-inf")))


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def text_cuts(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """The smallest whole value of each level of a string column, levels by the values' ranks among all rows.

    Rows are counted per value first, so a value that many rows share is one row of the ranking, and has one level. At
    most 2**bits - 1 values reach the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranked = numbered(counts, [F.col("value")], {"before": F.col("n")})
    total = ranked.agg(F.sum("n")).first()[0] or 1
    level = F.floor(F.col("before") * (2**bits - 1) / F.lit(total)).alias("level")
    firsts = ranked.groupBy(level).agg(F.min("value").alias("value")).collect()
    return np.array(sorted(r["value"] for r in firsts), dtype=object)


def text_level(values: pd.Series, cuts: np.ndarray) -> np.ndarray:
    """Null is level 0, below all values. Code points compare as UTF-8 bytes do."""
    levels = np.zeros(len(values), np.int64)
    there = values.notna().to_numpy()
    codes, distinct = pd.factorize(values[there])
    if len(distinct):
        levels[there] = np.searchsorted(cuts, np.asarray(distinct, dtype=object), side="right")[codes]
    return levels


def with_curve_index(df: DataFrame, dimensions: list[str], name: str, bits: int = BITS) -> DataFrame:
    """Adds the Hilbert index of `dimensions`, quantised to 2**bits levels each by quantiles or ranks over all rows."""
    texts = {c: text_cuts(df, c, bits) for c in dict.fromkeys(dimensions) if is_text(df, c)}
    numbers = [c for c in dict.fromkeys(dimensions) if c not in texts]
    levels = [i / 2**bits for i in range(1, 2**bits)]
    cuts = texts
    if numbers:
        found = df.agg(*[F.percentile_approx(order_number(c), levels, 10_000).alias(f"q{i}") for i, c in enumerate(numbers)]).first()
        # One sorted array of at most 2**bits - 1 cuts per dimension.
        cuts = texts | {c: np.unique(np.asarray(q if q is not None else [], dtype=float)) for c, q in zip(numbers, found)}

    def indexed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            cells = [
                text_level(s, cuts[c]) if c in texts else np.searchsorted(cuts[c], s.to_numpy(), side="right")
                for c, s in zip(dimensions, columns if isinstance(columns, tuple) else (columns,))
            ]
            yield pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    indexed.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    inputs = [F.col(c) if c in texts else order_number(c) for c in dimensions]
    return df.withColumn(name, F.pandas_udf(indexed, "long")(*inputs))


def hilbert_shards(
    documents: DataFrame, shards: int, dimensions: list[str], *, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per input row: key, size, text_crc32, curve, shard, slot (gapless from 0 in each shard).

    The run of a shard ends where the bytes before a row's middle pass the shard's share, so shards differ by at most
    one row's bytes from their share. The text itself is only read for its size and checksum and never shuffled.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + SIZE_OVERHEAD
    crc = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long")
    slim = documents.select(
        *dict.fromkeys([key, *dimensions]), size.alias("_size"), crc.alias("_crc")
    )
    curved = with_curve_index(slim, dimensions, "_curve").select(key, "_size", "_crc", "_curve")
    order = [F.col("_curve"), F.col(key), F.col("_crc"), F.col("_size")]
    placed = numbered(curved, order, {"_bytes": F.col("_size"), "_row": F.lit(1)})
    total = placed.agg(F.sum("_size")).first()[0] or 1
    middle = F.col("_bytes") + F.col("_size") / 2
    shard = F.least(F.floor(middle * shards / F.lit(total)), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("_shard", shard)
    # One row per shard.
    first = F.broadcast(placed.groupBy("_shard").agg(F.min("_row").alias("_first")))
    return placed.join(first, "_shard").select(
        F.col(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_curve").alias("curve"),
        F.col("_shard").alias("shard"), (F.col("_row") - F.col("_first")).cast("long").alias("slot"),
    )
