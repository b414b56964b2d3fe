"""Packing token sequences into windows by multiway differencing (Karmarkar-Karp).

A document's ids are cut into full windows and a rest, and the rest into near-equal pieces of at most `PIECE`, so that
many pieces make up a window. Pieces are dealt into groups of bounded size by a hash; in a group, partial partitions
into k windows are merged, always the two with the largest imbalance, fullest against emptiest, until one is left. If
a window of it is over capacity, k rises and the group is done again. A full window is its own partition.

Only the pieces' numbers are shuffled: texts are tokenised where they are read, and a piece carries the checksum of its
ids.

Defined results: a null or empty text is the closing id alone. Repeated rows are packed each. Rows without an id are
packed with a null id. An empty table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bound_batches
from .word_ids import WordIds

WINDOW = 2048
PIECE = 512
#: Pieces of a group: what one Python call holds, and the work of one merge stays small.
GROUP_PIECES = 400
CLOSING_ID = 1
NUMBERS = ["start", "length", "ids_crc32", "doc_tokens"]
PLACED = "row long, sequence_id long, offset long"


def pieces_of(ids: np.ndarray, window: int = WINDOW, most: int = PIECE) -> list[tuple[int, int, int, int]]:
    """(start, length, crc32 of the ids, ids of the document): full windows, then the rest in near-equal pieces."""
    total = len(ids)
    starts = list(range(0, total - total % window + 1, window))
    rest = total % window
    parts = -(-rest // most)
    cuts = starts + [starts[-1] + rest * (i + 1) // parts for i in range(parts)]
    return [(a, b - a, zlib.crc32(ids[a:b]), total) for a, b in zip(cuts, cuts[1:])]


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Indices per window: multiway differencing into exactly `windows` (some may be empty).

    A partial partition is its non-empty windows by descending sum, as (sum, members); members are nested pairs. The
    windows it does not fill have sum 0. Of two partitions the fullest windows of one meet the emptiest of the other.
    """
    order = count()
    heap = [(-n, next(order), 0, [(n, i)]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, base_a, a = heapq.heappop(heap)
        _, _, base_b, b = heapq.heappop(heap)
        free = windows - len(a)
        # Window j of a (descending) meets window windows-1-j of b, so only the last of both lists overlap.
        overlap = max(0, len(b) - free)
        joined = a[: len(a) - overlap]
        for j in range(overlap):
            at = len(a) - overlap + j
            other = b[windows - 1 - at]
            joined.append((a[at][0] + other[0], (a[at][1], other[1])))
        joined += b[: len(b) - overlap]
        joined.sort(key=lambda w: -w[0])
        base = base_a + base_b
        if len(joined) == windows:  # sums count from the emptiest window on
            low = joined[-1][0]
            joined = [(s - low, m) for s, m in joined]
            base += low
        heapq.heappush(heap, (-joined[0][0], next(order), base, joined))
    return [members(m) for _, m in heap[0][3]] if heap else []


def members(tree) -> list[int]:
    out, left = [], [tree]
    while left:
        node = left.pop()
        if isinstance(node, tuple):
            left.extend(node)
        else:
            out.append(node)
    return sorted(out)


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices per window, none over capacity; the number of windows rises whenever one would be."""
    full = [[i] for i, n in enumerate(lengths) if n >= capacity]
    rest = [i for i, n in enumerate(lengths) if n < capacity]
    windows = -(-sum(lengths[i] for i in rest) // capacity)
    while rest:
        made = difference([lengths[i] for i in rest], windows)
        made = [[rest[i] for i in w] for w in made]
        if max(sum(lengths[i] for i in w) for w in made) <= capacity:
            return full + [w for w in made if w]
        windows += 1
    return full


def packed_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Places of one group's pieces."""
    rows = rows.sort_values("row", kind="stable")
    lengths, numbers = rows["length"].tolist(), rows["row"].to_numpy()
    base = int(rows["group"].iloc[0]) << 32
    out = []
    for at, window in enumerate(pack(lengths, WINDOW)):
        offset = 0
        for i in window:
            out.append((numbers[i], base + at, offset))
            offset += lengths[i]
    return pd.DataFrame(out, columns=["row", "sequence_id", "offset"])


def cut_pieces(documents: DataFrame, tokenizer_path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens. Each text is read and tokenised once, in one pass.

    The tokenizer file is read on each executor from the library's own folder.
    """
    held = bound_batches(documents.sparkSession).sparkContext.broadcast(WordIds(tokenizer_path))
    rows = documents.select(key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closing = np.uint32(CLOSING_ID)
        for batch in batches:
            ids, ends = held.value.of(batch.column(1))
            closed = np.insert(ids, ends[1:], closing).astype("<u4", copy=False)
            ends = ends + np.arange(len(ends))
            made = [pieces_of(closed[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            numbers = np.array([p for own in made for p in own], np.int64).reshape(-1, len(NUMBERS))
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(made)), [len(own) for own in made])))
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, numbers.T)], [key, *NUMBERS])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in NUMBERS))


def packed(documents: DataFrame, tokenizer_path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = cut_pieces(documents, tokenizer_path, key=key, text=text)
    pieces = cut_lineage(pieces.withColumn("row", F.monotonically_increasing_id()))  # row numbers stay what they are
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")
    places = pieces.select("row", "length", group).groupBy("group").applyInPandas(packed_group, PLACED)
    return pieces.join(places, "row").drop("row")
