"""Ranked lexical search for many queries at once, with common subexpressions.

The score of a document for an item is a sum over the item's terms. Items share terms, so their sums share parts:

* Terms that occur in exactly the same items, equally often, always appear together. Such a class of terms is one node.
* Of the nodes, the pair that most items have in common becomes a node of its own, and so on until no pair is shared by
  two items. So the items are roots of a graph in which every shared part is there once (a query-sharing DAG).

For each document the parts of the graph that its terms reach are materialised once, level by level, as columns of one
table of partial sums per block of documents; items add up what is left. The best documents per item are kept per task,
then merged in two steps, so no task sees more than a bounded number of them.

One pass over the texts counts their terms and keeps, checkpointed, only what the items ask for; statistics (documents,
lengths, documents per term) are sums over all of them. Items are worked on in blocks of bounded size, each a pass
over the checkpointed counts.

Defined results: a null, empty or term-less document is in no statistic and has no score. A null or term-less item has
no rows. Repeated documents and documents without an id are ranked each, those without an id behind equal scores.
Repeated items are ranked each, and so is an item without an id. An empty table gives an empty result. Extra columns are
not read. Long texts are taken whole; the memory is that of the longest text and its words.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bound_batches

#: Term occurrences of the items that are searched in one pass (the last item may go beyond it); what is broadcast and
#: planned on the driver.
BLOCK_TERMS = 100_000
#: Pairs are looked for among so many neighbours in an item's parts; it bounds the planning and changes no result.
NEIGHBOURS = 32
#: Numbers in the table of partial sums of one block of documents.
TABLE_CELLS = 4_000_000
#: Best documents of one item are merged in so many parts first.
MERGE_PARTS = 64
LONGEST = 2**63 - 1


def term_bytes() -> bytes:
    """Translates bytes of UTF-8: A-Z to lower case, everything below U+0080 but letters and digits to a space."""
    return bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()


TRANSLATED = term_bytes()


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TRANSLATED).split() if text else []


class Plan(NamedTuple):
    """The graph of a block of items over term numbers 0 to terms - 1; node i has number terms + i.

    `nodes[i]` lists (number, times) of its parts, all smaller than its own number; `items[j]` those of item j.
    """

    terms: int
    nodes: list[list[tuple[int, int]]]
    items: list[list[tuple[int, int]]]


def share(items: list[dict[int, int]], terms: int) -> Plan:
    """Common subexpressions of items given as {term: times}."""
    places = defaultdict(list)
    for j, own in enumerate(items):
        for term, times in sorted(own.items()):
            places[term].append((j, times))
    classes = defaultdict(list)
    for term, where in sorted(places.items()):
        # The node holds each of its terms once, and an item takes the node as often as it takes the terms.
        classes[tuple(where)].append(term)
    nodes: list[list[tuple[int, int]]] = []
    held: list[dict[int, int]] = [{} for _ in items]
    for where, members in classes.items():
        if len(members) > 1 and len(where) > 1:
            nodes.append([(t, 1) for t in members])
            members = [terms + len(nodes) - 1]
        for j, times in where:
            for m in members:
                held[j][m] = times
    _merge_pairs(held, nodes, terms)
    return Plan(terms, nodes, [sorted(own.items()) for own in held])


def _merge_pairs(held: list[dict[int, int]], nodes: list[list[tuple[int, int]]], terms: int) -> None:
    """Replaces the pair of equal times that most items share by a node, while two items share one.

    Only parts of at least two items can be in such a pair. Counts of pairs are kept up to date; the heap may hold old
    counts, which are looked up again when they come out.
    """
    users: dict[int, set[int]] = defaultdict(set)
    for j, own in enumerate(held):
        for part in own:
            users[part].add(j)
    counts: Counter = Counter()
    for j, own in enumerate(held):
        shared = sorted((p for p in own if len(users[p]) > 1), key=lambda p: (-len(users[p]), p))
        counts.update(
            (min(a, b), max(a, b)) for i, a in enumerate(shared) for b in shared[i + 1 : i + 1 + NEIGHBOURS]
            if own[a] == own[b]
        )
    heap = [(-n, pair) for pair, n in counts.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        both = [j for j in sorted(users[a] & users[b]) if held[j][a] == held[j][b]]
        if len(both) < 2:
            continue
        if len(both) != -n:
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        node = terms + len(nodes)
        nodes.append([(a, 1), (b, 1)])
        near: Counter = Counter()
        for j in both:
            times = held[j].pop(a)
            held[j].pop(b)
            users[a].discard(j)
            users[b].discard(j)
            near.update(p for p, t in held[j].items() if t == times and len(users[p]) > 1)
            held[j][node] = times
            users[node].add(j)
        for other, n in near.items():
            if n > 1:
                heapq.heappush(heap, (-n, (other, node)))


class Sums:
    """Evaluates a plan for blocks of documents."""

    def __init__(self, plan: Plan):
        self.plan = plan
        self.width = plan.terms + len(plan.nodes)

    def of(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
        """Scores (documents by items) from (document, term, value) triples."""
        table = np.zeros((self.width, count), np.int64)
        table[terms, rows] = values
        reached = np.zeros(self.width, bool)
        reached[terms] = True
        for i, parts in enumerate(self.plan.nodes, self.plan.terms):
            for part, times in parts:
                if reached[part]:
                    table[i] += times * table[part] if times > 1 else table[part]
                    reached[i] = True
        out = np.zeros((len(self.plan.items), count), np.int64)
        for j, parts in enumerate(self.plan.items):
            for part, times in parts:
                if reached[part]:
                    out[j] += times * table[part] if times > 1 else table[part]
        return out


def count_terms(documents: DataFrame, key: str, text: str, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with terms; the last two only for the terms in `number`."""
    held = bound_batches(documents.sparkSession).sparkContext.broadcast(number)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value.get
        for batch in batches:
            sizes, terms, times = [], [], []
            for value in batch.column(1).to_pylist():
                words = terms_of(value)
                own = Counter(map(wanted, words))
                own.pop(None, None)
                sizes.append(len(words))
                terms.append(np.fromiter(own.keys(), "<i4", len(own)).tobytes())
                times.append(np.fromiter(own.values(), "<i8", len(own)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    return rows.mapInArrow(counted, "doc_id long, n long, terms binary, tfs binary").where("n > 0")


def documents_per_term(counted: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term: partial counts per task, one row per term of the block of items."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(terms, np.int64)
        for batch in batches:
            found = b"".join(batch.column(0).to_pylist())
            n += np.bincount(np.frombuffer(found, "<i4"), minlength=terms)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used])], ["term", "n"])

    rows = counted.select("terms").mapInArrow(partial, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, np.int64)
    for term, n in rows.collect():
        out[term] = n
    return out


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in holding], np.int64)


def exact_product(a: np.ndarray, factor: int) -> np.ndarray:
    """a * factor; in Python numbers where 64 bits could be too few."""
    top = int(a.max(initial=0))
    return (a if top * factor <= LONGEST else a.astype(object)) * factor


def length_factor(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """100 - 75 + (75 n N) div L."""
    return (exact_product(n, 75 * documents) // length + 25).astype(np.int64)


class Best:
    """The best documents of each item in what a task has seen: score down, then id up, without an id last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.held: list[tuple | None] = [None] * items

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        for j, own in enumerate(scores):
            at = np.flatnonzero(own)
            held = self.held[j]
            if held is not None and len(held[0]) == self.top:
                at = at[own[at] >= held[0][-1]]
            if not len(at):
                continue
            s, i, m = own[at], ids[at], missing[at]
            if len(s) > self.top:  # what is below the worst of the best needs no sorting
                high = s >= np.partition(s, len(s) - self.top)[len(s) - self.top]
                s, i, m = s[high], i[high], m[high]
            if held is not None:
                s, i, m = (np.concatenate(pair) for pair in zip(held, (s, i, m)))
            order = np.lexsort((i, m, -s))[: self.top]
            self.held[j] = (s[order], i[order], m[order])


def best_rows(counted: DataFrame, plan: Plan, weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best `top` documents of each item in each task."""
    held = counted.sparkSession.sparkContext.broadcast((Sums(plan), weight))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, weight = held.value
        best = Best(len(sums.plan.items), top)
        block = max(1, TABLE_CELLS // (sums.width + len(sums.plan.items)))
        for batch in batches:
            for first in range(0, batch.num_rows, block):
                part = batch.slice(first, block)
                found = part.column("terms").to_pylist()
                sizes = np.array([len(f) // 4 for f in found], np.int64)
                terms, tf = np.frombuffer(b"".join(found), "<i4"), np.frombuffer(b"".join(part.column("tfs").to_pylist()), "<i8")
                rows = np.repeat(np.arange(len(found)), sizes)
                m = length_factor(part.column("n").to_numpy(), documents, length)
                values = weight[terms] * (exact_product(tf, 10**9) // (1000 * tf + 8 * m[rows])).astype(np.int64)
                keys = part.column("doc_id")
                best.add(
                    sums.of(rows, terms, values, len(found)), keys.fill_null(0).to_numpy(zero_copy_only=False),
                    keys.is_null().to_numpy(zero_copy_only=False),
                )
        for j, kept in enumerate(best.held):
            if kept is not None:
                s, i, m = kept
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j] * len(s), pa.int32()), pa.array(i, mask=m), pa.array(s)], ["item", "doc_id", "score"]
                )

    return counted.mapInArrow(scored, "item int, doc_id long, score long")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The best of each item: of each of its MERGE_PARTS parts first, then of what those leave."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = Window.partitionBy("item", "part").orderBy(*order)
    some = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
    some = some.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top).drop("rank", "part")
    whole = Window.partitionBy("item").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items as (id, terms) in blocks of about BLOCK_TERMS term occurrences, one block on the driver at a time."""
    held, size = [], 0
    for item, value in items.select(F.col(key), F.col(text)).toLocalIterator():
        terms = terms_of(value)
        if not terms:
            continue
        held.append((item, terms))
        size += len(terms)
        if size >= BLOCK_TERMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(
    documents: DataFrame, items: DataFrame, top: int, *, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents with the highest score above 0 for each item."""
    spark: SparkSession = documents.sparkSession
    kind = items.select(F.col(item_key).alias("item_id")).schema[0].dataType.simpleString()
    shape = f"item_id {kind}, rank int, doc_id long, score long"
    found = [spark.createDataFrame([], shape)]
    for block in item_blocks(items, item_key, item_text):
        number = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        counted = cut_lineage(count_terms(documents, key, text, number))
        size, length = counted.agg(F.count("*"), F.sum("n")).first()
        if not size:
            break
        plan = share([dict(Counter(number[t] for t in terms)) for _, terms in block], len(number))
        weight = weights(size, documents_per_term(counted, len(number)))
        rows = ranked(best_rows(counted, plan, weight, size, length, top), top)
        # One row per item of the block: a proven size.
        names = F.broadcast(spark.createDataFrame([(j, i) for j, (i, _) in enumerate(block)], f"item int, item_id {kind}"))
        found.append(rows.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
