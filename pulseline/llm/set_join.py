"""Near duplicates by exact Jaccard similarity of five-word shingles, and their groups.

Equal sets are one class, so copies cost nothing. A class enters the index lists of its prefix, the rarest of its
shingles that any partner of similarity 0.8 must share one of. Two relations between sets skip most of the work:

* Lists are skipped by position: the sizes of two sets and the positions of the shared shingle bound their overlap, and
  a list is only visited in blocks of matching sizes.
* Answers are derived: in every list the members first meet a few pivots, the classes with the smallest hashes, so that
  all lists of a group have the same ones. Members that a pivot links are in one group and need no look at each other.
  While a list has members in several groups they meet further pivots, ever more in each round, so a member that is
  linked to a group drops out and only members that nothing links meet all others. For any two members their overlaps
  with the list's first pivot bound their own overlap from above, and two bitmaps of parities bound it as well, so most
  pairs are refused without comparing the sets.

Rarity comes from counts over all texts: of each chunk of texts the shingles that several sets of it hold are counted
on, and summed up by hash bucket, so the table of rarity has a fixed size. The order is the same for every set, which is
all that exactness needs.

Defined results: words are what U+0009 to U+000D and the space separate, A-Z lower-cased. A text with fewer than five
words has its whole sequence as its one shingle. Null, empty and wordless texts have no shingles and are in no group but
their own. In `near_duplicates` rows without an id have a null component and link nothing; in `keep_one` they are linked
like others and stay only if no row of their group has an id. Repeated rows are one class. An empty table gives an empty
result. Extra columns are not read. Long texts are taken whole. Shingles are 64-bit hashes, classes 128-bit ones; ids
never pass through Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranges import shuffled_once
from ..session import cut_lineage
from .common import settled, unused_name
from .components import components

WORDS = 5
#: The table of rarity has two to this power buckets of a byte.
LEVEL_BITS = 23
PAGE = 1 << 16
CHUNK_SHINGLES = 4_000_000
#: Classes a task remembers so as not to repeat a copy's entries; results do not depend on it.
REMEMBERED = 1_000_000
#: Buckets of a set's bitmap, at least.
BITS = 1_024
#: Bits of the filter that says whose sets are wanted.
FILTER_BITS = 1 << 24
SETS_AT_ONCE = 2_000
#: Rows of classes that may be broadcast, some 5 MB.
BROADCAST_ROWS = 100_000
#: Partners of one set in one row.
SALT_PAIRS = 256
#: Members of a list that meet all others of it in the first round, and how many times as many in each further one.
PIVOTS, GROWTH = 8, 4

ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.encode().lower().split() if text else []  # bytes: exactly A-Z and the six white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        h = (h ^ (h >> np.uint64(31))) * ODD + w[j : len(w) - size + 1 + j]
    h = (h ^ (h >> np.uint64(30))) * MIX
    return np.unique(h ^ (h >> np.uint64(27)))


def class_of(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def bitmap(shingle_set: np.ndarray) -> np.ndarray:
    """For each bucket of hashes whether an odd number of the set's shingles fall in, as 64-bit numbers.

    There are as many buckets as shingles, rounded up to a power of two, and BITS at least.
    """
    size = max(BITS, 1 << max(len(shingle_set) - 1, 1).bit_length())
    odd = np.bincount((shingle_set % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text: where to find it again."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signatures(documents: DataFrame) -> DataFrame:
    """One pass over all texts: (doc_id, key, n, c, bits) per row, and (token, n) for shingles of several sets of a chunk.

    Ids and text keys go through as they are.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        seen: set[bytes] = set()
        names = ["doc_id", "key", "n", "c", "bits", "token"]
        shape = pa.schema([pa.field(f, t) for f, t in zip(names, (
            pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()))])

        def counted() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > 1
            rows = int(often.sum())
            none = [pa.nulls(rows, shape.field(i).type) for i in (0, 1, 3, 4)]
            cells = [none[0], none[1], pa.array(n[often]), none[2], none[3], pa.array(token[often].view(np.int64))]
            return pa.RecordBatch.from_arrays(cells, schema=shape)

        for batch in batches:
            sizes, classes, bits = [], [], []
            for text in batch.column(2).to_pylist():
                own = shingles(text)
                c = class_of(own)
                sizes.append(len(own))
                classes.append(c)
                bits.append(bitmap(own))
                if c in seen:  # copies do not make a shingle frequent
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(c)
                held.append(own)
                total += len(own)
                if total >= CHUNK_SHINGLES:
                    yield counted()
                    held, total = [], 0
            cells = [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(bits, pa.list_(pa.int64()))]
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells, none], schema=shape)
        if held:
            yield counted()

    rows = documents.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(signed, "doc_id long, key binary, n long, c binary, bits array<long>, token long")


def rarity(signed: DataFrame) -> np.ndarray:
    """How frequent the shingles of a bucket are: eight times the logarithm of their counts, a byte per bucket.

    The table has 2 ** LEVEL_BITS bytes whatever the corpus; it is put together in pages, so the driver gets one row
    per page. Shingles of one bucket count as equally rare, which costs some precision and no result.
    """
    buckets, size = 1 << LEVEL_BITS, min(PAGE, 1 << LEVEL_BITS)
    bucket = F.col("token").bitwiseAND(F.lit(buckets - 1))
    counts = signed.where("token IS NOT NULL").groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))

    def page(key: tuple, rows: pa.Table) -> pa.Table:
        levels = np.zeros(size, np.uint8)
        n = np.log2(rows["n"].to_numpy().astype(np.float64)) * 8
        levels[rows["bucket"].to_numpy() % size] = np.minimum(n, 255).astype(np.uint8)
        return pa.table({"page": pa.array([key[0].as_py()], pa.int64()), "levels": pa.array([levels.tobytes()])})

    paged = counts.groupBy(F.floor(F.col("bucket") / size).alias("page"))
    out = np.zeros(buckets, np.uint8)
    for row in paged.applyInArrow(page, "page long, levels binary").collect():
        out[row["page"] * size : (row["page"] + 1) * size] = np.frombuffer(row["levels"], np.uint8)
    return out


def by_rarity(own: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A set's shingles, rarest first, ties by hash."""
    return own[np.lexsort((own, levels[own & np.uint64(len(levels) - 1)]))]


def index_entries(documents: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, c, n, pos): each class in the lists of its prefix."""
    table = documents.sparkSession.sparkContext.broadcast(levels)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            parts = []
            for text in batch.column(0).to_pylist():
                own = shingles(text)
                if not len(own) or (c := class_of(own)) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(c)
                n = len(own)
                parts.append((c, n, by_rarity(own, table.value)[: n - (4 * n + 4) // 5 + 1]))
            if parts:
                lengths = [len(p) for _, _, p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([p for _, _, p in parts]).view(np.int64)),
                        pa.array([c for c, _, _ in parts]).take(pa.array(np.repeat(np.arange(len(parts)), lengths))),
                        pa.array(np.repeat(np.array([n for _, n, _ in parts], np.int32), lengths)),
                        pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
                    ],
                    ["token", "c", "n", "pos"],
                )

    return documents.select("text").mapInArrow(entries, "token long, c binary, n int, pos int")


def needed_overlap(n: Column, m: Column) -> Column:
    """The smallest overlap of two sets of these sizes at similarity 0.8: 9 * overlap >= 4 * (n + m)."""
    return F.ceil(4 * (n + m) / 9)


def can_match(n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Whether sizes, and the positions of the first shared shingle, still allow similarity 0.8.

    All sets have one order, so nothing before the first shared shingle is shared. A linked pair passes in the list of
    its first shared shingle; that it may be refused in the lists of later ones loses nothing.
    """
    most = F.least(n - pos, m - at)
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (most >= needed_overlap(n, m))


def small(df: DataFrame) -> DataFrame:
    """`df`, which is checkpointed, as a broadcast if it is counted to be small; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def place_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS hashed keys, 2 MB whatever their number: it may let others pass, never stops one of them."""
    place = place_of(F.col("key"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = keys.select(F.floor(place / 64).alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def class_sets(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """(c, tokens) of the texts with these keys, and of a few others: the sorted hashes as bytes.

    The texts stay where they are read; a bitmap of the keys says which ones to look at.
    """
    bits = documents.sparkSession.sparkContext.broadcast(key_filter(keys))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            place = batch.column(0).to_numpy()
            wanted = np.flatnonzero((bits.value[place // 64] >> (place % 64)) & 1)
            for first in range(0, len(wanted), SETS_AT_ONCE):
                classes, tokens = [], []
                for text in batch.column(1).take(pa.array(wanted[first : first + SETS_AT_ONCE])).to_pylist():
                    own = shingles(text)
                    c = class_of(own)
                    if c not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(c)
                        classes.append(c)
                        tokens.append(own.tobytes())
                cells = [pa.array(classes, pa.binary()), pa.array(tokens, pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, ["c", "tokens"])

    rows = documents.select(place_of(text_key(F.col("text"))).alias("place"), "text")
    return rows.mapInArrow(made, "c binary, tokens binary")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) with `both`, the size of the overlap.

    A set goes to its partners in rows of about SALT_PAIRS of them. Sets with more partners have several rows, which
    are dealt out before they are unfolded, so no task sends one set to all of its partners.
    """
    rows_of = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_PAIRS).alias("rows"))
    salted = pairs.join(rows_of, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("rows")))
    rows = settled(salted.groupBy("a", "na", "salt").agg(F.collect_list(F.struct("b", "nb")).alias("partners")))
    sets = shuffled_once(sets, "c")  # both sides of the pairs read one shuffle
    sent = rows.join(sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta")), "a")
    if not rows.where("salt > 0").isEmpty():
        dealt = sent.where("salt > 0").repartition("a", "salt")
        sent = sent.where("salt = 0").union(dealt)
    sent = sent.select("a", "na", "ta", F.inline("partners"))

    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            out.append(int((b[at] == a).sum()))
        return pd.Series(out, dtype="int32")

    common.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    met = sent.join(sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb")), "b")
    # A repeated row repeats its set, and so its pairs.
    return met.select("a", "b", "na", "nb", F.pandas_udf(common, "int")("ta", "tb").alias("both")).distinct()


LINKED = "9 * both >= 4 * (na + nb)"


def not_refused(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) whose bitmaps allow a link: differing buckets are at most the elements not in both.

    The longer of two bitmaps is folded onto the other; sizes that can match differ by one fold at most.
    """
    met = pairs.join(bits.select(F.col("c").alias("a"), F.col("bits").alias("x")), "a")
    met = met.join(bits.select(F.col("c").alias("b"), F.col("bits").alias("y")), "b")

    def onto(long: str, short: str) -> Column:
        size = F.size(short)
        halves = F.slice(long, 1, size), F.slice(long, size + 1, size)
        folded = F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(long) > size, folded).otherwise(F.col(long))

    differ = F.aggregate(
        F.zip_with(onto("x", "y"), onto("y", "x"), lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")),
        F.lit(0), lambda s, v: s + v,
    )
    most = F.col("na") + F.col("nb") - 2 * needed_overlap(F.col("na"), F.col("nb"))
    return met.where(differ <= most).select("a", "b", "na", "nb")


def by_hash():
    return Window.partitionBy("token").orderBy(F.xxhash64("c"), "c")


def can_link(x: str, y: str) -> Column:
    """Whether two members of a list are in different groups and may be similar, by sizes, positions, and by what each
    has in common with the list's first pivot: at most the smaller of the two, and the smaller of what is left."""
    n, m, seen, too = (F.col(f"{side}_{c}") for c in ("n", "both") for side in (x, y))
    most = F.least(seen, too) + F.least(n - seen, m - too)
    return (
        (F.col(f"{x}_label") != F.col(f"{y}_label"))
        & can_match(n, F.col(f"{x}_pos"), m, F.col(f"{y}_pos"))
        & (seen.isNull() | too.isNull() | (most >= needed_overlap(n, m)))
    )


def side(lists: DataFrame, name: str) -> list[Column]:
    return [F.col(c).alias(f"{name}_{c}") for c in ("c", "n", "pos", "label", "both")]


def pivot_pairs(lists: DataFrame, first: int, last: int) -> DataFrame:
    """(a, b, na, nb): in each list the members number `first` to `last` by hash against all of it; pairs stand once."""
    lists = shuffled_once(lists, "token")  # the window and the join read one shuffle
    ranked = lists.withColumn("rank", F.row_number().over(by_hash()))
    pivots = ranked.where(F.col("rank") <= last).where(F.col("rank") >= first).select("token", *side(lists, "p"))
    met = lists.select("token", *side(lists, "m")).join(pivots, "token").where(can_link("p", "m"))
    low = F.col("p_c") < F.col("m_c")
    ends = [
        F.when(low, F.col(f"p_{c}")).otherwise(F.col(f"m_{c}")).alias(a) for a, c in (("a", "c"), ("na", "n"))
    ] + [F.when(low, F.col(f"m_{c}")).otherwise(F.col(f"p_{c}")).alias(b) for b, c in (("b", "c"), ("nb", "n"))]
    return met.select(*ends).groupBy("a", "b").agg(F.min("na").alias("na"), F.min("nb").alias("nb"))


def open_lists(lists: DataFrame, labels: DataFrame, done: int) -> DataFrame:
    """Lists of more than `done` + 1 members, so many of which have met all others, that are not all in one group yet.

    With the members' labels.
    """
    named = lists.drop("label").join(small(labels), "c", "left").withColumn("label", F.coalesce("label", "c"))
    order = F.xxhash64("label")
    ends = named.groupBy("token").agg(
        F.min(order).alias("low"), F.max(order).alias("high"), F.count("*").alias("members")
    ).where((F.col("low") != F.col("high")) & (F.col("members") > done + 1))
    return named.join(ends.select("token"), "token")


def with_overlap(lists: DataFrame, met: DataFrame) -> DataFrame:
    """Lists with what each member has in common with the first pivot, where the two have been compared."""
    pivot = lists.withColumn("rank", F.row_number().over(by_hash())).where(F.col("rank") <= 1)
    named = lists.drop("both").join(pivot.select("token", F.col("c").alias("p")), "token")
    ends = [F.least("p", "c").alias("a"), F.greatest("p", "c").alias("b")]
    known = named.select("*", *ends).join(met.select("a", "b", "both"), ["a", "b"], "left")
    both = F.when(F.col("p") == F.col("c"), F.col("n")).otherwise(F.col("both"))
    return known.withColumn("both", both).drop("a", "b", "p")


def index_lists(entries: DataFrame) -> DataFrame:
    """(token, c, n, pos, label, both) of lists with two classes at least; a copy that several tasks met is one entry."""
    entries = shuffled_once(entries, "token")
    order = F.xxhash64("c")  # as long as nothing else than numbers is aggregated, no sort is needed
    ends = entries.groupBy("token").agg(F.min(order).alias("low"), F.max(order).alias("high")).where("low <> high")
    shared = entries.join(ends.select("token"), "token")
    one = shared.groupBy("token", "c").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    return one.withColumns({"label": F.col("c"), "both": F.lit(None).cast("int")})


def linked(met: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(u, v) of the similar pairs, and of what is known of the groups, as one link per class."""
    links = met.where(LINKED).select(F.col("a").alias("u"), F.col("b").alias("v"))
    return links if labels is None else links.union(labels.where("c <> label").select("c", "label"))


def groups_of_classes(documents: DataFrame, signed: DataFrame) -> DataFrame:
    """(c, label) of every class that has a link: the smallest class of its group."""
    lists = settled(index_lists(index_entries(documents, rarity(signed))))
    classes = signed.where("token IS NULL AND n > 0").groupBy("c")
    classes = settled(classes.agg(F.min("key").alias("key"), F.first("bits").alias("bits")))
    first, bits = classes.select("c", "key"), classes.select("c", "bits")

    labels, sets, done, more = None, None, 0, PIVOTS
    while True:
        pairs = pivot_pairs(lists, done + 1, done + more)
        if sets is None:  # later the bitmaps are those of the members left
            pairs = settled(pairs)
            pairs = not_refused(pairs, shuffled_once(bits.join(classes_of(pairs), "c", "left_semi"), "c"))
        else:
            pairs = not_refused(pairs, bits)
        pairs = settled(pairs)
        ends = small(settled(classes_of(pairs)))
        own = sets.join(ends, "c", "left_semi") if sets is not None else class_sets(documents, first.join(ends, "c"))
        met = settled(overlaps(pairs, own))
        labels = components(linked(met, labels))
        done, more = done + more, GROWTH * more
        lists = open_lists(lists, labels, done)
        lists = settled(with_overlap(lists, met) if sets is None else lists)
        if lists.isEmpty():
            return labels
        if sets is None:  # what is known of the members left serves all further rounds
            left = small(settled(lists.select("c").distinct()))
            sets = settled(class_sets(documents, first.join(left, "c")))
            bits = settled(bits.join(left, "c", "left_semi"))


def classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) of every row."""
    named = documents.where("doc_id IS NOT NULL")
    signed = cut_lineage(signatures(documents))
    rows = signed.where("token IS NULL").select("doc_id", "n", "c")
    labels = groups_of_classes(named, signed.where("token IS NOT NULL OR doc_id IS NOT NULL"))
    first = rows.where("doc_id IS NOT NULL AND n > 0").groupBy("c").agg(F.min("doc_id").alias("doc_id"))
    first = first.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    smallest = first.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    groups = first.join(smallest, "label").select("c", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return rows.join(groups, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near duplicates stays, the one with the smallest id.

    Rows without an id stay only where no row of the group has one; of equal ids the smallest text key decides, and of
    rows that repeat both one stays. Rows without a word are in no group and stay.
    """
    signed = cut_lineage(signatures(docs))
    rows = signed.where("token IS NULL AND n > 0").select("doc_id", "key", "c")
    labels = groups_of_classes(docs, signed)
    same = rows.groupBy("c", "doc_id", "key").agg(F.count("*").alias("copies"))
    same = same.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "copies")
    kept = same.groupBy("label").agg(F.min(order).alias("kept"))
    kept = kept.select(*[F.col(f"kept.{c}").alias(f"_{c}") for c in ("doc_id", "key", "copies")])
    # Rows without a word stay whatever they are.
    none = signed.where("token IS NULL AND n = 0").select(
        F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), F.lit(1).cast("long").alias("_copies")
    ).distinct()
    kept = cut_lineage(kept.union(none))
    name = unused_name(docs, "_key_of_text")
    keyed = docs.withColumn(name, text_key(F.col("text")))
    here = keyed["doc_id"].cast("long").eqNullSafe(kept["_doc_id"]) & (keyed[name] == kept["_key"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = keyed.join(kept.where("_copies = 1"), here, "left_semi").select(*columns)
    if not kept.where("_copies > 1").limit(1).count():
        return out
    # Rows that repeat id and text: one each, reduced before the shuffle.
    again = keyed.join(kept.where("_copies > 1"), here, "left_semi")
    one = again.groupBy("doc_id", name).agg(F.first(F.struct(*columns)).alias("row")).select("row.*")
    return out.unionByName(one)
