"""Document fingerprints: the k smallest hashes of a document's five-word shingles.

Only DataFrame functions. A sketch is a sorted array of at most k distinct 64-bit hashes, so the sketch of a union is
made from the sketches of its parts, and sketches give estimates of resemblance, containment and the number of distinct
shingles. With fewer than k shingles the sketch is the whole set and all of these are exact.

Words are what white space (space and U+0009 to U+000D) separates, as they stand. A text with fewer than five words has
its whole word sequence as its one shingle; a null, empty or blank text has none, and an empty sketch.
Two empty sketches are alike (1.0), an empty and a non-empty one are not (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import shuffled_once
from ..session import cut_lineage

K = 64
SHINGLE_WORDS = 5


def words(text: Column) -> Column:
    """Words of a text; blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def shingle_hashes(words: Column, size: int = SHINGLE_WORDS) -> Column:
    """One hash per place where a shingle starts."""
    many = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    )
    whole = F.array(F.xxhash64(words))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, many).when(F.size(words) > 0, whole).otherwise(none)


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K) -> DataFrame:
    """Adds the sketch of `text`; generators keep the word list from being made more than once."""
    listed = df.select("*", F.explode(F.array(words(text))).alias("_words"))
    return listed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.explode(F.array(bottom(shingle_hashes(F.col("_words")), k))).alias(name),
    )


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's k smallest hashes that both sketches hold."""
    union = merge(a, b, k)
    both = F.array_intersect(F.array_intersect(union, a), b)
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(both) / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from how small the k-th hash is."""
    largest = F.element_at(a, -1).cast("double")
    share = (largest + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that lies in the second."""
    union = distinct_shingles(merge(a, b, k), k)
    own = distinct_shingles(a, k)
    both = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / own))


def sketch_text(a: Column) -> Column:
    """The sketch as text: sixteen hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def following(df: DataFrame, key: str, name: str) -> DataFrame:
    """Per distinct key (nulls left out), the next smaller one; the smallest gets the largest.

    Keys alone are range-partitioned and checkpointed; a partition's last key gets the first of the next partition,
    over one row per partition.
    """
    keys = df.where(F.col(key).isNotNull()).select(F.col(key)).distinct()
    keys = cut_lineage(keys.repartitionByRange(F.desc(key)).withColumn("_part", F.spark_partition_id()))
    after = F.lead("_first").over(Window.orderBy("_part"))
    parts = keys.groupBy("_part").agg(F.max(key).alias("_first"))
    first = keys.agg(F.max(key)).first()[0]
    # One row per shuffle partition, a number the session sets.
    ends = F.broadcast(parts.select("_part", F.coalesce(after, F.lit(first)).alias("_end")))
    inside = F.lead(key).over(Window.partitionBy("_part").orderBy(F.desc(key)))
    return keys.join(ends, "_part").select(key, F.coalesce(inside, F.col("_end")).alias(name))


def fingerprints(documents: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Each document's sketch, and how like it are the next document and an edited text.

    The edited text: the last floor(n / 2) of a document's n code points give way to the first as many (or all) of the
    next document, in descending order of the key. Every row gives a row. Of several rows of one key the one with the
    greatest text is the document that comes next to the key before. Rows without a key have no place in the order:
    they have a sketch of their own, and null in all that needs a next document. Only the columns named are read, so
    others may have any name; texts are taken whole, however long. Returns key, n_chars, edited, sketch,
    edited_sketch, near_edited, near_next.
    """
    rows = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    placed = rows.where(F.col("_key").isNotNull())
    order = following(placed.select("_key"), "_key", "_next")
    # Sketched and shuffled once; both sides of the pairing read that shuffle.
    sketched = shuffled_once(with_sketch(placed, F.col("_text"), "_sketch", k), "_key")
    half = F.floor(F.length("_text") / 2).cast("int")
    kept = F.substring("_text", F.lit(1), F.length("_text") - half)
    own = sketched.select("_key", F.length("_text").alias("_n"), half.alias("_half"), kept.alias("_kept"), "_sketch")
    heads = sketched
    if _repeated(placed):
        heads = sketched.groupBy("_key").agg(F.max(F.struct("_text", "_sketch")).alias("_head")).select("_key", "_head.*")
    other = heads.select(
        F.col("_key").alias("_next"), F.col("_text").alias("_other"), F.col("_sketch").alias("_other_sketch")
    )
    paired = own.join(order, "_key").join(other, "_next")
    taken = F.when(F.col("_half") > 0, F.substring("_other", F.lit(1), F.col("_half"))).otherwise("")
    paired = paired.withColumn("edited", F.concat("_kept", taken))
    paired = with_sketch(paired.drop("_kept", "_other"), F.col("edited"), "_edited_sketch", k)
    found = paired.select(
        F.col("_key").alias(key), F.col("_n").cast("long").alias("n_chars"), "edited",
        F.col("_sketch").alias("sketch"), F.col("_edited_sketch").alias("edited_sketch"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_other_sketch"), k).alias("near_next"),
    )
    alone = with_sketch(rows.where(F.col("_key").isNull()), F.col("_text"), "_sketch", k).select(
        F.col("_key").alias(key), F.length("_text").cast("long").alias("n_chars"), F.col("_sketch").alias("sketch")
    )
    return found.unionByName(alone, allowMissingColumns=True)


def _repeated(rows: DataFrame) -> bool:
    return bool(rows.groupBy("_key").count().where("count > 1").limit(1).count())
