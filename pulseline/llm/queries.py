"""The registered queries of the numbered operators: each over its whole table, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import (
    hilbert, id_planes, inner_product, packing, piece_codec, pseudo_likelihood, rules, set_join, shallot, shared_terms,
    sketch, toxicity,
)
from .common import evaluated, table

SHARDS = 40
DIMENSIONS = ["lang", "source", "n_chars", "doc_id"]
TOP = 10
CLUSTERS, ROUNDS, WIDTH = 16, 3, 64
END_ID = 2


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.hilbert_shards(table(spark, sf_dir, "documents"), SHARDS, DIMENSIONS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op2_inner_product_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_product.top_inner_products(table(spark, sf_dir, "embeddings"), "id % 100 = 0", TOP)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit_quality(documents, table(spark, sf_dir, "labels"), rules.learned_from())
    scored = rules.with_quality(documents, "text", "score", model)
    return scored.select(
        "doc_id", (~rules.learned_from()).alias("held_out"), "score",
        (F.col("score") >= rules.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pseudo_likelihood.fit_network(documents)
    scored = pseudo_likelihood.with_pseudo_likelihood(documents, "text", "s", model, keep=["doc_id"])
    return scored.select(
        "doc_id", F.col("s.tokens").alias("tokens"), F.col("s.log_likelihood").alias("log_likelihood"),
        F.when(F.col("s.tokens") > 0, F.col("s.log_likelihood") / F.col("s.tokens")).alias("mean_log_likelihood"),
    )


def op7_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels"), toxicity.learned_from())
    scored = toxicity.with_toxicity(documents, "text", "score", model)
    return scored.select(
        "doc_id", (~toxicity.learned_from()).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the ids and of the text they decode to."""
    path = vocabulary_path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.with_round_trip(documents, "text", "coded", path, merges=True)
    return evaluated(coded, {
        "n_ids": F.size("coded.ids").cast("long"),
        "ids_xxhash64": F.xxhash64("coded.ids"),
        "decoded_crc32": F.crc32(F.col("coded.text").cast("binary")).cast("long"),
        "round_trip": F.col("coded.text").eqNullSafe(F.col("text")),
    }).select("doc_id", "n_ids", "ids_xxhash64", "decoded_crc32", "round_trip")


def op9_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch.sketch_text(F.col("sketch")).alias("fingerprint"),
        sketch.sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next", sketch.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = vocabulary_path("piece_bpe_32k.model")
    return piece_codec.with_token_count(documents, "text", "n_tokens", path, merges=True).select("doc_id", "n_tokens")


def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.clustered(table(spark, sf_dir, "embeddings"), CLUSTERS, ROUNDS, width=WIDTH, scale=WIDTH)


def op12_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/id-planes-{uuid.uuid4().hex}"
    id_planes.write_ids(table(spark, sf_dir, "documents"), folder, vocabulary_path("word_bpe_49k.json"), END_ID)
    return id_planes.read_digest(spark, folder)


def op13_shared_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_terms.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), TOP)


QUERIES = {
    q.__name__: q
    for q in (
        op1_hilbert_shards, op2_inner_product_topk, op3_jaccard_join, op4_rule_ensemble, op5_differencing_pack,
        op6_pseudo_likelihood, op7_conv_toxicity, op8_piece_codec, op9_bottom_k_sketch, op10_token_counts,
        op11_shallot_clusters, op12_id_planes, op13_shared_terms,
    )
}

INNER_PRODUCT_SQL = f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {TOP}
"""

JACCARD_SQL = r"""
WITH RECURSIVE listed AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM listed
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_ AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
    SELECT u, v FROM both_ JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * k >= 80 * (x.n + y.n - k)
), reached AS (
    SELECT doc_id AS origin, doc_id AS node FROM documents
    UNION SELECT origin, v FROM reached JOIN links ON u = node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r.node) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reached r ON r.origin = d.doc_id
GROUP BY d.doc_id, n
"""


def shallot_sql() -> str:
    """Plain assignment of every vector to every centroid, round by round."""
    parts = [f"""
kept AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({WIDTH} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {WIDTH}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
    SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS cluster, v FROM kept WINDOW w AS (ORDER BY sha256('1:' || vec_id), v)
    QUALIFY row_number() OVER w <= {CLUSTERS}
)"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT row, vec_id, k.v, cluster,
           list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM kept k, c{i} c QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)""")
        if i < ROUNDS:
            parts.append(f"""s{i} AS (
    SELECT cluster, dim, CAST(floor(CAST(sum(v[dim]) AS DOUBLE) / count(*)) AS BIGINT) AS mean
    FROM a{i}, (SELECT unnest(range(1, {WIDTH} + 1)) AS dim) GROUP BY cluster, dim
), c{i + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.v, c.v) AS v
    FROM c{i} c LEFT JOIN (SELECT cluster, list(mean ORDER BY dim) AS v FROM s{i} GROUP BY cluster) m USING (cluster)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c USING (cluster)
"""


SHARED_TERMS_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), asked AS (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (SELECT count(*) AS docs, sum(len(w)) AS total FROM words WHERE len(w) > 0),
counted AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM words)
    GROUP BY ALL
), weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
    FROM counted, sizes GROUP BY term, docs
), scored AS (
    SELECT item, item_id, row, doc_id, sum(weight * times * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS score
    FROM (SELECT item, item_id, term, count(*) AS times FROM asked GROUP BY ALL)
    JOIN counted USING (term) JOIN weighed USING (term), sizes GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM scored WHERE score > 0 WINDOW w AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER w <= 10
"""

#: The other operators (models, curve over quantiles, hashes of Spark) have no plain SQL; tests check them otherwise.
SQL = {
    "op2_inner_product_topk": INNER_PRODUCT_SQL, "op3_jaccard_join": JACCARD_SQL,
    "op11_shallot_clusters": shallot_sql(), "op13_shared_terms": SHARED_TERMS_SQL,
}
