"""The corpus pipeline: toxic documents go, then low quality, then near duplicates; what is left is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseline.llm import packing, rules, set_join, toxicity
from pulseline.llm.queries import vocabulary_path
from pulseline.session import shared_folder


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: pieces and their places in windows, as the packing query returns them."""
    return packing.packed(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity.keep_clean),
    ("quality", rules.keep_good),
    ("near_duplicates", set_join.keep_one),
    ("packing", pack_windows),
]

#: Trained models and hashed shingles have no plain SQL; a test runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet to the shared folder and read again."""
    import uuid

    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
