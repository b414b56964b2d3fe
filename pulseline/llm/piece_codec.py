"""SentencePiece encoding and decoding of whole texts, and counts of their tokens.

Defined results: a null text gives null ids and count, an empty one no ids and 0. Repeated rows and extra columns stay
as they are; the new column's name must be free. With `merges` the scores are a BPE model's ranks, else those of a unigram
model. Texts are worked on one at a time, so memory is that of the longest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .pieces import Vocabulary, decode

#: Rows whose results are held at a time.
SLICE = 500


def _columns(function, kind: str):
    function.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(function, kind)


def with_piece_ids(df: DataFrame, text: str, name: str, model_path: str) -> DataFrame:
    """Adds the ids of `text`; the model file is read on the driver, its vocabulary is broadcast (its size is fixed)."""
    held = bound_batches(df.sparkSession).sparkContext.broadcast(Vocabulary.from_model(model_path))

    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = held.value.tool("ids")
        for batch in texts:
            yield pd.Series(
                [None if t is None else np.frombuffer(b"".join(memory.parts(t)), np.int32) for t in batch], dtype=object
            )

    return df.withColumn(name, _columns(encoded, "array<int>")(text))


def with_piece_text(df: DataFrame, ids: str, name: str, model_path: str) -> DataFrame:
    """Adds the text that a column of ids stands for."""
    held = bound_batches(df.sparkSession).sparkContext.broadcast(Vocabulary.from_model(model_path))

    def decoded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if i is None else decode(held.value, i.tolist()) for i in batch], dtype=object)

    return df.withColumn(name, _columns(decoded, "string")(ids))


def with_round_trip(df: DataFrame, text: str, name: str, model_path: str, merges: bool = False) -> DataFrame:
    """Adds a struct of the `ids` of `text` and the `text` that these ids stand for.

    Both are made in one Python worker, slice by slice, where the two columns above take a worker each.
    """
    held = bound_batches(df.sparkSession).sparkContext.broadcast(Vocabulary.from_model(model_path))

    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = held.value.tool("ids", merges)
        for batch in texts:
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                ids = [None if t is None else np.frombuffer(b"".join(memory.parts(t)), np.int32) for t in part]
                decoded = [None if i is None else decode(held.value, i.tolist()) for i in ids]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "text": pd.Series(decoded, dtype=object)})

    both.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return df.withColumn(name, F.pandas_udf(both, "ids array<int>, text string")(text))


def with_token_count(df: DataFrame, text: str, name: str, model_path: str, merges: bool = False) -> DataFrame:
    """Adds how many ids `text` has; with `merges` the ids of each distinct segment are made once and counted."""
    held = bound_batches(df.sparkSession).sparkContext.broadcast(Vocabulary.from_model(model_path))

    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = held.value.tool("count", merges)
        for batch in texts:
            yield pd.Series([None if t is None else sum(memory.parts(t)) for t in batch], dtype="Int64")

    return df.withColumn(name, _columns(counted, "long")(text))
