"""Toxicity of whole texts with a convolutional text classifier, trained in numpy.

A word's embedding is the sum of rows that hashes of the word and of its first letters pick from one table, so unseen
words of a known family count. Filters of several widths run over the words, the maximum over all positions of the
text is pooled, and a logistic layer scores the pooled values. Scoring uses that a filter is a sum over its places:
each distinct word's share of every filter place is computed once, and a position only adds up shares.

Thresholds are calibrated by language, which is recognised from function words in the text itself: a score of 0.5 lies
at the threshold of the text's language, set on training rows that the fit did not see.

Defined results: null, empty and wordless texts have no positions and score with all filters at zero. Without labelled
rows of both classes there is nothing to learn and every text scores 0. Any other column, repeated rows and
name clashes don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, fold, label_examples, table, unused_name

LABELLED_ROWS = 5_000  # the fit reads at most this many labelled documents
BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 5
BATCH_WORDS = 40_000
STEP = 0.02
DECAY = 1e-5
HEADS = (3, 4, 5)
CUT_WORDS = 1 << 18  # texts are scored together until they have this many words

#: Function words by language; the language with most of them in a text is taken, the first on ties.
LANGUAGES = {
    "en": "the of and to in is that for it was on are by with",
    "fr": "le la les de des un une et en que pour dans par du",
    "de": "der die das und in den von zu mit sich des auf ist im",
    "es": "el los las que y en un una por con del se lo al",
}
OTHER = "other"
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[int]:
    """Table rows of a word: itself, and its first letters."""
    heads = [word, *(f"{n}{word[:n]}" for n in HEADS if len(word) >= n)]
    return [zlib.crc32(h.encode()) % BUCKETS for h in heads]


def language_marks(known: dict[str, int]) -> np.ndarray:
    """For each known word: in which languages' lists it stands."""
    marks = np.zeros((len(known), len(LANGUAGES)), np.int32)
    for at, listed in enumerate(LANGUAGES.values()):
        for w in listed.split():
            if w in known:
                marks[known[w], at] = 1
    return marks


def language_of(ids: np.ndarray, marks: np.ndarray) -> str:
    counts = marks[ids].sum(axis=0)
    return [*LANGUAGES][int(counts.argmax())] if len(ids) and counts.max() else OTHER


@dataclass
class ConvModel:
    """Embedding table, filters by width, output layer, and thresholds by language."""

    table: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]

    def shares(self, words: list[str]) -> np.ndarray:
        """Share of each word at each filter place: (words, places, FILTERS), places in the order of WIDTHS."""
        embedded = np.zeros((len(words), DIM), np.float32)
        rows = [features_of(w) for w in words]
        who = np.repeat(np.arange(len(words)), [len(r) for r in rows])
        np.add.at(embedded, who, self.table[np.fromiter((x for r in rows for x in r), np.int64, len(who))])
        places = np.concatenate([self.filters[w] for w in WIDTHS])
        return np.einsum("nd,pdf->npf", embedded, places).astype(np.float32)


def pooled(shares: np.ndarray, ids: np.ndarray, place_wanted: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of every filter over all positions, and if wanted where; a filter may reach over the end of the text.

    `shares` has a last row of zeros that pads the end. Values are at least 0, where the position is -1.
    """
    pad = len(shares) - 1
    best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    where = np.full(len(best), -1)
    ids = np.concatenate([ids, np.full(max(WIDTHS) - 1, pad, ids.dtype)])
    n = len(ids) - max(WIDTHS) + 1
    place = 0
    for i, width in enumerate(WIDTHS):
        value = shares[ids[:n], place]
        for j in range(1, width):
            value = value + shares[ids[j : n + j], place + j]
        place += width
        if n:
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            top = value.max(axis=0)
            best[own] = np.maximum(top, 0)
            if place_wanted:
                where[own] = np.where(top > 0, value.argmax(axis=0), -1)
    return best, where


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> ConvModel | None:
    """Fit on all given texts; every fifth one only sets the thresholds."""
    if not len(texts) or labels.min() == labels.max():
        return None
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int32) for t in texts]
    # The last word and the last table row are padding.
    rows = np.full((len(vocabulary) + 1, 1 + len(HEADS)), BUCKETS, np.int32)
    for i, w in enumerate(vocabulary):
        f = features_of(w)
        rows[i, : len(f)] = f
    table = np.zeros((BUCKETS + 1, DIM), np.float32)
    table[:-1] = rng.normal(0, 0.1, (BUCKETS, DIM))
    filters = {w: rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    size = len(WIDTHS) * FILTERS
    bias, out, out_bias = np.full(size, 0.0, np.float32), rng.normal(0, 0.5, size).astype(np.float32), 0.0
    held = np.arange(len(texts)) % 5 == 4
    fit = np.flatnonzero(~held)
    squares = {w: np.ones_like(f) * 1e-8 for w, f in filters.items()}
    table_squares = np.full(table.shape, 1e-8, np.float32)
    out_squares, bias_squares = np.full(size, 1e-8), 1e-8

    def forward(index: int):
        own, local = np.unique(ids[index], return_inverse=True)
        own = np.append(own, len(vocabulary))
        embedded = table[rows[own]].sum(axis=1)
        shares = np.einsum("nd,pdf->npf", embedded, np.concatenate([filters[w] for w in WIDTHS]))
        value, where = pooled(shares, local, place_wanted=True)
        return value, where, own, local, embedded

    for epoch in range(EPOCHS):
        step = STEP / (1 + epoch)
        for index in rng.permutation(fit):
            value, where, own, local, embedded = forward(index)
            score = 1 / (1 + np.exp(-np.clip(value @ out + out_bias, -30, 30)))
            wrong = score - labels[index]
            if abs(wrong) < 0.02:
                continue
            down = wrong * out
            grad_out = wrong * value + DECAY * out
            out_squares += grad_out**2
            out -= step * grad_out / np.sqrt(out_squares)
            bias_squares += wrong**2
            out_bias -= step * wrong / np.sqrt(bias_squares)
            padded = np.append(local, [len(own) - 1] * (max(WIDTHS) - 1))
            grad_words = {}
            for i, width in enumerate(WIDTHS):
                grad = np.zeros_like(filters[width])
                for f in range(FILTERS):
                    at, g = where[i * FILTERS + f], down[i * FILTERS + f]
                    if at < 0:
                        continue
                    for j in range(width):
                        w = padded[at + j]
                        grad[j, :, f] += g * embedded[w]
                        if w < len(own) - 1:
                            grad_words[w] = grad_words.get(w, 0) + g * filters[width][j, :, f]
                squares[width] += grad**2
                filters[width] -= step * grad / np.sqrt(squares[width])
            for w, g in grad_words.items():
                touched = rows[own[w]]
                touched = touched[touched < BUCKETS]
                table_squares[touched] += g**2
                table[touched] -= step * g / np.sqrt(table_squares[touched])
    model = ConvModel(table[:-1], filters, bias, out, float(out_bias), {})
    marks = language_marks(vocabulary)
    logits = np.array([forward(i)[0] @ out + out_bias for i in np.flatnonzero(held)])
    languages = np.array([language_of(ids[i], marks) for i in np.flatnonzero(held)])
    everywhere = best_threshold(logits, labels[held], 0.0)
    for language in [*LANGUAGES, OTHER]:
        own = languages == language
        model.thresholds[language] = best_threshold(logits[own], labels[held][own], everywhere)
    return model


def best_threshold(logits: np.ndarray, labels: np.ndarray, otherwise: float) -> float:
    """Cut with the fewest errors, in the middle of the widest gap that has them; `otherwise` without both classes."""
    if not len(labels) or labels.min() == labels.max():
        return otherwise
    order = np.argsort(logits, kind="stable")
    values, truth = logits[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(truth)]) + np.concatenate([np.cumsum((1 - truth)[::-1])[::-1], [0]])
    edges = np.concatenate([[values[0] - 1], values, [values[-1] + 1]])
    gaps = np.where(errors == errors.min(), np.diff(edges), -1)
    best = int(gaps.argmax())
    return float((edges[best] + edges[best + 1]) / 2)


def score_texts(model: ConvModel | None, texts: pd.Series) -> np.ndarray:
    """Scores of one batch; distinct words' shares are computed once for every cut of at most CUT_WORDS words."""
    out = np.zeros(len(texts))
    if model is None:
        return out
    at, pending, used = 0, [], 0

    def flush(first: int, listed: list[list[str]]) -> None:
        known: dict[str, int] = {}
        number = known.setdefault
        ids = [np.array([number(w, len(known)) for w in words], np.int64) for words in listed]
        marks = language_marks(known)
        shares = np.concatenate([model.shares(list(known)), np.zeros((1, sum(WIDTHS), FILTERS), np.float32)])
        for i, own in enumerate(ids):
            value, _ = pooled(shares, own)
            logit = float(value @ model.out) + model.out_bias
            threshold = model.thresholds[language_of(own, marks)]
            out[first + i] = 1 / (1 + np.exp(-np.clip(logit - threshold, -40, 40)))

    for text in texts:
        words = words_of(text)
        pending.append(words)
        used += len(words)
        if used >= CUT_WORDS:
            flush(at, pending)
            at, pending, used = at + len(pending), [], 0
    flush(at, pending)
    return out


def fit_toxicity(documents: DataFrame, labels: DataFrame, learn_from: Column, *, limit: int = LABELLED_ROWS) -> ConvModel | None:
    """Fit on at most `limit` labelled documents. They are read by one bounded query; the rows are few and whole."""
    rows = label_examples(documents.select("doc_id", "text"), labels, "toxic", learn_from, limit, "text")
    # One text per document; at most `limit` of them reach the driver.
    kept = rows.groupBy("doc_id", "_label").agg(F.max("text").alias("text")).toPandas().sort_values("doc_id")
    return train(list(kept["text"]), kept["_label"].to_numpy(dtype=float))


def with_toxicity(df: DataFrame, text: str, name: str, model: ConvModel | None) -> DataFrame:
    """Adds the score of `text`; the model's size is fixed by its parameters, so it is broadcast."""
    held = bound_batches(df.sparkSession).sparkContext.broadcast(model)

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(score_texts(held.value, batch))

    scored.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(name, F.pandas_udf(scored, "double")(text))


def learned_from() -> Column:
    return fold("doc_id", 5) != 0


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that score below 0.5."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learned_from())
    name = unused_name(docs, "_toxicity")
    return with_toxicity(docs, "text", name, model).where(F.col(f"`{name}`") < 0.5).drop(name)
