"""Scores of documents by masked pseudo-likelihood under a small bidirectional window network.

Every token is predicted from the tokens on both sides of it, never from itself; a document's score is the sum of the
log probabilities of all its tokens. Tokens are lower-cased words: the most frequent ones of the whole corpus by
themselves, all others by hash bucket. The network adds up one embedding per neighbour and place, applies tanh, and
predicts the token's class and then the token within the class.

The network is trained on every text of the corpus: each partition trains a copy in numpy on all of its tokens, and the
copies are averaged by their numbers of tokens in an ordinary aggregation, so neither texts nor copies meet in one
place. Words are counted over all texts as well. Every word with at least OWN_COUNT occurrences has a row of the network
by itself, and the FREQUENT most frequent ones in any case. The others share rows by hash bucket, and the word within its
bucket is predicted from the counts of all words, which stay a Spark table and are joined on the distinct words of each
batch of texts: P(word | bucket) = (n + (D + 1) G) / (N + D + 1), where n counts the word, N the tokens and D the distinct
words of the bucket. G = 256^-(octets + 1) spells the word out octet by octet with an end mark, so words never counted
have a probability too and all words of a bucket sum up to at most 1.

Defined results: null, empty and wordless texts have no tokens, score 0.0 and no mean. Places outside of a text have a
token of their own as context. An empty corpus leaves the network as it started. Repeated rows count each time; other
columns are not read and stay as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import bound_batches

CLASSES = 32
FREQUENT = 768
HASHED = 256  # at least
#: Words of at least so many occurrences have a row of the network by themselves.
OWN_COUNT = 10_000
SIDE = 2  # neighbours on each side
HIDDEN = 16
BATCH = 16_384
STEP = 0.08
#: Rows of logits worked on at a time, which a core's cache holds.
BLOCK = 2_048
#: Tokens read before a task trains on them, and bytes of words counted before it adds them up and hands them on.
HELD_TOKENS, HELD_BYTES = 16 * BATCH, 32 << 20
#: Bytes of rows scored together (the longest row alone may be more); their distinct words are joined once.
CHUNK_BYTES = 8 << 20
#: Logits up to this size need no shift: float32 holds their exponentials and all ratios of them.
STEEP = 40

VOCABULARY = FREQUENT + HASHED  # of a small corpus
OUTSIDE = VOCABULARY
PLACES = [o for o in range(-SIDE, SIDE + 1) if o]


def sizes(own: int) -> tuple[int, int]:
    """Classes and ids of a network with `own` words by themselves; both grow with it, so a token costs about a root."""
    classes = max(CLASSES, round((own + HASHED) ** 0.5))
    return classes, classes * -(-(max(own, FREQUENT) + HASHED) // classes)


def shapes(own: int) -> dict[str, tuple[int, ...]]:
    classes, vocabulary = sizes(own)
    inside = vocabulary // classes
    return {
        "embed": (len(PLACES), vocabulary + 1, HIDDEN),
        "hidden": (HIDDEN,),
        "to_class": (HIDDEN, classes),
        "class_bias": (classes,),
        "to_word": (classes, HIDDEN, inside),
        "word_bias": (classes, inside),
    }


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch of texts, the one at each place of all texts in a row, and the words of each text."""
    low = pa.array([t.lower().strip() or None if t else None for t in texts.to_pylist()], pa.string())
    split = pc.utf8_split_whitespace(low)
    coded = split.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), pc.fill_null(pc.list_value_length(split), 0).to_numpy()


class TokenIds:
    """Ids of words: by rank for those with a row by themselves, by hash bucket for the others."""

    def __init__(self, frequent: list[str]):
        self.rank = pa.array(frequent, pa.string())
        self.own = max(FREQUENT, len(frequent))
        self.buckets = sizes(len(frequent))[1] - self.own

    def of(self, words: pa.Array | list[str]) -> np.ndarray:
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.string())
        out = pc.fill_null(pc.index_in(words, value_set=self.rank), -1).to_numpy().astype(np.int32)
        shared = np.flatnonzero(out < 0)
        octets = words.take(pa.array(shared)).cast(pa.binary()).to_numpy(zero_copy_only=False)
        out[shared] = self.own + np.fromiter(map(zlib.crc32, octets), np.int64, len(shared)) % self.buckets
        return out


def initial(own: int = 0, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {n: rng.normal(0, 0.05, s).astype(np.float32) for n, s in shapes(own).items()}


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in net.values()])


def shaped(values: np.ndarray, own: int = 0) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(own).items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def framed(texts: list[np.ndarray], outside: int = OUTSIDE) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row with SIDE outside marks around each text, and the positions of the real tokens."""
    return framed_row(np.concatenate(texts), np.array([len(ids) for ids in texts]), outside)


def framed_row(ids: np.ndarray, lengths: np.ndarray, outside: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts that lie behind each other already."""
    at = np.arange(len(ids)) + np.repeat(SIDE * np.arange(1, len(lengths) + 1), lengths)
    row = np.full(len(ids) + SIDE * (len(lengths) + 1), outside, np.int32)
    row[at] = ids
    return row, at


def outside(net: dict) -> int:
    return net["embed"].shape[1] - 1


def hidden(net: dict, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = net["embed"][0].take(row[at + PLACES[0]], axis=0)
    total += net["hidden"]
    for j, o in enumerate(PLACES[1:], 1):
        total += net["embed"][j].take(row[at + o], axis=0)
    return np.tanh(total, out=total)


def forward(net: dict, row: np.ndarray, at: np.ndarray):
    """Hidden values and class probabilities."""
    h, steep = hidden(net, row, at), steepest(net)
    classes = np.empty((len(h), len(net["class_bias"])), h.dtype)
    for first in range(0, len(h), BLOCK):
        part = classes[first : first + BLOCK]
        np.matmul(h[first : first + BLOCK], net["to_class"], out=part)
        part += net["class_bias"]
        softmax(part, steep)
    return h, classes


def steepest(net: dict) -> float:
    """The size that no logit exceeds, since hidden values lie in [-1, 1]."""
    layers = ("to_class", "class_bias"), ("to_word", "word_bias")
    return max(float((np.abs(net[w]).sum(axis=-2) + np.abs(net[b])).max()) for w, b in layers)


def softmax(logits: np.ndarray, steep: float) -> np.ndarray:
    """In place; rows of a steep network are shifted by their own maximum, others need no shift."""
    if steep > STEEP:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= (1 / (logits @ np.ones(logits.shape[1], logits.dtype)))[:, None]
    return logits


def log_softmax(logits: np.ndarray, place: np.ndarray, steep: float) -> np.ndarray:
    """Logarithm of the softmax at one place of each row; the logits are used up."""
    if steep > STEEP:
        logits -= logits.max(axis=1, keepdims=True)
    found = logits[np.arange(len(place)), place]
    np.exp(logits, out=logits)
    return found - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def in_order(ids: np.ndarray, below: int) -> np.ndarray:
    """Stable order of ids; sixteen bits sort by radix."""
    return np.argsort(ids.astype(np.int16) if below < 1 << 15 else ids, kind="stable")


def by_class(classes: np.ndarray, count: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order of tokens by class, and where each class that has any lies in it."""
    order = in_order(classes, count)
    ends = np.searchsorted(classes[order], np.arange(count + 1))
    return order, [(c, slice(ends[c], ends[c + 1])) for c in range(count) if ends[c] < ends[c + 1]]


def log_probabilities(net: dict, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of each token from its neighbours."""
    token, (count, inside), steep = row[at], net["word_bias"].shape, steepest(net)
    order, runs = by_class(token // inside, count)
    token, h = token[order], hidden(net, row, at[order])
    of_class, place, found = token // inside, token % inside, np.empty(len(at), h.dtype)
    for first in range(0, len(h), BLOCK):
        part = slice(first, first + BLOCK)
        found[part] = log_softmax(h[part] @ net["to_class"] + net["class_bias"], of_class[part], steep)
    for c, who in runs:
        found[who] += log_softmax(h[who] @ net["to_word"][c] + net["word_bias"][c], place[who], steep)
    out = np.empty_like(found)
    out[order] = found
    return out


class Trainer:
    """Adagrad on batches of tokens."""

    def __init__(self, net: dict[str, np.ndarray]):
        self.net = {n: v.copy() for n, v in net.items()}
        self.squares = {n: np.full(v.shape, 1e-4, np.float32) for n, v in net.items()}

    def update(self, name: str, grad: np.ndarray, where=...) -> None:
        squares = self.squares[name][where] + grad * grad
        self.squares[name][where] = squares
        self.net[name][where] -= STEP * grad / np.sqrt(squares)

    def learn(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Steps of nearly equal numbers of tokens, BATCH at most, over texts that lie behind each other."""
        if len(ids):
            row, at = framed_row(ids, lengths, outside(self.net))
            for part in np.array_split(at, -(-len(at) // BATCH)):
                self.step(row, part)

    def step(self, row: np.ndarray, at: np.ndarray) -> None:
        net, scale = self.net, np.float32(1 / np.sqrt(len(at)))
        count, inside = net["word_bias"].shape
        low = at.min() - SIDE
        near = row[low : at.max() + SIDE + 1]
        # Tokens are worked on in the order of their classes, so each class is one slice.
        order, runs = by_class(row[at] // inside, count)
        at = at[order]
        token, every, ones = row[at], np.arange(len(at)), np.ones(len(at), np.float32)
        place, steep = token % inside, steepest(net)
        h, wrong = forward(net, row, at)
        wrong[every, token // inside] -= 1
        down = wrong @ net["to_class"].T
        grads = {n: np.zeros_like(net[n]) for n in ("to_word", "word_bias")}
        for c, who in runs:
            own, n = h[who], who.stop - who.start
            miss = softmax(own @ net["to_word"][c] + net["word_bias"][c], steep)
            miss[every[:n], place[who]] -= 1
            down[who] += miss @ net["to_word"][c].T
            grads["to_word"][c], grads["word_bias"][c] = own.T @ miss, ones[:n] @ miss
        down *= 1 - h * h
        grads |= {"to_class": h.T @ wrong, "class_bias": ones @ wrong, "hidden": ones @ down}
        for name, grad in grads.items():
            self.update(name, grad * scale)
        # A neighbour learns from the tokens around it; one order of all neighbours serves every place.
        around = np.zeros((len(near) + 2 * SIDE, HIDDEN), np.float32)
        around[at - low + SIDE] = down * scale
        order = in_order(near, net["embed"].shape[1])
        first = np.flatnonzero(np.r_[True, np.diff(near[order]) != 0])
        met = near[order[first]]
        for j, o in enumerate(PLACES):
            self.update("embed", np.add.reduceat(around.take(order + (SIDE - o), axis=0), first, axis=0), (j, met))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; a task adds up what it reads before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            words, index, _ = distinct_words(batch.column(0))
            held.append(pa.table({"word": words, "n": np.bincount(index, minlength=len(words))}))
            size += held[-1].nbytes
            if size >= HELD_BYTES:
                yield from added_up(held)
                held, size = [], 0
        if held:
            yield from added_up(held)

    counts = texts.mapInArrow(counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def added_up(counts: list[pa.Table]) -> list[pa.RecordBatch]:
    both = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return both.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches(max_chunksize=1 << 16)


def fit_network(documents: DataFrame, text: str = "text", own_count: int = OWN_COUNT) -> tuple:
    """(words with a row by themselves, averaged network, counts of all words as a table, tokens and words by bucket)."""
    bound_batches(documents.sparkSession)
    texts = documents.select(F.col(text).alias("text"))
    words = cut_lineage(word_counts(texts))
    first = [F.desc("n"), F.col("word")]
    top = words.orderBy(*first).limit(FREQUENT).collect()
    if len(top) == FREQUENT and top[-1]["n"] >= own_count:
        top = words.where(F.col("n") >= own_count).orderBy(*first).collect()
    frequent = [r["word"] for r in top]
    totals = bucket_totals(words, frequent, top[-1]["n"]) if top else np.zeros((2, TokenIds([]).buckets))
    start = documents.sparkSession.sparkContext.broadcast((frequent, initial(len(frequent))))

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, net = start.value
        ids, trainer, tokens, waiting, held = TokenIds(frequent), Trainer(net), 0, [], 0
        for batch in batches:
            words, index, lengths = distinct_words(batch.column(0))
            waiting.append((ids.of(words)[index], lengths))
            held, tokens = held + len(index), tokens + len(index)
            if held >= HELD_TOKENS:
                trainer.learn(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, held = [], 0
        if held:
            trainer.learn(*map(np.concatenate, zip(*waiting, strict=True)))
        if tokens:
            # Averages weigh each copy by its tokens; sums of both reach the reducers.
            net = flat(trainer.net)
            copy = pa.ListArray.from_arrays(pa.array([0, len(net)], pa.int32()), pa.array(net))
            yield pa.RecordBatch.from_arrays([pa.array([float(tokens)]), copy], ["tokens", "net"])

    copies = texts.mapInArrow(trained, "tokens double, net array<float>")
    sums = copies.select("tokens", F.posexplode("net").alias("at", "x")).groupBy("at")
    mean = sums.agg((F.sum(F.col("tokens") * F.col("x")) / F.sum("tokens")).cast("float").alias("x"))
    rows = mean.orderBy("at").toPandas()
    net = shaped(rows["x"].to_numpy(), len(frequent)) if len(rows) else start.value[1]
    return frequent, net, words, totals


def bucket_totals(words: DataFrame, frequent: list[str], least: int) -> np.ndarray:
    """Tokens and distinct words of each bucket, without the words that have a row by themselves."""
    buckets = TokenIds(frequent).buckets
    # Own words are the first ones by (n descending, word).
    last = F.lit(frequent[-1])
    shared = words.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > last)))
    bucket = F.crc32(F.col("word").cast("binary")) % buckets
    out = np.zeros((2, buckets))
    for r in shared.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect():
        out[:, r["b"]] = r["n"], r["d"]
    return out


def with_pseudo_likelihood(df: DataFrame, text: str, name: str, model: tuple, keep: list[str] | None = None) -> DataFrame:
    """Adds struct(log_likelihood, tokens) of `text` under a fitted model to the columns `keep`, or to all columns.

    Each chunk of texts is scored by the network and hands on its distinct words without a row by themselves, each with
    the places of its texts. These are joined with the word counts, and go back to their chunk, where texts add them up.
    """
    frequent, net, words, totals = model
    spark = bound_batches(df.sparkSession)
    held = spark.sparkContext.broadcast((frequent, net, totals))
    keep = [c for c in (keep or df.columns) if c.lower() != name.lower()]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").alias("text"))
    kept_type = T.StructField("kept", rows.schema["kept"].dataType)
    parts = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("word", T.StringType()),
        T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("bucket", T.IntegerType()),
        T.StructField("log", T.DoubleType()), T.StructField("tokens", T.LongType()), kept_type,
    ])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, net, _ = held.value
        ids, chunk = TokenIds(frequent), TaskContext.get().partitionId() << 32
        for batch in in_chunks(batches):
            kept, n = batch.column("kept"), len(batch)
            words, index, lengths = distinct_words(batch.column("text"))
            own = ids.of(words)
            sums = network_sums(net, own[index], lengths)
            # Rows of texts have keys that are no words, so that they spread over the join and match nothing.
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, chunk)), pa.array([f"\n{chunk} {i}" for i in range(n)], pa.string()),
                lists(np.arange(n + 1), np.arange(n)), pa.nulls(n, pa.int32()), pa.array(sums),
                pa.array(lengths, pa.int64()), kept,
            ], parts.names)
            shared = np.flatnonzero(own >= ids.own)
            m = len(shared)
            if m:
                met = words.take(pa.array(shared))
                number = np.full(len(words), -1, np.int64)
                number[shared] = np.arange(m)
                # The texts of each word, in the order of the words: numbers of both in one.
                both = number[index] << 32 | np.repeat(np.arange(n), lengths)
                both = np.sort(both[both >= 0])
                ends = np.searchsorted(both, np.arange(m + 1) << 32)
                octets = pc.binary_length(met).to_numpy().astype(float)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m, chunk)), met, lists(ends, both & 0xFFFFFFFF),
                    pa.array(own[shared] - ids.own, pa.int32()), pa.array(-(octets + 1) * np.log(256)),
                    pa.nulls(m, pa.int64()), pa.nulls(m, kept.type),
                ], parts.names)
            chunk += 1

    def summed(table: pa.Table) -> pa.Table:
        tokens, distinct = held.value[2]
        is_text = pc.is_valid(table["tokens"])
        texts, met = table.filter(is_text), table.filter(pc.invert(is_text))
        bucket, spelled = met["bucket"].to_numpy(), met["log"].to_numpy()
        seen = np.log(np.maximum(pc.fill_null(met["n"], 0).to_numpy(), 1e-300))
        bucket = bucket.astype(np.int64)
        share = np.logaddexp(seen, np.log(distinct[bucket] + 1) + spelled) - np.log(tokens[bucket] + distinct[bucket] + 1)
        lengths = pc.list_value_length(met["places"]).to_numpy()
        place = pc.list_flatten(met["places"]).to_numpy()
        sums = np.bincount(place.astype(np.int64), np.repeat(share, lengths), minlength=len(texts))
        logs = texts["log"].to_numpy() + sums[pc.list_flatten(texts["places"]).to_numpy()]
        return pa.table({"kept": texts["kept"], "log_likelihood": logs, "tokens": texts["tokens"]})

    both = rows.mapInArrow(scored, parts)
    joined = both.join(words.hint("shuffle_hash"), "word", "left").drop("word")
    result = T.StructType([kept_type, T.StructField("log_likelihood", T.DoubleType()), T.StructField("tokens", T.LongType())])
    out = joined.groupBy("chunk").applyInArrow(summed, result)
    return out.select("kept.*", F.struct("log_likelihood", "tokens").alias(name))


def in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to CHUNK_BYTES; the larger a chunk, the more of its words are met again in it."""
    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def network_sums(net: dict, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Summed log probabilities of ids by the network, for each of the texts that lie behind each other."""
    row, at = framed_row(ids, lengths, outside(net))
    logs = np.empty(len(at))
    for first in range(0, len(at), BATCH):
        logs[first : first + BATCH] = log_probabilities(net, row, at[first : first + BATCH])
    # Counts of no places at all would be integers.
    return np.bincount(np.repeat(np.arange(len(lengths)), lengths), logs, minlength=len(lengths)).astype(float)
