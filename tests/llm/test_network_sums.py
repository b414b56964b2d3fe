"""Words, training and scores of the window network against plain loops."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulseline.llm import pseudo_likelihood as p

SF = "/root/testdata/sf0.001"


def plain_logs(net, row, at):
    """Log probabilities by one token at a time, in doubles."""
    net = {n: v.astype(float) for n, v in net.items()}
    inside = net["word_bias"].shape[1]
    out = []
    for i in at:
        h = np.tanh(net["hidden"] + sum(net["embed"][j][row[i + o]] for j, o in enumerate(p.PLACES)))
        c, w = divmod(row[i], inside)
        logits = (h @ net["to_class"] + net["class_bias"], c), (h @ net["to_word"][c] + net["word_bias"][c], w)
        out.append(sum(x[k] - np.logaddexp.reduce(x) for x, k in logits))
    return np.array(out)


def some_tokens(texts=9, words=40):
    rng = np.random.default_rng(7)
    return p.framed([rng.integers(0, p.VOCABULARY, words).astype(np.int32) for _ in range(texts)])


@pytest.mark.parametrize("factor", [1, 30, 3000])
def test_probabilities_of_steep_networks_are_exact(factor):
    """Once one shift served all rows and a floor was added, so what lay far below the maximum of the batch was wrong."""
    net = {n: v * (factor if n.startswith("to_") else 1) for n, v in p.initial().items()}
    net["class_bias"][3] = factor / 10
    row, at = some_tokens()
    logs = p.log_probabilities(net, row, at)
    assert np.allclose(logs, plain_logs(net, row, at), rtol=1e-4, atol=1e-4)


def test_steps_are_nearly_equal(monkeypatch):
    """Once a full step was followed by one on the few tokens left over."""
    sizes = []
    monkeypatch.setattr(p, "BATCH", 100)
    monkeypatch.setattr(p.Trainer, "step", lambda self, row, at: sizes.append(len(at)))
    lengths = np.array([30, 0, 55, 17, 1, 98])
    p.Trainer(p.initial()).learn(np.arange(lengths.sum(), dtype=np.int32), lengths)
    assert sum(sizes) == lengths.sum() and max(sizes) <= 100 and max(sizes) - min(sizes) <= 1


def test_a_step_follows_the_gradient():
    """Gradients read off Adagrad's sums of squares, against differences of plain log probabilities."""
    net, (row, at) = p.initial(), some_tokens(2, 15)
    at = at[4:21]
    trainer = p.Trainer(net)
    before = {n: v.copy() for n, v in trainer.squares.items()}
    trainer.step(row, at)
    rng = np.random.default_rng(1)
    for name, values in net.items():
        moved = np.flatnonzero(trainer.net[name] != values)
        unmoved = np.setdiff1d(np.arange(values.size), moved)
        for k in [*rng.choice(moved, 6), *rng.choice(unmoved, min(2, len(unmoved)))]:
            sides = []
            for sign in (1, -1):
                other = {n: v.astype(float) for n, v in net.items()}
                other[name].flat[k] += sign * 1e-4
                sides.append(plain_logs(other, row, at).sum())
            slope = (sides[0] - sides[1]) / 2e-4 / np.sqrt(len(at))
            step = trainer.net[name].flat[k] - values.flat[k]
            assert np.isclose(step, p.STEP * slope / np.sqrt(before[name].flat[k] + slope**2), rtol=2e-2, atol=2e-4)


def test_distinct_words_are_those_of_python():
    spaces = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    texts = [None, "", " \n", "ΑΣ ΑΣ. İx ẞ", "a\x00b  A\x00B", *[f"{s}Tail{s}{s}of{s}tail" for s in spaces], "é é 日本 🙂"]
    words, index, lengths = p.distinct_words(pa.array(texts, pa.string()))
    split = [(t or "").lower().split() for t in texts]
    words = words.to_pylist()
    assert [words[i] for i in index] == [w for s in split for w in s]
    assert lengths.tolist() == [len(s) for s in split] and len(set(words)) == len(words)
    nothing, index, lengths = p.distinct_words(pa.array([None, " "], pa.string()))
    assert (len(nothing), len(index), lengths.tolist()) == (0, 0, [0, 0])


def test_scores_equal_plain_sums(spark, odd):
    """Every text of sf0.001 and the odd ones: the network token by token, and counts of all words for the buckets."""
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("text").unionByName(odd.select("text"))
    frequent, net, words, totals = model = p.fit_network(texts)
    every = [r["text"] for r in texts.collect()]
    counts = Counter(w for t in every for w in (t or "").lower().split())
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    ids = p.TokenIds(frequent)
    buckets = {w: int(i) - ids.own for w, i in zip(counts, ids.of(list(counts)), strict=True) if i >= ids.own}
    sums = np.zeros((2, ids.buckets))
    for w, b in buckets.items():
        sums[:, b] += counts[w], 1
    assert (sums == totals).all()
    found = Counter()
    for r in p.with_pseudo_likelihood(texts, "text", "s", model).collect():
        found[r["text"], r["s"]["tokens"], round(r["s"]["log_likelihood"], 1)] += 1
    assert sum(found.values()) == len(every)
    scores = {t: (n, score) for t, n, score in found}
    assert len(scores) == len(found)
    for text in [*every[:40], *every[-13:]]:
        split = (text or "").lower().split()[:2000]
        if len(split) < 2000:
            row, at = p.framed([ids.of(split)])
            want = plain_logs(net, row, at).sum()
            for w in split:
                if w in buckets:
                    n, d = sums[:, buckets[w]]
                    spelled = (d + 1) * 256.0 ** -(len(w.encode()) + 1)
                    want += np.log((counts[w] + spelled) / (n + d + 1))
            n, score = scores[text]
            assert n == len(split) and abs(score - want) <= 0.06 + 1e-4 * abs(want)


def test_chunks_hold_every_row_and_share_words(spark, odd, monkeypatch):
    """Small batches are put together, so a word that many of them hold is joined once; scores stay what they are."""
    monkeypatch.setattr(p, "CHUNK_BYTES", 1000)
    batches = [pa.record_batch({"i": pa.array(range(k, k + n))}) for k, n in ((0, 40), (40, 0), (40, 90), (130, 1), (131, 7))]
    chunks = list(p.in_chunks(iter(batches)))
    assert [len(c) for c in chunks] == [130, 8] and sum([c["i"].to_pylist() for c in chunks], []) == list(range(138))
    assert list(p.in_chunks(iter(batches[1:2]))) == []
    monkeypatch.undo()
    texts = odd.select("text").coalesce(1)
    model = p.fit_network(texts)
    size, found = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(size)
    try:
        for rows in ("2", "10000"):
            spark.conf.set(size, rows)
            scored = p.with_pseudo_likelihood(texts, "text", "s", model)
            found.append(sorted((r["text"] or "", r["s"]["tokens"], r["s"]["log_likelihood"]) for r in scored.collect()))
    finally:
        spark.conf.set(size, before)
    assert len(found[0]) == texts.count() == len(found[1])
    for small, large in zip(*found, strict=True):
        assert small[:2] == large[:2] and np.isclose(small[2], large[2], rtol=1e-6)
