"""Each operator on odd rows and against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from check_oracle import compare, connect
from pulseline.llm import (
    hilbert, inner_product, packing, piece_codec, pieces, pseudo_likelihood, rules, set_join, sketch, toxicity,
)
from pulseline.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"
DIMENSIONS = ["lang", "source", "n_chars", "doc_id"]
WORD_BPE, PIECES = vocabulary_path("word_bpe_49k.json"), vocabulary_path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op2_inner_product_topk", "op3_jaccard_join"])
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, SF)
    assert ok, note


# 1 sharding


def test_curve_steps_to_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    index = hilbert.hilbert_index(cells, 3)
    assert sorted(index) == list(range(512))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_follow_the_curve_with_near_equal_bytes(spark):
    rows = contract.queries()["op1_hilbert_shards"](spark, SF).toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * rows["size"].max()
    ordered = rows.sort_values(["shard", "slot"])
    assert ordered["curve"].is_monotonic_increasing
    for _, own in ordered.groupby("shard"):
        assert own["slot"].tolist() == list(range(len(own)))


def test_strings_of_one_prefix_have_levels(spark):
    """Ranks against a plain loop: long common prefixes, a value that a third of the rows share, nulls, beyond ASCII."""
    values = [f"https://example.org/dataset/{i % 97:03d}" for i in range(400)]
    values += ["https://example.org/hot"] * 200 + [None] * 30 + ["https://example.org/ü", "https://example.org/😀", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, url string")
    given = sorted((v for v in values if v is not None), key=str.encode)
    firsts = {}
    for v in sorted(set(given), key=str.encode):
        firsts.setdefault(given.index(v) * 15 // len(given), v)
    cuts = hilbert.text_cuts(df, "url", 4)
    assert list(cuts) == sorted(firsts.values(), key=str.encode) and len(cuts) > 8
    levels = hilbert.text_level(pd.Series(values), cuts)
    want = [0 if v is None else sum(c.encode() <= v.encode() for c in cuts) for v in values]
    assert levels.tolist() == want
    placed = hilbert.with_curve_index(df, ["url"], "curve", 4).collect()
    assert [r.curve for r in sorted(placed, key=lambda r: r.doc_id)] == want  # one dimension: the level itself
    assert len(hilbert.text_cuts(df.where("url IS NULL"), "url", 4)) == 0


def test_shards_of_odd_rows(odd, empty):
    rows = hilbert.hilbert_shards(odd, 4, DIMENSIONS).collect()
    assert len(rows) == len(odd.collect())
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (4, 5)} == {(16, 0)}
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert hilbert.hilbert_shards(empty, 4, DIMENSIONS).count() == 0


# 2 inner products


def test_inner_products_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "BLOCK_ROWS", 16)
    monkeypatch.setattr(inner_product, "PIECE_ROWS", 4)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + i % 7) for _ in range(8)]) for i in range(120)]
    rows += [(3, rows[3][1]), (200, None), (300, [1.0, None]), (400, [float("nan")]), (500, []), (None, [1.0] * 8), (600, [2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = inner_product.top_inner_products(df, "id % 20 = 0", 5).collect()
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in whole:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert inner_product.top_inner_products(df.where("false"), "id % 20 = 0", 5).count() == 0


def brute_products(rows, is_query, k):
    """One list per distinct query row; scores cut off at 64 bits."""
    whole = [(i, tuple(max(-(2**63), min(2**63, int(np.floor(1024 * x)))) for x in v)) for i, v in rows]
    want = []
    for i, v in sorted(set(whole)):
        if is_query(i):
            dots = [(j, sum(a * b for a, b in zip(v, w))) for j, w in whole if j != i]
            scores = sorted((-min(max(s, inner_product.LEAST), inner_product.MOST), j) for j, s in dots)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(want)


@pytest.mark.parametrize("size", [1.0, 3e4, 2e8, 1e15, 1e17])
def test_inner_products_of_any_size_and_repeated_queries(spark, monkeypatch, size):
    monkeypatch.setattr(inner_product, "BLOCK_ROWS", 8)
    monkeypatch.setattr(inner_product, "QUERY_ROWS", 2)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-size, size) for _ in range(6)]) for i in range(40)]
    rows += [(10, rows[10][1]), (20, [size] * 6), (20, [-size] * 6), (5, rows[5][1]), (30, [0.0] * 6)]
    rows += [(i, [size * rng.random()] * 6) for i in (100, 101, 101)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = inner_product.top_inner_products(df.selectExpr("*", "1 AS query", "2 AS norm"), "id % 10 = 0", 4)
    assert sorted(map(tuple, got.collect())) == brute_products(rows, lambda i: i % 10 == 0, 4)


def test_blocks_that_cannot_reach_a_floor_are_not_sent(spark):
    asked = spark.createDataFrame(
        [(0, 7, [1.0], 1.0, 50.0), (1, 8, [2.0], 2.0, 50.0), (2, 9, [1.0], 1.0, float("-inf")), (3, 4, [0.0], 0.0, 0.0)],
        "query long, id long, v array<double>, norm double, floor double",
    )
    blocks = spark.createDataFrame([(i, 100.0 / 2**i) for i in range(6)], "block long, norm double")
    queries, needed = inner_product.reached(asked, blocks)
    assert {r["query"]: r["until"] for r in queries.collect()} == {0: 1, 1: 2, 2: 5, 3: 5}
    assert {r["block"]: r["up_to"] for r in needed.collect()} == {i: 0 for i in range(1, 6)}


# 3 near duplicates


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = t.encode().lower().split() if t else []
        n = min(5, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low = min(label[a], label[b])
                label[a] = label[b] = low
                changed = True
    return {i: (len(s), label[i]) for i, s in sets.items()}


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    """A large group of near copies around the limit, with few pivots, so that all ways to a link are taken."""
    monkeypatch.setattr(set_join, "PIVOTS", 2)
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    texts = []
    for i in range(70):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(own)))
    texts += [(100 + i, " ".join(f"y{rng.randrange(60)}" for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r[0]: (r[1], r[2]) for r in set_join.near_duplicates(df).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = {r[0]: (r[1], r[2]) for r in set_join.near_duplicates(odd).collect()}
    want = brute_components([(i, t) for i, t in TEXT_BY_ID.items()])
    assert got.pop(None)[1] is None
    assert got == want
    assert set_join.near_duplicates(empty).count() == 0


def test_folded_bitmaps_refuse_no_link(spark):
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1030, dtype=np.uint64))
    b = a[: int(len(a) * 0.9)]
    rows = [(1, set_join.bitmap(a).tolist()), (2, set_join.bitmap(b).tolist())]
    assert len(rows[0][1]) == 2 * len(rows[1][1])
    bits = spark.createDataFrame(rows, "c long, bits array<long>")
    pairs = spark.createDataFrame([(1, 2, len(a), len(b)), (2, 1, len(b), len(a))], "a long, b long, na int, nb int")
    assert set_join.not_refused(pairs, bits).count() == 2


# 4 and 7 classifiers


@pytest.mark.parametrize("name, label", [("op4_rule_ensemble", "quality"), ("op7_conv_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.1"
    scored = contract.queries()[name](spark, sf).where("held_out")
    joined = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right > 0.97


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)], "doc_id bigint, quality int, toxic int")
    for df in (odd, empty):
        quality = rules.fit_quality(df, labels, F.lit(True))
        toxic = toxicity.fit_toxicity(df, labels, F.lit(True))
        both = toxicity.with_toxicity(rules.with_quality(df, "text", "q", quality), "text", "t", toxic)
        rows = both.collect()
        assert len(rows) == df.count()
        assert all(0 <= r["q"] <= 1 and 0 <= r["t"] <= 1 for r in rows)
        assert set(both.columns) == {*df.columns, "q", "t"}
    none = toxicity.with_toxicity(odd, "text", "t", toxicity.fit_toxicity(odd, labels.where("false"), F.lit(True)))
    assert {r["t"] for r in none.collect()} == {0.0}


# 5 packing


def test_windows_hold_every_id_once(spark, odd, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = packing.packed(odd, WORD_BPE).collect()
    by_document, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    for window in by_window.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
        assert at <= 2048
    for i, t in TEXT_BY_ID.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = {r["start"]: r for r in by_document[i]}
        assert sum(r["length"] for r in own.values()) == len(ids)
        for start, r in own.items():
            part = np.array(ids[start : start + r["length"]], "<u4")
            assert (zlib.crc32(part.tobytes()), len(ids)) == (r["ids_crc32"], r["doc_tokens"])
    assert packing.packed(empty, WORD_BPE).count() == 0


def test_differencing_balances_and_windows_rise():
    assert sorted(sum([4, 5, 6, 7, 8][i] for i in w) for w in packing.difference([4, 5, 6, 7, 8], 2)) == [14, 16]
    rng = random.Random(2)
    lengths = [rng.randrange(1, 513) for _ in range(300)]
    windows = packing.pack(lengths, 2048)
    assert sorted(i for w in windows for i in w) == list(range(300))
    assert max(sum(lengths[i] for i in w) for w in windows) <= 2048
    assert len(windows) <= -(-sum(lengths) // 2048) + 2
    assert len(packing.pack([1500, 1500, 1000], 2048)) == 3


# 6 scoring


def test_pseudo_likelihood_prefers_the_corpus(spark, odd, empty):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = pseudo_likelihood.fit_network(documents)
    rows = pseudo_likelihood.with_pseudo_likelihood(odd, "text", "s", model).collect()
    assert all((r["s"]["tokens"], r["s"]["log_likelihood"]) == (0, 0.0) for r in rows if not (r["text"] or "").split())
    row, at = pseudo_likelihood.framed([np.array([1, 2, 3], np.int32)])
    logs = pseudo_likelihood.log_probabilities(model[1], row, at)
    every = [pseudo_likelihood.log_probabilities(model[1], *masked(row, at[1], t)) for t in range(pseudo_likelihood.VOCABULARY)]
    assert np.isclose(np.exp([e[1] for e in every]).sum(), 1, atol=1e-3)
    assert np.isfinite(logs).all()
    assert pseudo_likelihood.fit_network(empty)[0] == []


def masked(row, place, token):
    other = row.copy()
    other[place] = token
    return other, np.flatnonzero(other != pseudo_likelihood.OUTSIDE)


# 8 and 10 pieces


def test_pieces_equal_a_unigram_tokenizer_and_decode_back(odd, empty):
    import sentencepiece
    from tokenizers.models import Unigram

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    unigram = Unigram(vocab=vocabulary, unk_id=0, byte_fallback=True)
    coded = piece_codec.with_piece_ids(odd, "text", "ids", PIECES)
    coded = piece_codec.with_token_count(piece_codec.with_piece_text(coded, "ids", "back", PIECES), "text", "n", PIECES)
    for r in coded.collect():
        if r["text"] is None:
            assert (r["ids"], r["back"], r["n"]) == (None, None, None)
            continue
        want = [t.id for t in unigram.tokenize(pieces.normalise(r["text"]))] if r["text"] else []
        assert (r["ids"], r["n"], r["back"]) == (want, len(want), r["text"])
    assert piece_codec.with_token_count(empty, "text", "n", PIECES).count() == 0


# 9 fingerprints


def brute_sketch(spark, text, k):
    import xxhash

    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if len(words) < 5:
        return None if words else []

    def chained(shingle):
        seed = 42
        for w in shingle:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        return seed - (1 << 64) if seed >= 1 << 63 else seed

    return sorted({chained(words[i : i + 5]) for i in range(len(words) - 4)})[:k]


def test_fingerprints_match_brute_force(spark, odd, empty):
    rows = {r["doc_id"]: r for r in sketch.fingerprints(odd).collect()}
    order = sorted(TEXT_BY_ID, reverse=True)
    assert set(rows) - {None} == set(order)  # the row without an id has a test of its own
    for i, j in zip(order, order[1:] + order[:1]):
        own, other = TEXT_BY_ID[i] or "", TEXT_BY_ID[j] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        r = rows[i]
        assert (r["n_chars"], r["edited"]) == (len(own), edited)
        for text, got in ((own, r["sketch"]), (edited, r["edited_sketch"])):
            want = brute_sketch(spark, text, sketch.K)
            assert len(got) == 1 if want is None else got == want
        a, b = set(r["sketch"]), set(r["edited_sketch"])
        union = sorted(a | b)[: sketch.K]
        assert r["near_edited"] == (len(set(union) & a & b) / len(union) if union else 1.0)
    assert sketch.fingerprints(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest()  # the digest column is Spark's own sha2


def test_every_row_has_a_fingerprint(spark):
    """Rows of one id and rows without one; the greatest text of an id is the next document."""
    text = " ".join(f"w{i}" for i in range(40))
    made = [(5, text), (5, "b c"), (5, "b c"), (3, "a b c d e f"), (None, text), (None, None), (9, ""), (2**60 + 1, text)]
    df = spark.createDataFrame(made, "doc_id bigint, text string").selectExpr("*", "1 AS _key", "2 AS sketch")
    got = sketch.fingerprints(df).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted((str(i), len(t or "")) for i, t in made)
    heads = {2**60 + 1: text, 9: "", 5: text, 3: "a b c d e f"}
    order = sorted(heads, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    for r in got:
        if r["doc_id"] is None:
            assert (r["edited"], r["edited_sketch"], r["near_edited"], r["near_next"]) == (None,) * 4
        else:
            edits = {t[: len(t) - len(t) // 2] + heads[following[i]][: len(t) // 2] for i, t in made if i == r["doc_id"]}
            assert r["edited"] in edits
    whole = [r for r in got if r["n_chars"] == len(text)]
    assert len(whole) == 3 and len({tuple(r["sketch"]) for r in whole}) == 1
    assert next(r for r in got if r["doc_id"] == 9)["near_next"] == 0.0


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF).toPandas()
        assert list(kept.columns) == docs.columns
        assert kept["doc_id"].is_unique and set(kept["doc_id"]) <= {r[0] for r in docs.select("doc_id").collect()}
        if name == "near_duplicates":
            groups = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
            assert set(kept["doc_id"]) == {label for _, label in groups.values()}
        docs = spark.createDataFrame(kept, docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    assert contract.queries()["pipeline"](spark, SF).count() > 0


from llm_rows import TEXTS  # noqa: E402

TEXT_BY_ID = {i: t for i, t in TEXTS if i is not None}


def test_round_trip_column_equals_the_two_columns(spark):
    from pulseline.llm import piece_codec
    from pulseline.llm.queries import vocabulary_path

    path = vocabulary_path("piece_bpe_32k.model")
    texts = [None, "", "a ⁇ ☃ \U0001F600 x  y\n\nz", "plain words " * 2000] + ["again"] * 1200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    two = piece_codec.with_piece_text(piece_codec.with_piece_ids(docs, "text", "ids", path), "ids", "decoded", path)
    one = piece_codec.with_round_trip(docs, "text", "coded", path)
    one = one.selectExpr("doc_id", "text", "coded.ids AS ids", "coded.text AS decoded")
    assert two.exceptAll(one).count() == one.exceptAll(two).count() == 0
    assert one.where("NOT decoded <=> text").count() == 0
