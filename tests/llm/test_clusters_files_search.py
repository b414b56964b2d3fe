"""Operators 11 to 13 and the batch-wise tokeniser, against brute force."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import LONG, TEXTS
from pyspark.sql import functions as F

import __spark_entry__ as contract
from check_oracle import compare, connect
from pulseline.llm import id_planes, packing, shallot, shared_terms, word_ids
from pulseline.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"
WORD_BPE = vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


def ids_by_library(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids if text else []


# ids of whole texts

HARD = [
    "'s's''s", "a's", "it's", "'start", "''s", "!'s", "x'rex", "'ll'l", "É'S", "Ünï ÀÉÎ ×÷ x×y", "ﬁ ß ẞ", "a<|endoftext|>b",
    "<|EndOfText|> A<|B", "x<", "|y", "12a3 4.5", "a\x00b\x1cc\x7f", "\tA\x0bB\x0cC D", "日本語 テスト é́", "🙂!?“Q”—…", None, "",
    "  ", "İ ΣΑΣ", "a\u0085b", "r've'D", "'S'T'RE",
]


@pytest.mark.parametrize("block", [50, word_ids.BLOCK_BYTES])
def test_ids_equal_the_library(tokenizer, monkeypatch, block):
    monkeypatch.setattr(word_ids.blocks, "__defaults__", (block,))
    monkeypatch.setattr(word_ids, "REMEMBERED", 5000)
    rng = random.Random(1)
    alphabet = "aAzZ09'!<|> \n\tsStTrReEvVlLdDmMéÉß×́日 .-_"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(1500)]
    ids, cuts = word_ids.WordIds(WORD_BPE).of(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, cuts, cuts[1:]):
        assert ids[a:b].tolist() == ids_by_library(tokenizer, text), text


def test_ids_of_all_texts_equal_the_library(spark, tokenizer):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = defaultdict(list)
    for r in packing.cut_pieces(spark.createDataFrame(rows, "doc_id long, text string"), WORD_BPE).collect():
        found[r["doc_id"]].append(r)
    assert len(found) == len(rows)
    for r in rows:
        own = sorted(found[r["doc_id"]], key=lambda p: p["start"])
        ids = np.array(ids_by_library(tokenizer, r["text"]) + [packing.CLOSING_ID], "<u4")
        assert [p["start"] for p in own] == np.cumsum([0] + [p["length"] for p in own])[:-1].tolist()
        for p in own:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert (p["ids_crc32"], p["doc_tokens"], p["length"]) == (zlib.crc32(part.tobytes()), len(ids), len(part))


def test_a_text_of_many_megabytes(tokenizer):
    text = "é".join(LONG + " " for _ in range(60))
    assert len(text.encode()) > word_ids.BLOCK_BYTES
    ids, _ = word_ids.WordIds(WORD_BPE).of(pa.array(["a", text, None]))
    assert ids.tolist() == ids_by_library(tokenizer, "a") + ids_by_library(tokenizer, text)


# 11 clusters


def brute_clusters(vectors, count, rounds):
    """vectors: (id, list of whole numbers); plain Lloyd rounds in Python numbers."""
    digest = {i: hashlib.sha256(f"1:{i}".encode()).hexdigest() for i, _ in vectors if i is not None}
    starts = sorted(vectors, key=lambda r: (r[0] is None, digest.get(r[0], ""), r[1]))
    place = [v for _, v in starts[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), j) for j, p in enumerate(place))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in vectors]
        for j in range(len(place)):
            members = [v for (_, v), o in zip(vectors, own) if o == j]
            if members:
                place[j] = [sum(c) // len(members) for c in zip(*members)]
    found = [nearest(v) for _, v in vectors]
    inertia = [sum(d for d, o in found if o == j) for j in range(len(place))]
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in place]
    return Counter((i, j, d, inertia[j], sum(inertia), names[j]) for (i, _), (d, j) in zip(vectors, found))


@pytest.mark.parametrize("spread, count", [(0.05, 16), (3.0, 5), (1e5, 4), (3.0, 1)])
def test_clusters_match_brute_force(spark, spread, count):
    """Few distinct values give many ties; large ones leave 64-bit squares."""
    rng = random.Random(7)
    rows = [(i, [rng.choice((0, 1, rng.gauss(0, 1))) * spread for _ in range(6)]) for i in range(150)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, [spread] * 6), (901, [spread] * 6)]
    df = spark.createDataFrame(rows + [(902, [1.0]), (903, None), (904, [None] * 6), (905, [float("inf")] * 6)],
                               "vec_id bigint, embedding array<double>").repartition(3)
    df = df.withColumn("cluster", F.lit("x")).withColumn("distance", F.lit("y"))
    got = shallot.clustered(df, count, 3, width=6, scale=64).collect()
    want = brute_clusters([(i, [math.floor(64 * x) for x in v]) for i, v in rows], count, 3)
    assert Counter(map(tuple, got)) == want


def test_clusters_of_few_and_extreme_vectors(spark):
    shape = "vec_id bigint, embedding array<double>"
    huge = spark.createDataFrame([(1, [1e16, 0.0]), (2, [-1e16, 0.0]), (3, [5e15, 1.0])], shape)
    rows = {r["vec_id"]: r for r in shallot.clustered(huge, 2, 2, width=2, scale=64).collect()}
    assert len(rows) == 3 and all(r["cluster"] in (0, 1) for r in rows.values())
    assert any(r["distance"] is None for r in rows.values()) and rows[1]["inertia"] is None
    two = shallot.clustered(huge.limit(2), 16, 3, width=2, scale=64).collect()
    assert sorted(r["distance"] for r in two) == [0, 0] and {r["inertia"] for r in two} == {0}
    none = shallot.clustered(huge.where("false"), 16, 3, width=2, scale=64)
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert none.count() == 0


def test_search_leaves_out_centroids_beyond_the_ball(monkeypatch):
    """Exact answers while far centroids are never looked at."""
    rng = np.random.default_rng(3)
    place = np.concatenate([rng.integers(-20, 20, (40, 8)) + 1000 * k for k in range(5)])
    x = place[rng.integers(0, len(place), 500)] + rng.integers(-5, 5, (500, 8))
    every = ((x[:, None] - place[None]) ** 2).sum(axis=2)
    seen = []
    plain = shallot.squares
    c = shallot.Centroids.of(place)
    monkeypatch.setattr(shallot, "squares", lambda a, b: seen.append(len(a)) or plain(a, b))
    start = every.argsort(axis=1, kind="stable")[:, 3]
    first, d1, second, d2 = shallot.search(x, start.astype(np.int32), ((start + 1) % len(place)).astype(np.int32), c)
    order = every.argsort(axis=1, kind="stable")
    assert (first == order[:, 0]).all() and (second == order[:, 1]).all()
    assert (d1 == every.min(axis=1)).all() and (d2 == np.sort(every, axis=1)[:, 1]).all()
    assert sum(seen) < 0.5 * every.size


# 12 files


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("count", [0, 1, 7, 64, 1000])
def test_planes_turn_back(bits, count):
    for kind in (np.dtype("<u4"), np.dtype("<i8")):
        values = np.random.default_rng(count).integers(0, 2**31, count).astype(kind)
        values[: count // 2] *= 2 if kind.itemsize == 4 else -(2**20)
        parts = id_planes.planes(values, bits)
        assert len(parts) == kind.itemsize * 8 // bits
        assert (id_planes.unplaned(parts, count, kind, bits) == values).all()


def test_a_file_is_read_by_its_index():
    stream = io.BytesIO()
    writer = id_planes.PlaneWriter(stream, bits=1, block=100)
    ids = np.arange(1234, dtype=np.uint32) ** 2
    for first in range(0, 1234, 77):
        writer.add(id_planes.TOKENS, ids[first : first + 77])
    writer.close()
    size = stream.tell()
    reader = id_planes.PlaneReader(stream, size)
    assert [count for _, count, *_ in reader.index[id_planes.TOKENS]] == [100] * 12 + [34]
    for first, last in ((0, 1234), (0, 0), (99, 101), (100, 200), (1199, 1234), (350, 360)):
        assert reader.ids(first, last).tolist() == ids[first:last].tolist()
    place = reader.index[id_planes.TOKENS][3][0]
    stream.getbuffer()[place + 30] ^= 255
    with pytest.raises(Exception):
        id_planes.PlaneReader(stream, size).ids(0, 1234)
    with pytest.raises(ValueError):
        id_planes.PlaneReader(io.BytesIO(b"x" * 64), 64)


@pytest.mark.parametrize("bits", [1, 8])
def test_files_hold_every_document_in_order(spark, tokenizer, odd, tmp_path, bits):
    folder = f"file:{tmp_path}/ids"
    id_planes.write_ids(odd.repartition(3), folder, WORD_BPE, 2, bits=bits, block=64)
    (tmp_path / "ids" / "left-by-a-lost-task.planes").write_bytes(b"half a file")
    got = id_planes.read_digest(spark, folder).collect()
    want = Counter()
    for i, text in TEXTS:
        ids = np.array(ids_by_library(tokenizer, text) + [2], "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ordered = sorted(got, key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()


def test_files_of_an_empty_table_and_the_query(spark, tokenizer, empty, tmp_path):
    id_planes.write_ids(empty, f"{tmp_path}/none", WORD_BPE, 2)
    assert id_planes.read_digest(spark, f"{tmp_path}/none").count() == 0
    got = {r["doc_id"]: tuple(r)[1:] for r in contract.queries()["op12_id_planes"](spark, SF).collect()}
    start, want = 0, {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(ids_by_library(tokenizer, r["text"]) + [2], "<u4")
        want[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


# 13 search


@pytest.mark.parametrize("name", ["op11_shallot_clusters", "op13_shared_terms"])
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, SF)
    assert ok, note


def brute_search(documents, items, top):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}

    def terms(text):
        return pattern.findall((text or "").translate(lower))

    counted = [(i, Counter(terms(t))) for i, t in documents]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return Counter(out)


def test_search_matches_brute_force(spark, odd, empty, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["Äö", "É1", "x_y", "A-B"]
    documents = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(80)]
    documents += [(200, documents[4][1]), (4, documents[4][1]), (None, documents[4][1]), (201, ""), (202, None), (203, "-- !")]
    phrases = [rng.choices(words, k=6) for _ in range(6)]
    items = [(i, " ".join(sum(rng.choices(phrases, k=rng.randrange(1, 4)), rng.choices(words, k=rng.randrange(3))))) for i in range(30)]
    items += [(3, items[3][1]), (50, None), (51, "?"), (52, "unheard"), (None, items[2][1]), (53, "É1 é1 w1 W1 w1")]
    df = spark.createDataFrame(documents, "doc_id bigint, text string").withColumn("score", F.lit("x")).repartition(4)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit(1))
    want = brute_search(documents, items, 10)
    for cells, block in ((4_000_000, 100_000), (2_000, 60)):
        monkeypatch.setattr(shared_terms, "TABLE_CELLS", cells)
        monkeypatch.setattr(shared_terms, "BLOCK_TERMS", block)
        assert Counter(map(tuple, shared_terms.search(df, asked, 10).collect())) == want
    assert shared_terms.search(empty, asked, 10).count() == 0
    assert shared_terms.search(df, asked.where("false"), 10).count() == 0
    mine = Counter(map(tuple, shared_terms.search(odd, asked.selectExpr("item_id", "'two words 11 BASE7 base7' AS text"), 3).collect()))
    assert mine == brute_search(TEXTS, [(i, "two words 11 BASE7 base7") for i, _ in items], 3)


def test_shared_parts_are_made_once():
    """Every item unfolds to its own terms, and parts that items share are there once."""
    rng = random.Random(4)
    phrases = [rng.sample(range(100), 8) for _ in range(5)]
    items = []
    for _ in range(40):
        own = Counter(sum(rng.sample(phrases, 3), [rng.randrange(100, 130)]))
        items.append(dict(own))
    plan = shared_terms.share(items, 130)
    for own, parts in zip(items, plan.items):
        left, found = defaultdict(int, parts), Counter()
        while left:
            part = max(left)
            times = left.pop(part)
            if part < plan.terms:
                found[part] += times
            for p, t in plan.nodes[part - plan.terms] if part >= plan.terms else []:
                left[p] += times * t
        assert found == own
    additions = sum(map(len, plan.items)) + sum(map(len, plan.nodes))
    assert additions < 0.4 * sum(map(len, items))
