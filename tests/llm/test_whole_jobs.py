"""Cases in which operators once did less than the whole job."""

from __future__ import annotations

import zlib

import numpy as np

from pulseline.llm import pseudo_likelihood, queries, rules

SF = "/root/testdata/sf0.001"

# 6 scoring


def test_every_word_is_predicted_not_only_its_bucket(spark):
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words[k::7]) for k in range(7)] * 2 + [" ".join(words[:900])] * 3
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pseudo_likelihood.fit_network(documents)
    ids = pseudo_likelihood.TokenIds(model[0])
    rare = "w2999"
    junk = next(w for w in (f"junk{i}" for i in range(9999)) if ids.of([w])[0] == ids.of([rare])[0])
    asked = spark.createDataFrame([(1, rare), (2, junk), (2, junk), (None, f"{rare} {rare}")], "doc_id long, text string")
    rows = pseudo_likelihood.with_pseudo_likelihood(asked, "text", "s", model).collect()
    assert sorted(r["text"] for r in rows) == sorted([rare, junk, junk, f"{rare} {rare}"])
    logs = {r["text"]: r["s"]["log_likelihood"] for r in rows}
    bucket = [w for w in words if w not in model[0] and zlib.crc32(w.encode()) % 256 == ids.of([rare])[0] - ids.own]
    total, distinct = 2 * len(bucket), len(bucket)
    net, (row, at) = model[1], pseudo_likelihood.framed([ids.of([rare])])
    spelled = 256.0 ** -(len(rare) + 1)
    share = (2 + (distinct + 1) * spelled) / (total + distinct + 1)
    assert np.isclose(logs[rare], pseudo_likelihood.log_probabilities(net, row, at)[0] + np.log(share))
    assert logs[junk] < logs[rare] - 10


def test_words_by_themselves_follow_a_count(spark):
    texts = [" ".join(f"w{i}" for i in range(1500))] * 4 + [" ".join(f"v{i}" for i in range(500))]
    documents = spark.createDataFrame([(t,) for t in texts], "text string")
    frequent, net, words, totals = pseudo_likelihood.fit_network(documents, own_count=4)
    assert len(frequent) == 1500 and words.count() == 2000
    assert totals.sum(axis=1).tolist() == [500, 500]
    ids = pseudo_likelihood.TokenIds(frequent)
    assert net["embed"].shape[1] == ids.own + ids.buckets + 1 and net["word_bias"].size == ids.own + ids.buckets
    scored = pseudo_likelihood.with_pseudo_likelihood(documents, "text", "s", (frequent, net, words, totals)).collect()
    assert all(np.isfinite(r["s"]["log_likelihood"]) for r in scored) and len(scored) == 5


# 8 and 10 pieces


def test_ids_and_counts_are_those_of_the_model(spark, odd, tmp_path):
    import sentencepiece

    path = queries.vocabulary_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    hard = [(-1 - i, t) for i, t in enumerate(["  a   b ", "x" * 999, "日本🙂語é́\t\n\n!!", "a!?b ▁c", "<s></s><unk>", "aaa\n\n  aa..", ""])]
    both = documents.unionByName(odd.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).selectExpr("doc_id - 99 as doc_id", "text"))
    both = both.unionByName(spark.createDataFrame([(i - 200, t) for i, t in hard], "doc_id long, text string"))
    both.write.parquet(f"{tmp_path}/documents.parquet")
    want = {r["doc_id"]: None if r["text"] is None else model.encode(r["text"]) for r in both.collect()}
    # A U+2581 in the text itself reads back as a space, with the model as well.
    back = {r["doc_id"]: r["text"] is None or model.decode(want[r["doc_id"]]) == r["text"] for r in both.collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.op10_token_counts(spark, str(tmp_path)).collect()}
    assert counts == {i: None if w is None else len(w) for i, w in want.items()}
    coded = {r["doc_id"]: (r["n_ids"], r["ids_xxhash64"], r["round_trip"]) for r in queries.op8_piece_codec(spark, str(tmp_path)).collect()}
    hashed = spark.createDataFrame(list(want.items()), "doc_id long, ids array<int>").selectExpr("doc_id", "size(ids) n", "xxhash64(ids) h")
    assert coded == {r["doc_id"]: (r["n"] if want[r["doc_id"]] is not None else coded[r["doc_id"]][0], r["h"], back[r["doc_id"]]) for r in hashed.collect()}


# pipeline


def test_quality_keeps_everything_if_nothing_can_be_learnt(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of some words." * (i % 7)) for i in range(120)], "doc_id long, text string")
    shape = "doc_id long, quality int"
    for name, labels in {"none": [], "good": [(i, 1) for i in range(120)], "bad": [(i, 0) for i in range(120)], "few": [(0, 1), (1, 0)]}.items():
        spark.createDataFrame(labels, shape).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = rules.keep_good(spark, docs, f"{tmp_path}/{name}")
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(120)), name
