"""Ids, repeated rows and large groups of near duplicates."""

from __future__ import annotations

import random

import pytest
from llm_rows import BASE, TEXTS
from pyspark.sql import functions as F
from test_operators import brute_components

from pulseline.llm import common, components, set_join


def test_large_ids_beside_missing_ones(spark):
    big = 2**60
    other = " ".join(f"other{i}" for i in range(30))
    rows = [(big + 1, BASE), (big + 2, BASE + " tail"), (big + 5, other), (None, BASE), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(df).where("doc_id IS NOT NULL").collect()}
    assert got == {big + 1: big + 1, big + 2: big + 1, big + 5: big + 5, 3: 3}
    kept = set_join.keep_one(spark, df, "").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(big + 1, BASE), (big + 5, other), (None, None), (3, None)], key=str)


def test_one_row_of_each_group_stays(spark, odd, empty):
    one, near, far = BASE, BASE + " tail", " ".join(f"far{i}" for i in range(9))
    rows = [(1, one), (1, one), (1, near), (None, one), (None, one), (2, near), (None, far), (None, far), (4, ""), (4, "")]
    shape = "doc_id bigint, text string, _key string, _KEY_of_text int"
    df = spark.createDataFrame([(*r, str(k % 2), 7) for k, r in enumerate(rows)], shape).repartition(4)
    kept = set_join.keep_one(spark, df, "")
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [g for g in got if g[1] in ("", far)] == [(4, ""), (4, ""), (None, far)]
    assert len(got) == 4 and got[0][0] == 1 and got[0][1] in (one, near)
    kept = [r["doc_id"] for r in set_join.keep_one(spark, odd, "").collect()]
    groups = brute_components([(i, t) for i, t in TEXTS if i is not None])
    assert sorted(kept) == sorted({label for _, label in groups.values()})
    assert set_join.keep_one(spark, empty, "").count() == 0


@pytest.mark.parametrize("most", [3, 23])
def test_chains_of_near_copies_need_several_rounds(spark, monkeypatch, most):
    """A group that drifts: members far from each other are linked through others only, whatever table of rarity."""
    monkeypatch.setattr(set_join, "PIVOTS", 1)
    monkeypatch.setattr(set_join, "LEVEL_BITS", most)
    rng = random.Random(8)
    words = [f"c{i}" for i in range(90)]
    texts = []
    for i in range(60):
        words[rng.randrange(90)] = f"d{i}"
        texts.append((1000 - i, " ".join(words)))
    shared = " ".join(f"s{i}" for i in range(20))
    texts += [(i, shared + " " + " ".join(f"u{i}_{j}" for j in range(6))) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    got = {r[0]: (r[1], r[2]) for r in set_join.near_duplicates(df).collect()}
    assert got == brute_components(texts)


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    links = [(f"{a:04}", f"{b:04}") if rng.random() < 0.5 else (f"{b:04}", f"{a:04}") for a, b in links * 2]
    got = {tuple(r) for r in components.components(spark.createDataFrame(links, "u string, v string")).collect()}
    want = {(f"{i:04}", "0000") for i in range(51)} | {(f"{i:04}", "0100") for i in range(100, 160)}
    assert got == want | {(f"{i:04}", "0300") for i in (300, 301, 302)}
    none = spark.createDataFrame([], "u string, v string")
    assert components.components(none).count() == 0


def test_no_id_goes_through_python(spark):
    """Whatever Python returns, ids and text keys are columns of the batches as they came."""
    rows = spark.createDataFrame([(2**63 - 1, "a"), (-(2**63), "b"), (None, None)], "doc_id bigint, text string")
    got = set_join.signatures(rows).where("token IS NULL").select("doc_id", F.hex("key").alias("key"))
    want = rows.select("doc_id", set_join.text_key(F.col("text")).alias("key")).select("doc_id", F.hex("key").alias("key"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_few_links_stay_in_few_partitions(spark):
    """Also where the session keeps all shuffle partitions: each task of each round would write files."""
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40)], "u string, v string")
        found = components.components(links)
        assert found.rdd.getNumPartitions() <= common.FEW
        assert {tuple(r) for r in found.collect()} == {(f"{i:03}", "000") for i in range(41)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
