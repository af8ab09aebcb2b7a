from __future__ import annotations

import random

import pytest

from postmill.llm import graph, queries, simhash
from tests.conftest import SMALL
from tests.llm import brute


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one TWO", "a b c", "É é É x  y\tz"]
    texts += [" ".join(rng.choices(["the", "cat", "Sat", "où"], k=rng.randint(1, 40))) for _ in range(50)]
    expected = [brute.simhash(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == expected
    monkeypatch.setattr(simhash, "CHUNK", 3)
    assert [simhash.fingerprint(t) for t in texts] == expected


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("paired", [0, 3, 32])
def test_links_of_planted_fingerprints(spark, monkeypatch, bits, paired):
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", 500_000 if paired else 0)
    rng = random.Random(bits * 10 + paired)
    values = [rng.getrandbits(64) for _ in range(30)]
    for base in values[:10]:
        for _ in range(8):
            flipped = base
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                flipped ^= 1 << bit
            values.append(flipped)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in values], "x long")
    found = {r["node"]: r["component"] for r in graph.components(simhash.links(frame, bits, paired)).collect()}
    expected = brute.classes({v: v & (1 << 64) - 1 for v in values}, bits)
    assert {v: found.get(v, v) for v in values} == expected


def test_variants_cover_every_near_pair():
    for bits in (0, 1, 2):
        masks = [m & (1 << 64) - 1 for m in simhash.variant_masks(bits)]
        for a in range(64):
            for b in range(a, 64):
                differ = [0, 1 << a, 1 << a | 1 << b][bits]
                assert any(differ & m == 0 for m in masks)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    odd = [(5000, 5000), (None, 7), (7, None)]
    frame = spark.createDataFrame(chain + hub + odd, "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(frame).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}
    assert graph.components(frame.limit(0)).collect() == []


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (4, ""), (9, " "), (None, "x y"), (8, "X  Y"), (7, "word " * 60_000), (6, "Word " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as simhash", "'c' as component_id")
    found = [(r["doc_id"], r["component_id"]) for r in simhash.near_groups(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(5, 4), (4, 4), (4, 4), (9, 4), (None, 8), (8, 8), (7, 6), (6, 6)], key=str
    )
    assert simhash.near_groups(docs.limit(0)).collect() == []


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {i: brute.simhash(t) for i, t in docs.items()}
    least = brute.classes(prints)
    rows = queries.op9_simhash(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", least[r["doc_id"]])
