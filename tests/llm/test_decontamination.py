from __future__ import annotations

import random

from postmill.llm import decontamination, queries
from tests.conftest import SMALL
from tests.llm import brute

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def found(spark, docs, items, **options):
    frame = decontamination.with_matches(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options
    )
    return {r["doc_id"]: (r["n_words"], sum(h["length"] for h in r["hits"]), r["items"]) for r in frame.collect()}


def test_made_up_texts_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    for size in (1 << 20, 40):
        monkeypatch.setattr(decontamination, "SHARD_WORDS", size)
        for window in (3, 10):
            docs = [(i, "".join(rng.choice(["a", "B", "é", " ", "-", "\n"]) for _ in range(rng.randint(0, 120)))) for i in range(60)]
            items = [(i, " ".join(rng.choices(["a", "b", "aB", "é"], k=rng.randint(0, 14)))) for i in range(12)]
            assert found(spark, docs, items, window=window) == brute.leaks(dict(docs), items, window)


def test_blocks_of_the_benchmark_agree_with_one(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdef", k=50))) for i in range(40)]
    items = [(i, " ".join(rng.choices("abcdef", k=12))) for i in range(30)]
    items += [(100 + i, docs[i][1][10:40]) for i in range(5)]
    assert found(spark, docs, items) == found(spark, docs, items, block_bytes=50) == brute.leaks(dict(docs), items)


def test_odd_rows(spark):
    docs = [(None, None), (1, ""), (2, "!!"), (3, "one two"), (3, "one two"), (4, "One, TWO three " * 20_000)]
    items = [(1, "one two"), (2, None), (None, "three"), (3, ""), (4, "..."), (5, "one two")]
    out = found(spark, docs, items)
    assert out[None] == (0, 0, []) and out[1] == (0, 0, []) and out[2] == (0, 0, [])
    assert out[3] == (2, 2, ["1", "5"]) and out[4] == (60_000, 60_000, ["1", "5"])  # "three" has no id
    assert found(spark, docs[:4], [])[3] == (2, 0, [])
    assert found(spark, [], items) == {}


def test_matches_do_not_cross_documents(spark):
    words = [f"w{i}" for i in range(10)]
    docs = [(1, " ".join(words[:5])), (2, " ".join(words[5:])), (3, " ".join(words))]
    out = found(spark, docs, [(7, " ".join(words))])
    assert [out[i][1] for i in (1, 2, 3)] == [0, 0, 10]


def test_spans_and_longest_match(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x " + " ".join(f"w{i}" for i in range(5, 25)) + " y " + " ".join(f"w{i}" for i in range(10))
    frame = decontamination.with_matches(
        spark.createDataFrame([(1, text)], DOCS), spark.createDataFrame([(1, item)], ITEMS)
    ).first()
    assert [tuple(h) for h in frame["hits"]] == [(1, 20), (22, 10)] and frame["longest_match"] == 20


def test_items_without_an_id_count_for_hits_alone(spark):
    passage = " ".join(f"w{i}" for i in range(11))
    items = [(None, passage), (None, passage), (None, "x y"), (8, "y z")]
    docs = [(1, f"a {passage} b"), (2, "x y z"), (3, "none")]
    out = found(spark, docs, items)
    assert out == brute.leaks(dict(docs), items)
    assert out == {1: (13, 11, []), 2: (3, 3, ["8"]), 3: (1, 0, [])}
    kept = decontamination.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert [r["doc_id"] for r in kept.collect()] == [3]


def test_removal_keeps_the_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "q"), (2, "d", "r"), (None, None, None)], "doc_id long, text string, items string")
    kept = decontamination.decontaminate(docs, spark.createDataFrame([(1, "a b")], ITEMS))
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["items"]) for r in kept.collect()) == [("2", "r"), ("None", None)]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    expected = brute.leaks(docs, items)
    rows = queries.op5_decontamination(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n_words, n_hit, names = expected[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (
            n_words, n_hit, len(names), brute.sha(",".join(names)), n_hit > 0
        )
    assert any(r["contaminated"] for r in rows)
