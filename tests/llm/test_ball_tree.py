from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import ball_tree, queries
from tests.conftest import SMALL


def best(rows, asks, k):
    """rows: (id, whole numbers or None)."""
    out = {}
    fine = [(i, v) for i, v in rows if i is not None and v is not None]
    for q, v in fine:
        if asks(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in fine if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard, block, floor", [(8192, 2048, 512), (40, 7, 3), (40, 7, 50)])
def test_against_brute_force_with_ties(spark, monkeypatch, shard, block, floor):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_ROWS", block), ("FLOOR_ROWS", floor), ("LEAF_ROWS", 4)):
        monkeypatch.setattr(ball_tree, name, value)
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = found(ball_tree.top_k(frame, F.col("vec_id") % 10 == 0, 4))
    assert made == best(rows, lambda i: i % 10 == 0, 4)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(500, 8))
    tree = ball_tree.build(vectors, np.arange(500), 16)
    for q in rng.normal(size=(20, 8)):
        for node in range(len(tree.radius)):
            inside = tree.rows[tree.begin[node] : tree.end[node]] @ q
            assert inside.max() <= q @ tree.centre[node] + np.linalg.norm(q) * tree.radius[node] + 1e-9
    assert sorted(tree.ids) == list(range(500))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001]), (50, None), (100, [nan, 1.0]), (150, [inf, 0.0]), (200, [None, 1.0]), (None, [1.0, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame = frame.select("vec_id", ball_tree.whole_numbers(F.col("embedding")).alias("embedding"), F.lit("x").alias("rank"))
    assert found(ball_tree.top_k(frame, F.col("vec_id") % 50 == 0, 5)) == {0: [(3, 128 * 256), (3, 128 * 256)]}
    assert ball_tree.top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).collect() == []
    assert ball_tree.top_k(frame, F.lit(False), 5).collect() == []


def test_query(spark):
    source = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r["vec_id"], [math.floor(256 * x) for x in r["embedding"]]) for r in source]
    assert found(queries.op7_top_k(spark, SMALL)) == best(rows, lambda i: i % 50 == 0, 5)


def test_equal_vectors_spread_over_shards_and_trees_are_built_once(spark, monkeypatch):
    """A third of the rows are equal: no shard is over the bound, whatever they share."""
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 100)
    monkeypatch.setattr(ball_tree, "FLOOR_ROWS", 100)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-5, 6, 4).astype(float).tolist()) for i in range(1000)]
    rows += [(2000 + i, rows[1][1]) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    built = []
    stored = ball_tree.stored_trees
    monkeypatch.setattr(ball_tree, "stored_trees", lambda *a: built.append(stored(*a)) or built[-1])
    made = found(ball_tree.top_k(frame, F.col("vec_id") % 100 == 0, 5))
    assert made == best(rows, lambda i: i % 100 == 0, 5)
    assert len(built) == 1
    sizes = [len(r["ids"]) // 8 for r in built[0].collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 100 + 25 and len(sizes) >= 15


def test_the_shared_kth_score_closes_branches():
    """With the k-th score of another shard most nodes are never looked at, and nothing is lost."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 6)) * 100
    vectors = np.round(np.repeat(centres, 50, 0) + rng.normal(size=(2000, 6)))
    tree = ball_tree.build(vectors, np.arange(2000), 16)
    asked = np.round(centres[:10])
    scores = asked @ vectors.T
    own = ball_tree.Best(asked, np.full(10, -1), np.full(10, -np.inf), 3)
    looked = ball_tree.search(tree, own, np.arange(10))
    floors = np.sort(scores, 1)[:, -3]
    shared = ball_tree.Best(asked, np.full(10, -1), floors, 3)
    less = ball_tree.search(tree, shared, np.arange(10))
    assert less <= looked < 10 * len(tree.radius) * 0.7
    for b in (own, shared):
        for q in range(10):
            wanted = np.lexsort((np.arange(2000), -scores[q]))[:3]
            assert b.found[b.at == q].tolist() == wanted.tolist()
    nothing = ball_tree.Best(asked, np.full(10, -1), scores.max(1) + 1, 3)
    assert ball_tree.search(tree, nothing, np.arange(10)) < less
    assert len(nothing.found) == 0
