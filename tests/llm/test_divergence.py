from __future__ import annotations

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from postmill.llm import divergence, queries
from postmill.llm.common import read_table
from tests.conftest import SMALL
from tests.llm import brute


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query(spark):
    docs = [(r["text"], r["lang"], r["source"]) for r in read_table(spark, SMALL, "documents").collect()]
    found = rows_of(queries.op13_source_divergence(spark, SMALL))
    assert found == brute.divergence(docs, 30, 50)
    assert {r[2] for r in found} == {"pair", "term"}


def test_random_texts(spark, monkeypatch):
    """Nulls, groups without terms, repeated rows, ties and a language with no kept term; shards and
    tiles of a few terms."""
    draw = random.Random(3)
    alphabet = ["a", "B", "é", "É", "zz", "x1y", "...", "一", "long" * 20]
    docs = [
        (
            None if draw.random() < 0.1 else " ".join(draw.choices(alphabet, k=draw.randrange(12))),
            draw.choice(["en", "de", None, ""]),
            draw.choice(["s", "t", "u", None]),
        )
        for _ in range(120)
    ]
    docs += [("", "only", "empty"), (None, "only", "null"), ("rare words", "only", "few")] + [docs[0]] * 5
    frame = spark.createDataFrame([(*d, "kept") for d in docs], "text string, lang string, source string, item string")
    assert rows_of(divergence.audit(frame, least=5, top_terms=3)) == brute.divergence(docs, 5, 3)
    kept = divergence.kept_terms(divergence.term_counts(frame), 5)
    groups = divergence.group_table(frame, kept)
    whole, parted = divergence.pair_distances(kept, groups), divergence.pair_distances(kept, groups, shard_terms=2)
    assert rows_of(whole) == rows_of(parted)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_counts_given_out_in_parts_are_added_up(spark, monkeypatch):
    frame = spark.createDataFrame([("a b c a", "en", "s")] * 20, "text string, lang string, source string")
    whole = rows_of(divergence.term_counts(frame))
    monkeypatch.setattr(divergence, "HELD", 2)
    assert rows_of(divergence.term_counts(frame)) == whole == [
        ("en", "s", "a", 40, 20), ("en", "s", "b", 20, 20), ("en", "s", "c", 20, 20)
    ]


@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=5), st.integers(1, 10**6))
def test_prices_are_exact(counts, v):
    total = sum(counts)
    got = divergence.prices(np.array(counts, np.int64), total, v)
    assert got.tolist() == [1 + 10**9 * (c + 5) // (total + 5 * v) for c in counts]


def test_tiles_of_any_width_make_the_same_products(monkeypatch):
    draw = np.random.default_rng(0)
    levels = draw.integers(0, 9, (40, 11)) ** 2
    totals = levels.sum(0).tolist()
    p = np.stack([divergence.prices(levels[:, g], totals[g], 40) for g in range(11)], 1)
    wanted = np.abs(p[:, :, None] - p[:, None, :]).sum(0)
    for width in (1, 17, 1000):
        monkeypatch.setattr(divergence, "TILE_COLUMNS", width)
        assert np.array_equal(divergence.block_distances(levels, totals, 40), wanted)
