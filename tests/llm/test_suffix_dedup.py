from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from postmill.llm import queries, suffix_dedup
from tests.conftest import SMALL
from tests.llm import brute


def removed(spark, texts, length, anchor, group=512):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = suffix_dedup.remove_repeats(docs, length=length, anchor=anchor, group=group).collect()
    out = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in rows}
    return [out[i] for i in range(len(texts))]


def test_runs_cover_all_windows_and_agree_on_equal_ones():
    rng = random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choices("ab", k=rng.randint(0, 60))).encode() for _ in range(5)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        first, counts, least, _ = suffix_dedup.window_runs(data, offsets, 12, 4)
        windows = [w for a, n in zip(first, counts, strict=True) for w in range(a, a + n)]
        expected = [w for a, b in zip(offsets, offsets[1:]) for w in range(a, b - 11)]
        assert windows == expected and all(counts <= 9)
        anchor = {}
        for a, n, h in zip(first, counts, least, strict=True):
            for w in range(a, a + n):
                assert anchor.setdefault(bytes(data[w : w + 12]), h) == h


@pytest.mark.parametrize("group", [512, 2])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh"])
def test_against_brute_force(spark, monkeypatch, group, alphabet):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    rng = random.Random(group)
    base = ["".join(rng.choices(alphabet, k=200)) for _ in range(12)]
    texts = [*base, base[0], base[1], base[2][:120] + base[3][50:], "x" + base[4], "é" + base[5][10:60] * 3]
    for _ in range(25):  # a passage in many contexts
        texts.append("".join(rng.choices(alphabet, k=30)) + base[6][40:75] + "".join(rng.choices(alphabet, k=30)))
    texts += ["", None, "a" * 500, "ab" * 100, "short"]
    expected = brute.repeats(texts, 24)
    assert removed(spark, texts, 24, 6, group) == expected
    assert any(spans for _, spans, _ in expected)


def test_odd_rows(spark):
    rows = [(None, "q" * 500, 1), (1, "", 2), (2, None, 3), (3, "same " * 200, 4), (3, "same " * 200, 4), (5, "unique", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 int").withColumnRenamed("k1", "kept")
    out = suffix_dedup.remove_repeats(docs).collect()
    assert sorted(r["n_bytes"] for r in out) == [0, 0, 6, 500, 1000, 1000]
    assert all(r["kept"] == b"" for r in out if r["n_bytes"] != 6)
    assert [r["text"] for r in out if r["doc_id"] == 2] == [None]
    clash = spark.createDataFrame([(1, "x", 7)], "doc_id long, text string, k1 int")
    assert suffix_dedup.remove_repeats(clash).first()["k1"] == 7
    assert suffix_dedup.remove_repeats(docs.limit(0)).collect() == []


def test_one_very_long_text(spark):
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghij ", k=1_500_000))
    text += text[1000:2000]
    row = removed(spark, [text], 400, 100)[0]
    assert row[1] == [(1000, 1000), (1_500_000, 1000)] or sum(n for _, n in row[1]) >= 2000


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    expected = dict(zip(docs, brute.repeats(list(docs.values()), 400), strict=True))
    rows = queries.op8_suffix_dedup(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        size, spans, kept = expected[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size, sum(n for _, n in spans), len(spans))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert any(r["n_removed"] for r in rows)
