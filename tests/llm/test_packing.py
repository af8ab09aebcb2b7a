from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from postmill.llm import packing, queries
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(1)
    marks = ["a", "b ", " ", "  ", "\n", "\t", "é", "'s", "'", "12", ".", "\u00a0", "\u3000", "😀", "<|endoftext|>", " y", "\x1c", "\x00", "\u200b"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 25))) for _ in range(3000)]
    texts += ["", " ", "word", "a b c", "x" * 50_000, "many words " * 5000]
    made = packing.Encoder(queries.tokenizer_path()).streams(pa.array([*texts, None]))
    for text, ids in zip([*texts, ""], made, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() + [0] == plain(tokenizer, text), repr(text[:60])


def test_both_ways_to_learn_words_agree(monkeypatch):
    words = ["thing", "ção", "x.y,z", "don't", "", "😀", "a" * 100]
    fast = packing.Encoder(queries.tokenizer_path())
    monkeypatch.setattr(packing, "_ranked", lambda path: None)
    slow = packing.Encoder(queries.tokenizer_path())
    words.remove("")
    fast.learn(words)
    slow.learn(words)
    assert fast.known == slow.known


def test_piece_lengths():
    for total in range(1, 5000):
        pieces = packing.piece_lengths(total, 1024)
        assert sum(pieces) == total and all(p & (p - 1) == 0 and p <= 1024 for p in pieces)
        assert pieces == sorted(pieces, reverse=True)


def test_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op4_packing(spark, SMALL).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for doc, text in texts.items():
        ids, at = plain(tokenizer, text), 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and len(part) == r["length"] == 1 << r["bucket"] and r["offset"] == 0
            assert r["ids_crc32"] == brute.crc(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)


def test_odd_rows(spark):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "x y " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string").withColumnRenamed("bucket", "length")
    out = packing.pack(docs, queries.tokenizer_path()).collect()
    assert sum(r["length"] for r in out if r["doc_id"] == 1) == 2
    assert [r["length"] for r in out if r["doc_id"] is None] == [1]
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, queries.tokenizer_path(), max_length=1000)


def test_buckets_are_stored_by_length(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b")], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs, queries.tokenizer_path()), str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b")).collect()
    assert all(r["length"] == 1 << r["bucket"] for r in stored) and sum(r["length"] for r in stored) == 9
