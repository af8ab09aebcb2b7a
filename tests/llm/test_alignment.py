from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from postmill.llm import alignment, queries
from postmill.llm.common import arrow_batches, read_table
from tests.conftest import SMALL
from tests.llm import brute

ODD = [
    None, "", " ", "a", "<|endoftext|> x", "<s> a </s> <unk> <0x41>", "a▁b", "hello  world", "x\t\ny\n\n z ",
    "éＡ​ q", "\U0001f600 \U0001f600", "a b c d", "it's don't 123 45,6", "日本語 テ",
    "\x00 a", "ﬁ ﬀ", "word " * 3000 + "end",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(queries.tokenizer_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.piece_model_path())
    return lambda text: brute.aligned(text, a, b)


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def test_odd_texts(spark, plain):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(ODD)], "doc_id long, text string, N_A string")
    out = alignment.align(docs, queries.tokenizer_path(), queries.piece_model_path())
    assert out.columns == ["doc_id", "text", "n_a", "n_b", "groups", "n_groups", "links"]
    for r in out.collect():
        a, b, groups = plain(r["text"])
        assert (r["n_a"], r["n_b"], r["n_groups"], r["groups"]) == (len(a), len(b), len(groups), shown(groups)), r["text"]
        assert sum(x["n"] for x in r["links"]) == len(groups)


def test_query(spark, plain):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SMALL, "documents").collect()}
    found = {i: plain(t) for i, t in texts.items()}
    counts = dict(zip(found, brute.link_counts([f[2] for f in found.values()]), strict=True))
    rows = queries.op11_token_alignment(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        a, b, groups = found[r["doc_id"]]
        digest = brute.sha(shown(groups)) if groups else ""
        assert tuple(r) == (r["doc_id"], len(a), len(b), len(groups), *counts[r["doc_id"]], digest)


def test_counts_with_and_without_a_broadcast_of_all_pairs(spark):
    """Repeated rows, rows without an id and columns of clashing names; then an empty table."""
    texts = ["the cat sat", "the cat sat", None, "a cat, the mat", "thecatsat the", ""]
    rows = [(None if i == 0 else i, t, "kept", "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, count_sum string, key string")
    aligned = alignment.align(docs, queries.tokenizer_path(), queries.piece_model_path())
    whole = alignment.with_link_counts(aligned)
    assert whole.columns == ["doc_id", "text", "key", "n_a", "n_b", "groups", "n_groups", "n_links", "n_best", "count_sum"]
    for bound in (1, 3):
        assert sorted(map(str, alignment.with_link_counts(aligned, bound).collect())) == sorted(map(str, whole.collect()))
    assert whole.where("n_links > 0 and count_sum >= n_links").count() == 4
    assert alignment.with_link_counts(aligned.limit(0)).count() == 0


@given(
    st.lists(st.integers(1, 4), max_size=40), st.lists(st.integers(1, 4), max_size=40), st.integers(1, 9),
)
def test_pieces_make_the_same_merge(a, b, size):
    """Whatever the piece, also where a diagonal parts two equal ends."""
    a_ends, b_ends = np.cumsum(a, dtype=np.int64), np.cumsum(b, dtype=np.int64)
    total = max(int(a_ends[-1]) if a else 0, int(b_ends[-1]) if b else 0) + 1
    a_ends, b_ends = np.append(a_ends, total), np.append(b_ends, total)
    i, j, group = alignment.merged(a_ends, b_ends, size)
    wanted, number = [], 0
    for end in sorted({*a_ends.tolist(), *b_ends.tolist()}):
        wanted.append((int(np.searchsorted(a_ends, end)), int(np.searchsorted(b_ends, end)), number))
        number += end in a_ends and end in b_ends
    assert list(zip(i.tolist(), j.tolist(), group.tolist(), strict=True)) == wanted
    i_cut, j_cut = alignment.diagonals(a_ends, b_ends, size)
    assert (np.diff(i_cut + j_cut)[:-1] == size).all() and np.diff(i_cut + j_cut)[-1] <= size


def test_no_pair_is_sent_whole_to_one_task(spark):
    docs = spark.range(200).select(F.lit("the same words in each text").alias("text"))
    aligned = alignment.align(docs, queries.tokenizer_path(), queries.piece_model_path())
    counts = alignment.pair_counts(aligned)
    assert counts.agg(F.max("n")).first()[0] == 200 and counts.where("best").count() == counts.count()


def test_workers_are_handed_few_rows_at_a_time(spark, monkeypatch):
    """A whole batch of texts lies in buffers of the executor and of its worker."""
    name, handed = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    store = alignment.written
    monkeypatch.setattr(alignment, "written", lambda df: handed.append(int(spark.conf.get(name))) or store(df))
    docs = spark.range(50).select(F.lit("some words").alias("text"))
    aligned = alignment.align(docs, queries.tokenizer_path(), queries.piece_model_path())
    assert alignment.with_link_counts(aligned).count() == 50
    assert handed[0] == alignment.BATCH_ROWS and spark.conf.get(name) == before
    with arrow_batches(spark, 7):
        sizes = spark.range(20, numPartitions=1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long"
        ).collect()
    assert sum(r["n"] for r in sizes) == 20 and max(r["n"] for r in sizes) == 7
