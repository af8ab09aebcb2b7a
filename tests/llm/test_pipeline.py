from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from postmill.llm import queries, quality, secret_scans
from postmill.llm.common import read_table, written
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage kept, the first being the table itself."""
    docs = read_table(spark, SMALL, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SMALL)))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(spark, stages):
    model = quality.fit_model(stages[0], read_table(spark, SMALL, "labels"))
    scores = {r["doc_id"]: r["score"] for r in quality.with_score(stages[0], model).collect()}
    assert texts(stages[1]).keys() == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    good = {r["doc_id"] for r in read_table(spark, SMALL, "labels").where("quality = 1").collect()}
    assert len(good & texts(stages[1]).keys()) > 0.97 * len(good)


def test_near_duplicates(stages):
    before = texts(stages[1])
    least = brute.classes({i: brute.simhash(t) for i, t in before.items()})
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(set(least.values()))
    assert len(set(texts(stages[2]).values())) == stages[2].count()


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SMALL, "benchmark").collect()]
    found = brute.leaks(texts(stages[2]), items)
    assert texts(stages[3]).keys() == {i for i, (_, hit, _) in found.items() if not hit}


def test_secrets(stages):
    before, after = texts(stages[3]), stages[4].collect()
    assert before.keys() == {r["doc_id"] for r in after}
    for r in after:
        assert brute.secrets(r["text"])[0] == (0, 0, 0) or brute.secrets(before[r["doc_id"]])[0] != (0, 0, 0)
        assert r["n_chars"] == len(r["text"])
        if not any(re.search(rule.pattern, before[r["doc_id"]]) for rule in secret_scans.RULES):
            assert r["text"] == before[r["doc_id"]]
        for rule in secret_scans.BASE_RULES[1:]:
            assert not re.search(rule.pattern, r["text"]) or rule.kind == "access"


def test_packing(stages):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = defaultdict(list)
    for r in stages[5].collect():
        pieces[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    before = texts(stages[4])
    assert pieces.keys() == before.keys()
    for doc, text in before.items():
        ids = [i for _, part in sorted(pieces[doc]) for i in part]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_run_is_registered_and_equals_the_stages(spark, stages):
    made = driver.queries()["pipeline"](spark, SMALL)
    columns = ["doc_id", "start", "length", "ids"]
    assert sorted(made.select(columns).collect()) == sorted(stages[5].select(columns).collect())


CLASHES = "score spans hits items row blob simhash component_id k1 start length virtual_slot removed size".split()


def test_stages_leave_columns_of_clashing_names_alone(spark):
    docs = read_table(spark, SMALL, "documents").selectExpr("*", *[f"concat('{c}', doc_id) as {c}" for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name == "packing":
            assert out.count() >= docs.count()
            continue
        assert out.columns == docs.columns
        for row in out.take(20):
            assert [row[c] for c in CLASHES] == [f"{c}{row['doc_id']}" for c in CLASHES], name


def test_stages_take_odd_rows(spark):
    rows = [
        (None, None, "en", "s", None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 50_000, None, None, 5),
        (None, "A text without an id.", "en", "s", 3), (None, "Another text without an id, which is longer.", "en", "s", 4),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL)
            assert out.count() >= 0, name
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SMALL).collect()
    assert sorted(str(r["text"])[:8] for r in kept) == sorted(["", "word wor", "A text w", "Another "])
