from __future__ import annotations

import random

import pytest

from postmill.llm import licenses, queries
from postmill.llm.common import read_table
from postmill.llm.licenses import TEMPLATES, Template
from tests.conftest import SMALL, plan_of
from tests.llm import brute


def digest(text):
    """The query's row by the plain version."""
    n, found = brute.licenses(text, TEMPLATES)
    starts = [i for k, v in found.items() if TEMPLATES[k].base for i in v]
    base = sorted({TEMPLATES[k].label for k in found if TEMPLATES[k].base})
    every = sorted({TEMPLATES[k].label for k in found})
    score = max((1.0 if TEMPLATES[k].phrase else v for k, v in found.items()), default=0.0)
    return n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(every), score


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SMALL, "documents").collect()}
    rows = queries.op12_license_scan(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == digest(texts[r["doc_id"]]), r["doc_id"]


def scan(spark, texts, templates=TEMPLATES):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.scan(docs, templates).collect()}


def test_phrases_and_notices_in_any_place(spark):
    """Over the edges of blocks, in any case, with other marks between words, twice and nested."""
    draw = random.Random(1)
    filler = "the of and by under license version 2 nc cc by general public terms Été mit".split()
    texts = ["", None, "cc by nc", "CC BY-NC cc-by\nnc", "under the MIT\tLicense", "cc by cc by nc", "apache license version 22"]
    texts += ["K under the mit license", "under the mıt license", "under the mit licenſe"]
    for t in TEMPLATES:
        for before in (0, 29, 30, 31, 32, 33, 63, 64, 200):
            texts.append(" ".join(["x"] * before + t.words + ["y"] * 5))
        texts.append(" ".join([*draw.choices(filler, k=300), *t.words, *draw.choices(filler, k=300)]))
        texts.append(" ".join(t.words[: int(len(t.words) * 0.75)]))
    texts += [" ".join(draw.choices(filler, k=400)) for _ in range(20)]
    found = scan(spark, texts)
    for i, text in enumerate(texts):
        n, wanted = brute.licenses(text, TEMPLATES)
        assert found[i]["n_words"] == n
        got = [(f["label"], f["base"], f["places"] if f["score"] == 1 else 0, f["score"]) for f in found[i]["found"]]
        parts = [(TEMPLATES[k], v) for k, v in sorted(wanted.items())]
        assert [(x[0], x[1]) for x in got] == [(t.label, t.base) for t, _ in parts], text
        assert [f["score"] for f in found[i]["found"]] == [1.0 if t.phrase else v for t, v in parts]
        for f, (t, v) in zip(found[i]["found"], parts, strict=True):
            if t.phrase:
                assert (f["places"], f["first_word"], f["last_word"]) == (len(v), v[0], v[-1])


@pytest.mark.parametrize("containment", [0.5, 0.8, 1.0])
def test_no_pair_is_lost(spark, containment):
    """Random blocks against random templates, all filters against the plain count."""
    draw = random.Random(int(containment * 10))
    letters = [f"w{i}" for i in range(30)]
    templates = tuple(
        Template(f"t{k}", " ".join(draw.sample(letters, 6 + k)), containment, phrase=False) for k in range(5)
    )
    texts = [" ".join(draw.choices(letters, weights=range(1, 31), k=draw.randrange(60))) for _ in range(150)]
    found = scan(spark, texts, templates)
    for i, text in enumerate(texts):
        wanted = brute.licenses(text, templates)[1]
        assert [(f["label"], f["score"]) for f in found[i]["found"]] == [(templates[k].label, v) for k, v in sorted(wanted.items())]


def test_repeated_rows_clashing_names_and_empty_tables(spark):
    rows = [(1, "under the mit license", "a", "b"), (1, "under the mit license", "a", "b"), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, phrases string, FOUND string")
    out = licenses.scan(docs)
    assert out.columns == ["doc_id", "n_words", "found"]
    assert sorted(len(r["found"]) for r in out.collect()) == [0, 1, 1]
    assert licenses.scan(docs.limit(0)).count() == 0
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    with pytest.raises(ValueError, match="no words"):
        licenses.scan(docs, (Template("x", "--"),))
