from __future__ import annotations

import random

import pytest

from postmill.operators import term_deltas, terms, versions

KEYS = ["k"]
SCHEMA = "k string, body string"
STOP = ["the"]


def df(frame):
    return {r["word"]: r["df"] for r in frame.collect()}


def message(draw):
    return " ".join(draw.choices("alpha beta gamma the de delta Alpha epsilon".split(), k=draw.randrange(8)))


@pytest.mark.parametrize("seed", range(3))
def test_two_loads_with_overlapping_keys(spark, tmp_path, seed):
    draw = random.Random(seed)
    path = str(tmp_path / "df")
    table = spark.createDataFrame([(f"m{i}", message(draw)) for i in range(60)] + [(None, "alpha null key")], SCHEMA)
    term_deltas.append_delta(terms.message_frequency(table, "body", STOP), path, 0)
    for load in (1, 2):
        rows = [(f"m{i}", message(draw) if draw.random() < 0.8 else None) for i in draw.sample(range(90), 40)]
        new = spark.createDataFrame([*rows, (None, "beta")], SCHEMA)
        delta = term_deltas.frequency_delta(table, new, KEYS, "body", STOP)
        assert 0 not in df(delta).values()
        term_deltas.append_delta(delta, path, load)
        table = versions.merge_into(table, new, KEYS, ["body"])
        wanted = df(terms.message_frequency(table, "body", STOP))
        assert df(term_deltas.read_frequency(spark, path)) == wanted
        assert term_deltas.total(term_deltas.read_frequency(spark, path)) == sum(wanted.values())
    # A load that is stored again counts once, and all loads fold into one.
    term_deltas.append_delta(delta, path, 2)
    term_deltas.compact(spark, path, str(tmp_path / "one"), 2)
    assert df(term_deltas.read_frequency(spark, str(tmp_path / "one"))) == wanted


def test_unchanged_messages_leave_no_trace(spark):
    table = spark.createDataFrame([("a", "alpha beta"), ("b", "beta")], SCHEMA)
    assert df(term_deltas.frequency_delta(table, table, KEYS, "body", STOP)) == {}
    assert df(term_deltas.frequency_delta(table, table.limit(0), KEYS, "body", STOP)) == {}
    gone = spark.createDataFrame([("a", "")], SCHEMA)
    assert df(term_deltas.frequency_delta(table, gone, KEYS, "body", STOP)) == {"alpha": -1, "beta": -1}


def test_words_that_nobody_holds_are_gone(spark):
    frequency = spark.createDataFrame([("alpha", 1.0), ("beta", 2.0)], "word string, df double")
    delta = spark.createDataFrame([("alpha", -1), ("gamma", 3)], "word string, df long")
    assert df(term_deltas.apply_delta(frequency, delta)) == {"beta": 2.0, "gamma": 3.0}
