from __future__ import annotations

import collections
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from postmill.operators import terms
from postmill.plans import keywords
from tests.conftest import plan_of

STOP = ["the"]


def emails(spark, bodies):
    rows = [(f"u{i}", i, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "`from` string, ts bigint, body string")


def by_rule(bodies, stop, n=10):
    tf = {}
    for i, body in enumerate(bodies):
        words = [w for w in (body or "").lower().split() if len(w) >= 3 and w not in stop]
        tf[i] = collections.Counter(words)
    df = collections.Counter(w for c in tf.values() for w in c)
    total = sum(df.values())
    result = {}
    for i, counts in tf.items():
        scores = [(w, t * math.log2(total / df[w])) for w, t in counts.items()]
        best = sorted((s for s in scores if s[1] != 0), key=lambda s: (-s[1], s[0]))[:n]
        result.update({(f"EntityId(u{i},{i})", w): s for w, s in best})
    return result


def as_dict(frame):
    return {(r["doc"], r["word"]): r["score"] for r in frame.collect()}


def test_worked_example(spark):
    frame = emails(spark, ["apple apple pear", "apple the of"])
    counts = terms.term_counts(frame, ["from", "ts"], "body", STOP)
    assert sorted(tuple(r)[2:] for r in counts.collect()) == [("apple", 1), ("apple", 2), ("pear", 1)]
    assert {r["word"]: r["df"] for r in terms.document_frequency(counts).collect()} == {"apple": 2.0, "pear": 1.0}
    got = as_dict(keywords.message_keywords(frame, STOP))
    assert got == pytest.approx(
        {
            ("EntityId(u0,0)", "pear"): 1.584962500721156,
            ("EntityId(u0,0)", "apple"): 1.169925001442312,
            ("EntityId(u1,1)", "apple"): 0.584962500721156,
        }
    )


def test_one_word_vocabulary_has_no_score(spark):
    assert as_dict(keywords.message_keywords(emails(spark, ["apple"]), STOP)) == {}


def test_published_value_for_778_pairs(spark):
    frequency = spark.range(778).select(F.col("id").cast("string").alias("word"), F.lit(1.0).alias("df"))
    idf = terms.inverse_document_frequency(frequency).first()["idf"]
    assert idf == pytest.approx(9.603626344986191, abs=1e-12)


@pytest.mark.parametrize("frequent", [1, 3, 20, 100_000])
def test_keywords_against_plain_rule(spark, frequent):
    picker = random.Random(11)
    vocabulary = [f"w{i:03d}" for i in range(80)] + ["x" * 70, "y" * 200, "ab", "the"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    bodies = [" ".join(picker.choices(vocabulary, weights, k=picker.randint(0, 60))) for _ in range(60)]
    bodies += ["x" * 70 + " hot"] * 30 + [None, "", "the"]
    got = as_dict(keywords.message_keywords(emails(spark, bodies), STOP, frequent=frequent))
    expected = by_rule(bodies, STOP)
    assert got.keys() == expected.keys()
    assert got == pytest.approx(expected)


def test_same_result_from_stored_counts(spark, tmp_path):
    bodies = ["one two two three", "two three four five", "five five one"]
    frame = emails(spark, bodies)
    terms.term_counts(frame, ["from", "ts"], "body", STOP).write.parquet(str(tmp_path / "counts"))
    stored = spark.read.parquet(str(tmp_path / "counts"))
    assert as_dict(keywords.keywords_of_counts(stored)) == as_dict(keywords.message_keywords(frame, STOP))


def test_branches_share_one_frequency_shuffle(spark, tmp_path):
    frame = emails(spark, ["one two two three", "two three four five"] * 20)
    path = str(tmp_path / "counts")
    terms.term_counts(frame, ["from", "ts"], "body", STOP).write.parquet(path)
    best = keywords.keywords_of_counts(spark.read.parquet(path))
    best.collect()
    final = plan_of(best).split("+- == Initial Plan ==")[0]
    shuffles = [line for line in final.splitlines() if "Exchange hashpartitioning(word" in line]
    assert any("ReusedExchange" in line for line in shuffles)


def test_stop_words_as_a_table(spark):
    frame = emails(spark, ["apple apple pear", "apple the of"])
    table = spark.createDataFrame([("the",), ("pear",), ("pear",)], "w string")
    assert as_dict(keywords.message_keywords(frame, table)) == as_dict(
        keywords.message_keywords(frame, ["the", "pear"])
    )


def test_default_stop_words(spark):
    counts = terms.term_counts(emails(spark, ["because apple"]), ["from", "ts"])
    assert [r["word"] for r in counts.collect()] == ["apple"]


def test_counting_in_the_row_needs_no_shuffle(spark):
    plan = plan_of(terms.term_counts(emails(spark, ["a"]), ["from", "ts"], "body", STOP))
    assert "Exchange" not in plan and "Python" not in plan


def test_keyword_plan(spark):
    frame = emails(spark, ["one two", "two three"])
    plan = plan_of(keywords.message_keywords(frame, STOP))
    assert "WindowGroupLimit" in plan and "SortMergeJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_frequent_part_is_bounded(spark):
    picker = random.Random(2)
    shares = spark.createDataFrame([(i, float(picker.randint(1, 50))) for i in range(500)], "k int, share double")
    for limit in (1, 7, 100):
        large, small = terms.split_by_share(shares, "share", limit)
        assert large.count() <= limit
        assert large.count() + small.count() == 500
        total = shares.agg(F.sum("share")).first()[0]
        top = small.agg(F.max("share")).first()[0]
        assert top is None or top < total / limit


@pytest.mark.parametrize("limit", [2, 100_000])
def test_join_by_share_is_an_inner_join(spark, limit):
    facts = spark.createDataFrame([("hot", i) for i in range(50)] + [("a", 1), ("b", 2), ("z", 3)], "k string, v int")
    per_key = facts.filter("k != 'z'").groupBy("k").agg(F.count("*").alias("n"))
    got = terms.join_by_share(facts, per_key, "k", "n", limit)
    assert sorted(map(tuple, got.collect())) == sorted(
        [("hot", i, 50) for i in range(50)] + [("a", 1, 1), ("b", 2, 1)]
    )


def test_row_l1_normalise(spark):
    matrix = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", -3.0), (1, "c", 0.0), (2, "a", 5.0), (3, "a", 0.0)], "row int, col string, value double"
    )
    got = sorted(map(tuple, terms.row_l1_normalise(matrix, "row").collect()))
    assert got == [(1, "a", 0.25), (1, "b", -0.75), (2, "a", 1.0)]


KEYS_OF_EACH_KIND = {
    "string": [None, " ", "", "a", "b" * 70, "b" * 71, "NaN"],
    "double": [None, 0.0, -0.0, float("nan"), 1.5, float("inf")],
    "bigint": [None, 0, -1, 7],
    "date": [None, datetime.date(2001, 1, 1)],
}


@pytest.mark.parametrize("kind", list(KEYS_OF_EACH_KIND))
def test_all_ways_of_the_join_have_one_equality(spark, kind):
    keys = KEYS_OF_EACH_KIND[kind]
    facts = spark.createDataFrame(
        [(k, i * 10 + j) for i, k in enumerate(keys) for j in range(i + 1)], f"k {kind}, v bigint"
    )
    per_key = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    whole = None
    for limit in (1, 3, 100_000):
        joined = terms.join_by_share(facts, per_key, "k", "n", limit)
        rows = sorted((r["v"], r["n"], r["total"]) for r in joined.collect())
        assert len(rows) == facts.count()
        assert whole is None or rows == whole
        whole = rows


@pytest.mark.parametrize("limit", [1, 100_000])
def test_rows_with_null_keys_are_normalised(spark, limit):
    matrix = spark.createDataFrame(
        [(None, 1.0), (None, -3.0), (" ", 2.0), ("a", 0.0), ("a", None), ("b" * 90, 5.0)], "row string, value double"
    )
    rows = terms.row_l1_normalise(matrix, "row", limit=limit).collect()
    assert sorted((str(r["row"])[:4], r["value"]) for r in rows) == [(" ", 1.0), ("None", -0.75), ("None", 0.25), ("bbbb", 1.0)]


def test_length_of_words_counts_wide_characters_twice(spark):
    frame = spark.createDataFrame([(1, "\U0001f600\U0001f600 \U0001f600 ab abc a\U0001f600")], "k int, body string")
    counts = terms.term_counts(frame, ["k"], "body", [])
    assert sorted(r["word"] for r in counts.collect()) == sorted(["\U0001f600\U0001f600", "abc", "a\U0001f600"])


@pytest.mark.parametrize("chars", [0, 1 << 20])
@pytest.mark.parametrize("frequent", [1, 4, 100_000])
def test_stop_tables_of_any_size_agree(spark, monkeypatch, chars, frequent):
    monkeypatch.setattr(terms, "BROADCAST_CHARS", chars)
    monkeypatch.setattr(terms, "FREQUENT_WORDS", frequent)
    bodies = [(i, f"common word{i} word{i % 5} stopped " + "x" * (60 + i)) for i in range(20)]
    frame = spark.createDataFrame(bodies, "k int, body string")
    stop = spark.createDataFrame([("stopped",), ("word3",), (None,), ("stopped",), ("x" * 70,)], "w string")
    counts = terms.term_counts(frame, ["k"], "body", stop).collect()
    gone = {"stopped", "word3", "x" * 70}
    expected = sorted((k, w) for k, body in bodies for w in set(body.split()) - gone)
    assert sorted((r["k"], r["word"]) for r in counts) == expected


@pytest.mark.parametrize("seed", range(4))
def test_bounds_lose_none_of_the_best(spark, seed):
    """Against the full ranking on messages of very different lengths, ties included."""
    draw = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(80)]
    rows = [
        (f"s{i}", i, " ".join(draw.choices(vocabulary, weights=[1 / (k + 1) for k in range(80)], k=draw.choice([0, 3, 15, 60, 800]))))
        for i in range(60)
    ] + [("null", 0, None)]
    emails = spark.createDataFrame(rows, "`from` string, ts long, body string")
    counts = terms.term_counts(emails.where("body is not null"), ["from", "ts"])
    for n in (1, 3, 10):
        got = keywords.message_keywords(emails, n=n).collect()
        wanted = keywords.keywords_of_counts(counts, n).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_few_rows_reach_the_window(spark):
    """Of long messages only words near the best are joined and ranked."""
    words = [f"common{i} " * (40 - i) for i in range(12)] + [f"single{i} " for i in range(500)]
    rows = [("a", i, "".join(words)) for i in range(20)]
    emails = spark.createDataFrame(rows, "`from` string, ts long, body string")
    frequency = terms.message_frequency(emails)
    reached = terms.reachable_counts(emails, ["from", "ts"], frequency, 10)
    every = terms.term_counts(emails, ["from", "ts"])
    assert (reached.count(), every.count()) == (20 * 10, 20 * 512)
    plan = plan_of(reached)
    assert "Window" not in plan and "Join" not in plan


def test_one_word_vocabulary_has_no_bound(spark):
    emails = spark.createDataFrame([("a", 1, "apple"), ("b", 1, "apple apple")], "`from` string, ts long, body string")
    assert terms.reachable_counts(emails, ["from"], terms.message_frequency(emails.limit(1)), 1).count() == 2


def test_stored_runs_give_the_same_keywords_and_scores(spark, tmp_path):
    """No text is read again for the frequencies, the near words and the far ones."""
    bodies = ["one two two three", "two\tthree four \x01five", "five\n five  one", None, "", "the", "éé éé x" + "y" * 70]
    frame = emails(spark, bodies * 3).withColumn("ts", F.monotonically_increasing_id())
    path = str(tmp_path / "runs")
    terms.message_runs(frame, ["from", "ts"], "body", STOP).write.parquet(path)
    runs = spark.read.parquet(path)
    for n, frequent in ((1, 1), (3, 2), (10, 100_000)):
        wanted = keywords.message_keywords(frame, STOP, n, frequent).collect()
        assert sorted(map(tuple, keywords.keywords_of_runs(runs, n, frequent).collect())) == sorted(map(tuple, wanted))
    stored = terms.counts_of_runs(runs, ["from", "ts"])
    counts = terms.term_counts(frame, ["from", "ts"], "body", STOP)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, counts.collect()))
    assert not stored.schema["word"].nullable
    assert "body" not in plan_of(keywords.keywords_of_runs(runs))
