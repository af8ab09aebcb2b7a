from __future__ import annotations

import random

import pytest

from postmill.plans import heavy

KEYS = ["a", "b"]


def full(rows, n):
    counts: dict = {}
    for row in rows:
        counts[row] = counts.get(row, 0) + 1
    null_first = lambda key: tuple((part is not None, part or "") for part in key)
    return [(*k, c) for k, c in sorted(counts.items(), key=lambda x: (-x[1], null_first(x[0])))][:n]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "a string, b string")


def test_candidates_prove_the_best(spark, monkeypatch):
    draw = random.Random(1)
    rows = [("hot", f"r{i}") for i in range(10) for _ in range(200 + 3 * i)]
    rows += [(f"s{draw.randrange(3000)}", "x") for _ in range(4000)] + [(None, "r"), (None, None)] * 150
    draw.shuffle(rows)
    frame = frame_of(spark, rows)
    asked = []
    candidates = heavy.candidates
    monkeypatch.setattr(heavy, "candidates", lambda *a: asked.append(candidates(*a)) or asked[-1])
    got = heavy.top_counts(frame, KEYS, 10, tracked=512)
    assert [tuple(r) for r in got.collect()] == full(rows, 10)
    some, bound = asked[0]
    assert some.select(*KEYS).distinct().count() <= 200 and full(rows, 10)[-1][-1] > bound
    assert "Join" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("tracked", [16, 64])
def test_full_count_where_the_bound_proves_nothing(spark, tracked):
    """Many keys of about one frequency, ties at the edge included."""
    rows = [(f"k{i % 300}", "x") for i in range(1500)] + [("k7", "x")] * 2
    got = heavy.top_counts(frame_of(spark, rows), KEYS, 5, tracked=tracked)
    assert [tuple(r) for r in got.collect()] == full(rows, 5)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_keys_whose_parts_run_together_stay_apart(spark):
    rows = [("a1:", "b")] * 3 + [("a", "1:b")] * 2 + [("a1", ":b")] + [("", "")] * 4 + [("-", None)] * 5 + [(None, "-")] * 6
    assert [tuple(r) for r in heavy.top_counts(frame_of(spark, rows), KEYS, 9).collect()] == full(rows, 9)


def test_few_rows_and_none(spark):
    assert heavy.top_counts(frame_of(spark, [("a", "b")]), KEYS, 3).collect() == [("a", "b", 1)]
    assert heavy.top_counts(frame_of(spark, [("a", "b")]).limit(0), KEYS, 3).collect() == []
    with pytest.raises(ValueError, match="at least 1"):
        heavy.top_counts(frame_of(spark, []), KEYS, 0)
