from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postmill.operators import asof, versions
from tests.conftest import plan_of


def plain(cells, asks):
    out = []
    for key, at in asks:
        found = [(ts, v) for k, ts, v in cells if k == key and v is not None and ts is not None and at is not None and ts <= at]
        out.append((key, at, *(max(found) if found else (None, None))))
    return sorted(map(str, out))


@pytest.mark.parametrize("slice_rows", [1, 7, 40, 10**6])
def test_against_a_plain_version(spark, slice_rows):
    """A key with most rows, null keys and instants, ties of cell and ask, repeated asks, unknown keys."""
    draw = random.Random(slice_rows)
    cells = [("hot", t, f"v{t}") for t in draw.sample(range(1000), 200)]
    cells += [(k, t, f"{k}{t}") for k in ("a", "b", None) for t in draw.sample(range(50), 5)]
    cells += [("hot", 2000, None), ("a", None, "no instant")]
    asks = [("hot", draw.randrange(-5, 1100)) for _ in range(150)] + [("hot", 500)] * 60
    asks += [(k, t) for k in ("a", "b", None, "none") for t in (0, 25, 60, None)]
    left = spark.createDataFrame(cells, "k string, ts long, value string")
    right = spark.createDataFrame(asks, "k string, at long")
    got = asof.values_as_of(left, right, ["k"], slice_rows=slice_rows)
    assert got.columns == ["k", "at", "ts", "value"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(cells, asks)
    if slice_rows == 7:
        edges = asof.slice_edges(left.select("k", F.col("ts").alias("t")), ["k"], 7).collect()
        assert [r["k"] for r in edges] == ["hot"] and len(edges[0]["edges"]) >= 20


def test_empty_sides_and_further_columns(spark):
    cells = spark.createDataFrame([("a", 1, 2.0)], "k string, ts long, value double")
    asks = spark.createDataFrame([("a", 5, "x", 9)], "k string, at long, note string, ts long")
    assert [tuple(r) for r in asof.values_as_of(cells, asks, ["k"]).collect()] == [("a", 5, "x", 1, 2.0)]
    assert asof.values_as_of(cells, asks.limit(0), ["k"]).count() == 0
    assert [tuple(r) for r in asof.values_as_of(cells.limit(0), asks, ["k"]).collect()] == [("a", 5, "x", None, None)]


def test_no_slice_holds_a_hot_key(spark):
    cells = spark.range(20_000).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    [row] = asof.slice_edges(cells, ["k"], 1000).collect()
    bounds = [-1, *row["edges"], 10**9]
    sizes = [cells.where((F.col("t") > a) & (F.col("t") <= b)).count() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert len(sizes) >= 15 and max(sizes) <= 2000


def test_compaction_keeps_the_newest_and_moves_no_cell(spark, tmp_path):
    rows = [("hot", t, f"v{t}") for t in range(300)] + [(f"k{i % 40}", i, "v") for i in range(200)] + [(None, t, "n") for t in range(9)]
    cells = spark.createDataFrame(rows, "k string, ts long, value string")
    versions.version_thresholds(cells, ["k"], 4).write.parquet(str(tmp_path / "oldest"))
    oldest = spark.read.parquet(str(tmp_path / "oldest"))
    assert {r["k"]: r["oldest"] for r in oldest.collect()}["hot"] == 296
    kept = versions.compact_versions(cells, oldest, ["k"])
    wanted = versions.newest_versions(cells, ["k"], 4)
    assert sorted(map(str, kept.collect())) == sorted(map(str, wanted.collect()))
    assert "hashpartitioning" not in plan_of(kept) and "rangepartitioning" not in plan_of(kept)
    # Once compacted, nothing is above the bound.
    assert versions.version_thresholds(kept, ["k"], 4).count() == 0
