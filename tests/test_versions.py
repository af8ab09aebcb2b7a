from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postmill.operators import counting, versions
from tests.conftest import plan_of


@pytest.fixture
def cells(spark):
    rows = [("k1", ts, f"v{ts}") for ts in range(12)] + [("k2", 5, "x")]
    return spark.createDataFrame(rows, "key string, ts bigint, value string")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_upsert_takes_the_last_value_of_each_column(spark):
    frame = spark.createDataFrame(
        [("a", 1, "p2", None, "s2"), ("a", 1, "p1", "t1", "s1"), ("a", 2, "p3", None, None)],
        "key string, ts bigint, path string, to string, subject string",
    )
    merged = versions.upsert(frame, ["key", "ts"], "path", ["to", "subject"])
    assert rows(merged.fillna("-")) == [("a", 1, "t1", "s2"), ("a", 2, "-", "-")]
    assert rows(versions.upsert(frame.unionByName(frame), ["key", "ts"], "path", ["to", "subject"])) == rows(merged)


def test_upsert_combines_copies_before_the_shuffle(spark):
    frame = spark.range(10).select(
        F.lit("hot").alias("key"), F.col("id").alias("path"), F.col("id").cast("string").alias("v")
    )
    merged = versions.upsert(frame, ["key"], "path", ["v"])
    plan = plan_of(merged)
    assert "partial_max_by" in plan and plan.count("Exchange") == 1
    assert rows(merged) == [("hot", "9")]


def test_unused_columns_are_pruned(spark):
    frame = spark.range(10).selectExpr("id as key", "id as path", "string(id) as v", "repeat('x', 9) as body")
    plan = plan_of(versions.upsert(frame, ["key"], "path", ["v", "body"]).select("key", "v"))
    assert "repeat" not in plan and "xxxxxxxxx" not in plan


def test_merge_into(spark):
    stored = spark.createDataFrame([("a", "1", "2"), ("b", "3", None)], "key string, x string, y string")
    load = spark.createDataFrame([("a", None, "9"), ("c", "7", None)], "key string, x string, y string")
    merged = versions.merge_into(stored, load, ["key"], ["x", "y"]).fillna("-")
    assert rows(merged) == [("a", "1", "9"), ("b", "3", "-"), ("c", "7", "-")]


def test_latest_and_bounds(cells):
    assert rows(versions.latest_versions(cells, ["key"])) == [("k1", 11, "v11"), ("k2", 5, "x")]
    kept = rows(versions.newest_versions(cells, ["key"], 10))
    assert kept == sorted([("k1", ts, f"v{ts}") for ts in range(2, 12)] + [("k2", 5, "x")])
    arrays = {r["key"]: [tuple(c) for c in r["cells"]] for r in versions.version_arrays(cells, ["key"], 3).collect()}
    assert arrays == {"k1": [(11, "v11"), (10, "v10"), (9, "v9")], "k2": [(5, "x")]}
    assert rows(versions.version_counts(cells, ["key"])) == [("k1", 12), ("k2", 1)]
    with pytest.raises(ValueError):
        versions.newest_versions(cells, ["key"], 0)


def test_small_bound_is_cut_before_the_shuffle(cells):
    assert plan_of(versions.newest_versions(cells, ["key"], 10)).count("WindowGroupLimit") == 2


def test_large_bound_gives_the_same_rows(spark):
    frame = spark.range(5000).selectExpr("if(id < 4000, 'hot', 'cold') as key", "id as ts", "id as value")
    kept = versions.newest_versions(frame, ["key"], 1500)
    got = {r["key"]: (r["n"], r["low"]) for r in kept.groupBy("key").agg(F.count("*").alias("n"), F.min("ts").alias("low")).collect()}
    assert got == {"hot": (1500, 2500), "cold": (1000, 4000)}


def test_cells_of_a_table(spark):
    table = spark.createDataFrame(
        [("a", 1, "x", None), ("a", 2, None, "y")], "key string, version bigint, p string, q string"
    )
    assert rows(versions.column_versions(table, ["key"], "version", "p")) == [("a", 1, "x")]
    every = versions.all_versions(table, ["key"], "version", ["p", "q"])
    assert rows(every) == [("a", 1, "p", "x"), ("a", 2, "q", "y")]
    assert rows(versions.copy_column(every, "p", "r")) == [("a", 1, "r", "x")]
    assert rows(versions.version_timestamps(every, ["key"])) == [("a", 1), ("a", 2)]
    assert rows(versions.value_at(every, 2)) == [("a", 2, "q", "y")]
    assert rows(versions.select_cells(every, ["key"], ["q"])) == [("a", 2, "q", "y")]
    assert rows(versions.select_cells(every, ["key"], ["p", "q"], 1)) == rows(every)


def test_version_table(spark):
    table = spark.createDataFrame(
        [("a", 1, "x1", None), ("a", 2, "x2", "y2"), ("a", 3, "x3", None)],
        "key string, version bigint, p string, q string",
    )
    cells = versions.all_versions(table, ["key"], "version", ["p", "q"])
    [row] = versions.version_table(cells, ["key"], ["p", "q"], 2).collect()
    assert [tuple(c) for c in row["p"]] == [(3, "x3"), (2, "x2")]
    assert [tuple(c) for c in row["q"]] == [(2, "y2")]


def test_targets(spark):
    frame = spark.createDataFrame([("s", 4)], "`from` string, ts bigint")
    assert versions.key_for_target(frame, "emails").first().asDict() == {"from": "s", "ts": 4}
    assert versions.key_for_target(frame, "employee").first()["employee"] == "s"
    with pytest.raises(ValueError):
        versions.key_for_target(frame, "users")


def test_value_counting(spark, cells):
    same = cells.withColumn("value", F.when(F.col("ts") < 3, "low").otherwise("high"))
    assert rows(counting.value_counts(same)) == [("high", 10), ("low", 3)]
    pairs = counting.value_pairs(same)
    assert pairs.schema.simpleString() == "struct<key:struct<id:string>,one:bigint>"
    assert pairs.count() == 13


def test_grouped_pass_through_splits_a_hot_key(spark):
    picker = random.Random(1)
    data = [("hot" if picker.random() < 0.7 else picker.choice("abcxyz"), i) for i in range(4000)]
    pairs = spark.createDataFrame(data, "key string, value int").repartition(16)
    grouped = counting.grouped_by_key(pairs, "key", 8)
    placed = grouped.withColumn("part", F.spark_partition_id()).collect()
    assert sorted((r["key"], r["value"]) for r in placed) == sorted(data)
    # collected in partition order: one key after the other
    keys = [r["key"] for r in placed]
    assert keys == sorted(keys)
    assert len({r["part"] for r in placed if r["key"] == "hot"}) > 2


@pytest.mark.parametrize("bound", [0, 500_000])
def test_stored_upsert_gives_the_same_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(versions, "BROADCAST_KEYS", bound)
    rng = random.Random(4)
    data = [
        (rng.choice(["a", "b", None, f"s{i}"]), rng.choice([1, None, i]), f"p{i:04}", rng.choice([None, f"x{i}"]), rng.choice([None, f"y{i}"]))
        for i in range(300)
    ]
    data += [("hot", 1, f"q{i:04}", "x", None) for i in range(300)]
    frame = spark.createDataFrame(data, "k string, ts bigint, path string, x string, y string")
    args = ["k", "ts"], "path", ["x", "y"]
    assert sorted(map(str, versions.upsert_stored(frame, *args).collect())) == sorted(
        map(str, versions.upsert(frame, *args).collect())
    )


def test_unique_keys_pass_without_a_shuffle(spark, tmp_path):
    frame = spark.createDataFrame([(f"k{i % 50}", i // 50, f"p{i}", "body") for i in range(99)], "k string, ts bigint, path string, body string")
    frame.write.parquet(str(tmp_path / "t"))
    merged = versions.upsert_stored(spark.read.parquet(str(tmp_path / "t")), ["k", "ts"], "path", ["body"])
    single = plan_of(merged.where("k is not null")).split("SortAggregate")[0]
    assert "LeftAnti" in single and merged.count() == 99
