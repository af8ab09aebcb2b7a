from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from postmill.operators import versions
from postmill.sinks import bucketed
from tests.conftest import plan_of

KEYS = ["k", "t"]
SCHEMA = "k string, t long, a string, b double"


def files(path):
    """Names and times of the files of each bucket."""
    out = {}
    for folder, _, names in os.walk(f"{path}/rows"):
        if "bucket=" in folder:
            number = int(folder.rsplit("=", 1)[1])
            out[number] = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


@pytest.fixture
def table(spark, tmp_path):
    rows = [(f"k{i % 50}", i, f"a{i}", float(i)) for i in range(500)] + [(None, 1, "null key", 0.5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "table")
    bucketed.write_buckets(frame, path, KEYS, 32)
    return frame, path


def lines(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def test_round_trip(spark, table):
    frame, path = table
    assert lines(bucketed.read_buckets(spark, path)) == lines(frame)
    assert bucketed.layout(spark, path) == (KEYS, 32)
    assert max(len(names) for names in files(path).values()) == 1


def test_only_touched_buckets_are_rewritten(spark, table):
    frame, path = table
    before = files(path)
    load = spark.createDataFrame(
        [("k1", 1, None, -1.0), ("k1", 51, "new", None), ("new", 9, "new", 2.0), (None, 1, "seen", None)], SCHEMA
    )
    touched = bucketed.upsert_buckets(load, path)
    after = files(path)
    assert 1 <= len(touched) <= 4
    assert {n for n in before if before[n] != after.get(n)} | (after.keys() - before.keys()) == set(touched)
    wanted = versions.merge_into(frame, load, KEYS, ["a", "b"])
    assert lines(bucketed.read_buckets(spark, path)) == lines(wanted)
    # Loading it again changes nothing; an empty load rewrites nothing.
    bucketed.upsert_buckets(load, path)
    assert lines(bucketed.read_buckets(spark, path)) == lines(wanted)
    again = files(path)
    assert bucketed.upsert_buckets(load.limit(0), path) == [] and files(path) == again


def test_a_load_may_lack_columns_but_bring_none(spark, table):
    frame, path = table
    load = spark.createDataFrame([("k2", 2, "x")], "k string, t long, a string")
    bucketed.upsert_buckets(load, path)
    row = bucketed.read_buckets(spark, path).where("k = 'k2' and t = 2").first()
    assert (row["a"], row["b"]) == ("x", 2.0)
    with pytest.raises(ValueError, match="lacks"):
        bucketed.upsert_buckets(load.withColumn("c", F.lit(1)), path)


def test_plan_reads_the_touched_buckets_and_deals_once(spark, table):
    _, path = table
    load = spark.createDataFrame([("k1", 1, "x", 1.0)], SCHEMA)
    plan = plan_of(bucketed.merged_buckets(spark, path, load))
    [scan] = [line for line in plan.splitlines() if "FileScan" in line]
    assert "PartitionFilters: [isnotnull(bucket" in scan and "bucket#" in scan.split("PartitionFilters")[1].split("]")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_names_that_clash(spark, tmp_path):
    frame = spark.createDataFrame([("k", 1, 2)], "k string, load int, __n int")
    path = str(tmp_path / "clash")
    bucketed.write_buckets(frame, path, ["k"], 2)
    bucketed.upsert_buckets(spark.createDataFrame([("k", 5)], "k string, load int"), path)
    assert bucketed.read_buckets(spark, path).select("k", "load", "__n").collect() == [("k", 5, 2)]
    with pytest.raises(ValueError, match="bucket"):
        bucketed.write_buckets(frame.withColumn("Bucket", F.lit(1)), str(tmp_path / "no"), ["k"], 2)
    with pytest.raises(ValueError, match="at least one"):
        bucketed.write_buckets(frame, str(tmp_path / "no"), ["k"], 0)
