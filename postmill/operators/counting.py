"""Counting the values of a column, and grouped pass-through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_pairs(cells: DataFrame) -> DataFrame:
    """One (record, 1) pair per cell version: ``key struct<id>``, ``one``."""
    return cells.select(
        F.struct(F.col("value").cast("string").alias("id")).alias("key"),
        F.lit(1).cast("bigint").alias("one"),
    )


def value_counts(cells: DataFrame) -> DataFrame:
    """Number of cell versions per value: ``id``, ``n``."""
    return cells.groupBy(F.col("value").cast("string").alias("id")).agg(F.count(F.lit(1)).alias("n"))


def grouped_by_key(pairs: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """All pairs unchanged, with equal keys next to each other in key order.

    Range partitions over (key, source partition): one key may fill many
    partitions in a row instead of one task.  The source partition number is
    the same in every run of a task, so a retry sends each row the same way.
    """
    placed = pairs.withColumn("__part", F.spark_partition_id())
    columns = [F.col(key), F.col("__part")]
    if partitions is None:
        spread = placed.repartitionByRange(*columns)
    else:
        spread = placed.repartitionByRange(partitions, *columns)
    return spread.sortWithinPartitions(key).drop("__part")
