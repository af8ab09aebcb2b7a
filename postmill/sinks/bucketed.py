"""Keyed tables in hash buckets, of which an upsert rewrites those that it touches.

A table is a folder ``rows`` with one directory a bucket, and a folder ``layout`` with one
row: the keys and the number of buckets.  A load goes to the buckets of its keys.  Only
these are read (a partition filter), merged and written again, by dynamic partition
overwrite; the files of all other buckets stay as they are, names and times included.

A load that has been interrupted may have replaced some of its buckets.  Running it again
gives the whole result: cells of the load win whether they are there already or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import versions

BUCKET = "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row: a hash of its keys; null keys have one, too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: list[str], mode: str) -> None:
    writer = rows.sortWithinPartitions(BUCKET, *keys).write.mode(mode).partitionBy(BUCKET)
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")


def write_buckets(table: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Store a table whose keys are unique.  Choose ``buckets`` so that one holds some 100 MB.

    Rows are rebalanced by bucket: a bucket is in few files, and adaptive execution splits
    one that is too large for a task.
    """
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    if BUCKET in map(str.lower, table.columns):
        raise ValueError(f"the name {BUCKET!r} is that of the folders")
    spark = table.sparkSession
    rows = table.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(BUCKET))
    _write(rows, path, keys, "errorifexists")
    spark.createDataFrame([(keys, buckets)], "keys array<string>, buckets int").coalesce(1).write.parquet(f"{path}/layout")


def layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Keys and number of buckets of a stored table."""
    row = spark.read.parquet(f"{path}/layout").first()
    return list(row["keys"]), row["buckets"]


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now, without its bucket column."""
    return spark.read.parquet(f"{path}/rows").drop(BUCKET)


def touched_buckets(load: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Buckets of a load, in their order: as many numbers as there are buckets, at most."""
    found = load.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()
    return sorted(row[BUCKET] for row in found)


def touched_rows(spark: SparkSession, path: str, touched: list[int]) -> DataFrame:
    """Stored rows of some buckets, with their bucket; no file of another one is opened."""
    return spark.read.parquet(f"{path}/rows").where(F.col(BUCKET).isin(touched))


def merged_buckets(spark: SparkSession, path: str, load: DataFrame) -> DataFrame:
    """The touched buckets as they are after ``load``, whose cells win where they are not null.

    ``load`` has one row a key (``versions.upsert`` makes it so) and may lack value
    columns.  The rows are dealt by bucket once: the merge and the files share the shuffle.
    """
    keys, buckets = layout(spark, path)
    stored = touched_rows(spark, path, touched_buckets(load, keys, buckets))
    columns = [c for c in stored.columns if c not in [*keys, BUCKET]]
    unknown = set(load.columns) - {*keys, *columns}
    if unknown:
        raise ValueError(f"columns that the table lacks: {sorted(unknown)}")
    incoming = load.withColumn(BUCKET, bucket_of(keys, buckets))
    lacking = {c: F.lit(None).cast(stored.schema[c].dataType) for c in columns if c not in load.columns}
    incoming = incoming.withColumns(lacking) if lacking else incoming
    both = stored.select(BUCKET, *keys, *columns, F.lit(0).alias("__load")).unionByName(
        incoming.select(BUCKET, *keys, *columns, F.lit(1).alias("__load"))
    )
    return versions.upsert(both.repartition(BUCKET), [BUCKET, *keys], "__load", columns)


def upsert_buckets(load: DataFrame, path: str) -> list[int]:
    """Merge a load with unique keys into the stored table; gives the buckets that were rewritten.

    An empty load rewrites nothing.
    """
    spark = load.sparkSession
    keys, buckets = layout(spark, path)
    touched = touched_buckets(load, keys, buckets)
    if touched:
        columns = spark.read.parquet(f"{path}/rows").columns
        _write(merged_buckets(spark, path, load).select(columns), path, keys, "overwrite")
        spark.catalog.refreshByPath(path)
    return touched
