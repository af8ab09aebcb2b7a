"""Versioned cells.

A table keeps one row per (key, version); each value column is a cell that may
be absent (null).  All versions of a column are therefore *rows*, never one
array per key: a key that holds a third of the corpus stays spread over the
cluster.  Arrays are built only under a version bound.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Target table -> name of its sender column.  Both keep one row per (sender, ts).
TARGETS = {"emails": "from", "employee": "employee"}

# Up to this bound Spark cuts each partition to N rows per key before the
# shuffle by itself (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# Beyond it, parts of a key are cut in rounds; each joins so many parts into one.
PARTS = 4096
# Keys of several rows that are broadcast, at most.
BROADCAST_KEYS = 500_000
FAN_IN = 8


def key_for_target(messages: DataFrame, target: str) -> DataFrame:
    """Add the sender key of the target table.

    ``emails`` is keyed by (from, ts); ``employee`` by the sender alone, with
    ``ts`` as the version of its cells.  Another target raises ``ValueError``.
    """
    if target not in TARGETS:
        raise ValueError(f"unsupported table: {target!r}")
    return messages.withColumn(TARGETS[target], F.col("from"))


def upsert(cells: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row per key; each column takes its last non-null value by ``order``.

    The columns are independent: a field that a later row lacks keeps the value
    of an earlier one.  Rows of one key are combined inside each task before
    the only shuffle, so copies of one message never pile up on a reducer.
    Columns the caller drops are pruned from the aggregate.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return cells.groupBy(*keys).agg(*last)


def upsert_stored(cells: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The same rows as :func:`upsert`, for a stored table whose keys are mostly unique.

    A narrow pass over the keys finds those of several rows.  Where they have been
    counted to be few they are broadcast: rows of all other keys then pass as they
    are, without a sort or a shuffle of their texts, and only the rest is combined.
    """
    several = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    several = several.select(*[F.col(k).alias(f"__of_{k}") for k in keys])
    if several.count() > BROADCAST_KEYS:
        return upsert(cells, keys, order, columns)
    several = F.broadcast(several)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    single = cells.join(several, same, "left_anti").select(*keys, *columns)
    return single.unionByName(upsert(cells.join(several, same, "left_semi"), keys, order, columns))


def merge_into(stored: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Upsert a keyed load into a stored table; the load wins cell by cell."""
    both = stored.select(*keys, *columns, F.lit(0).alias("load")).unionByName(
        incoming.select(*keys, *columns, F.lit(1).alias("load"))
    )
    return upsert(both, keys, "load", columns)


def column_versions(table: DataFrame, keys: list[str], version: str, column: str) -> DataFrame:
    """All versions of one column: keys, ``ts``, ``value``; absent cells are skipped."""
    return table.filter(F.col(column).isNotNull()).select(
        *keys, F.col(version).alias("ts"), F.col(column).alias("value")
    )


def all_versions(table: DataFrame, keys: list[str], version: str, columns: list[str]) -> DataFrame:
    """All versions of several columns of one type: keys, ``ts``, ``column``, ``value``."""
    ids = [*[F.col(k) for k in keys], F.col(version).alias("ts")]
    narrow = table.select(*ids, *[F.col(c) for c in columns])
    return narrow.unpivot([*keys, "ts"], columns, "column", "value").filter(F.col("value").isNotNull())


def latest_versions(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The newest cell per key (add ``column`` to the keys for several columns)."""
    return cells.groupBy(*keys).agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))


def newest_versions(cells: DataFrame, keys: list[str], max_versions: int) -> DataFrame:
    """The newest ``max_versions`` cells per key, as rows.

    Each task keeps its own newest N per key before the shuffle.  Above Spark's
    group limit a key is split into parts, and the newest N of a few parts at a time
    are kept, so that no task holds more than a few times N rows of a key.
    """
    if max_versions < 1:
        raise ValueError("max_versions must be at least 1")
    newest_first = F.col("ts").desc()

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(newest_first))
        return rows.withColumn("__rank", rank).filter(F.col("__rank") <= max_versions).drop("__rank")

    if max_versions >= GROUP_LIMIT:
        parts = PARTS
        cells = cells.withColumn("__part", F.pmod(F.xxhash64("ts"), F.lit(parts)))
        while parts > 1:
            cells = cut(cells, [*keys, "__part"]).withColumn("__part", F.floor(F.col("__part") / FAN_IN))
            parts //= FAN_IN
        cells = cells.drop("__part")
    return cut(cells, keys)


def version_thresholds(cells: DataFrame, keys: list[str], max_versions: int) -> DataFrame:
    """Of each key with more than ``max_versions`` cells the instant of the oldest one to keep:
    keys, ``oldest``.

    A narrow count finds these keys; only their instants are ranked, each task passing on
    its newest ``max_versions`` of a key.
    """
    over = version_counts(cells, keys).where(F.col("versions") > max_versions)
    over = over.select(*[F.col(k).alias(f"__of_{k}") for k in keys])
    if over.count() <= BROADCAST_KEYS:
        over = F.broadcast(over)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    narrow = cells.select(*keys, "ts").join(over, same, "left_semi")
    return newest_versions(narrow, keys, max_versions).groupBy(*keys).agg(F.min("ts").alias("oldest"))


def compact_versions(cells: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that the bound keeps: those at or after their key's threshold, and all of other keys.

    Few thresholds, which are counted here, are broadcast: no cell is then shuffled,
    whatever share of them one key has.  Each key has one cell an instant; of cells that
    share the oldest instant all stay.  ``thresholds`` is best a stored table.
    """
    oldest = thresholds.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "oldest")
    if thresholds.count() <= BROADCAST_KEYS:
        oldest = F.broadcast(oldest)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    kept = cells.join(oldest, same, "left").where(F.col("oldest").isNull() | (F.col("ts") >= F.col("oldest")))
    return kept.select(*cells.columns)


def version_arrays(cells: DataFrame, keys: list[str], max_versions: int) -> DataFrame:
    """Per key the newest cells as ``array<struct<ts, value>>``, newest first.

    The bound is required: an array of every version of a hot key would be one
    row of unbounded size.  Use the row form for all versions.
    """
    kept = newest_versions(cells, keys, max_versions)
    cell = F.struct("ts", "value")
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(cell), asc=False).alias("cells"))


def version_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Number of versions per key."""
    return cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))


def version_timestamps(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The timestamps at which a column has a value."""
    return cells.select(*keys, "ts")


def value_at(cells: DataFrame, ts: int) -> DataFrame:
    """The cells written at one timestamp."""
    return cells.filter(F.col("ts") == F.lit(ts))


def copy_column(cells: DataFrame, source: str, target: str) -> DataFrame:
    """Every version of ``source`` again under the column name ``target``, unchanged.

    ``cells`` is the row form with a ``column`` field; on a table in its wide
    form the same is ``withColumn(target, col(source))``.
    """
    return cells.filter(F.col("column") == source).withColumn("column", F.lit(target))


def select_cells(
    cells: DataFrame, keys: list[str], columns: list[str], max_versions: int | None = None
) -> DataFrame:
    """Chosen columns of the row form, with an optional bound on the versions of each."""
    wanted = cells.filter(F.col("column").isin(columns))
    if max_versions is None:
        return wanted
    return newest_versions(wanted, [*keys, "column"], max_versions)


def version_table(cells: DataFrame, keys: list[str], columns: list[str], max_versions: int) -> DataFrame:
    """One row per key with an array of cells per column, newest first.

    ``cells`` is the row form with a ``column`` field.  Each array holds at most
    ``max_versions`` cells, and an absent column gives an empty array.
    """
    kept = select_cells(cells, keys, columns, max_versions)
    arrays = [
        F.sort_array(F.collect_list(F.when(F.col("column") == c, F.struct("ts", "value"))), asc=False).alias(c)
        for c in columns
    ]
    return kept.groupBy(*keys).agg(*arrays)
