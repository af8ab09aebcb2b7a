"""Values as of an instant: for each asked (key, instant) the newest cell at or before it.

Cells and asked instants of a key are merged in time order.  A key of many rows is cut
into time slices of about ``SLICE_ROWS`` rows, at quantiles that are found with one
mergeable sketch a key; each slice is a window of its own.  What was current at the end
of the slices before is carried over from a small table with one row a slice.  No task
thus holds a whole hot key, and the cells are shuffled once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key that stay together.
SLICE_ROWS = 1_000_000
#: Slices of one key, at most: a limit of the sketch, not of the data.
MAX_SLICES = 10_000


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def slice_edges(points: DataFrame, keys: list[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``edges`` of each key with more than ``slice_rows`` rows: instants at which a slice ends.

    ``points`` has the keys and ``t``.  All edges together are about twice the rows
    divided by ``slice_rows``.
    """
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > slice_rows)
    largest = sizes.agg(F.max("n")).first()[0] or 0
    parts = max(2, min(MAX_SLICES, -(-largest // slice_rows)))
    hot = sizes.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "n")
    rows = points.join(F.broadcast(hot), _same(keys, "__of_"))
    fractions = F.lit([i / parts for i in range(1, parts)])
    sketched = rows.groupBy(*keys, "n").agg(F.percentile_approx("t", fractions, max(10_000, 4 * parts)).alias("every"))
    # A key of fewer rows takes each so-manieth of the quantiles.
    step = F.greatest(F.lit(1), F.floor(parts / F.ceil(F.col("n") / slice_rows)))
    chosen = F.filter("every", lambda _, i: (i + 1) % F.col("step") == 0)
    return sketched.withColumn("step", step).select(*keys, F.array_distinct(chosen).alias("edges"))


def values_as_of(
    cells: DataFrame, asks: DataFrame, keys: list[str], at: str = "at", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``asks`` with ``ts`` and ``value`` of the newest cell of the same keys whose ``ts`` is at most ``at``.

    ``cells`` has the keys, ``ts`` and ``value``, one cell for each key and ``ts``.  An
    ask before the first cell, of an unknown key or without an instant has nulls.  Null
    keys are equal; a cell with a null value counts as none.  Equal asks are answered
    once and joined back.
    """
    keyed = [F.col(k) for k in keys]
    kept = cells.where(F.col("value").isNotNull() & F.col("ts").isNotNull())
    found = kept.select(*keyed, F.col("ts").alias("t"), F.lit(0).alias("kind"), F.struct("ts", "value").alias("cell"))
    wanted = asks.where(F.col(at).isNotNull()).select(*keyed, F.col(at).alias("t")).distinct()
    both = found.unionByName(wanted.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    edges = slice_edges(both.select(*keys, "t"), keys, slice_rows)
    edges = F.broadcast(edges.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "edges"))
    place = F.coalesce(F.size(F.filter("edges", lambda e: e < F.col("t"))), F.lit(0))
    sliced = both.join(edges, _same(keys, "__of_"), "left").withColumn("slice", F.when(F.col("edges").isNull(), 0).otherwise(place))
    in_order = Window.partitionBy(*keys, "slice").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    walked = sliced.select(*keys, "slice", "t", "kind", F.last("cell", ignorenulls=True).over(in_order).alias("cell"))
    answers = walked.where("kind = 1")

    # The last cell of each slice, and of that what is carried into the next ones.
    ends = sliced.where("kind = 0 and edges is not null").groupBy(*keys, "slice").agg(F.max_by("cell", "t").alias("end"))
    every = edges.select(*[F.col(f"__of_{k}").alias(k) for k in keys], F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("slice"))
    ended = _joined(every, ends, [*keys, "slice"], ["end"])
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ended.select(*keys, "slice", F.last("end", ignorenulls=True).over(before).alias("carried"))
    filled = _joined(answers, carried, [*keys, "slice"], ["carried"])
    cell = F.coalesce("cell", "carried")
    result = filled.select(*keys, F.col("t").alias(at), cell["ts"].alias("ts"), cell["value"].alias("value"))
    columns = [c for c in asks.columns if c not in ("ts", "value")]
    return _joined(asks.select(*columns), result, [*keys, at], ["ts", "value"])


def _joined(left: DataFrame, right: DataFrame, on: list[str], added: list[str]) -> DataFrame:
    """Left join in which null keys are equal; adds columns of the right side."""
    named = right.select(*[F.col(c).alias(f"__in_{c}") for c in on], *added)
    return left.join(named, _same(on, "__in_"), "left").select(*left.columns, *added)
