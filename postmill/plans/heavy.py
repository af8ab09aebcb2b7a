"""Top pairs without counting all pairs.

A frequent-items sketch finds candidates in one pass: each task holds a bounded number of
counters, and sketches are merged.  What the sketch has not listed occurs at most as often
as its error bound or its last listed estimate says.  The candidates alone, a bounded
number of them, are then counted exactly.  If the n-th of them beats the bound, no other
pair can be among the n best; if not, all pairs are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000
#: Candidates that are counted exactly, for each of the n best asked for.
MARGIN = 20
#: A sketch that tracks m items is off by 3.5 / m of all rows at most, and lists no item whose
#: lower bound is below that: what it leaves out may have twice as much.
ERROR = 7.0


def candidates(rows: DataFrame, keys: list[str], n: int, tracked: int = TRACKED) -> tuple[DataFrame, float]:
    """Up to ``MARGIN * n`` frequent keys, and how often any other can occur at most."""
    listed = min(MARGIN * n, tracked // 2)
    # The sketch takes one text: lengths before the parts keep different keys different.
    parts = [F.concat(F.length(k).cast("string"), F.lit(":"), F.col(k)) for k in keys]
    named = rows.select(*keys, F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]).alias("item"))
    found = named.agg(
        F.expr(f"approx_top_k(item, {listed}, {tracked})").alias("top"), F.count(F.lit(1)).alias("total")
    ).first()
    names = [cell["item"] for cell in found["top"]]
    bound = ERROR / tracked * found["total"]
    if len(names) == listed:
        bound = max(bound, found["top"][-1]["count"])
    chosen = rows.sparkSession.createDataFrame([(name,) for name in names], "item string")
    return named.join(F.broadcast(chosen), "item").select(*keys), bound


def top_counts(rows: DataFrame, keys: list[str], n: int, count: str = "count", tracked: int = TRACKED) -> DataFrame:
    """The ``n`` keys of the most rows, ties in key order: keys and ``count``.

    The same rows as a full count, sort and limit.  The plan is made by running the
    sketch and the exact count of the candidates; where their n-th does not beat the
    bound, the full count is returned.  ``keys`` are text columns; null is a value.
    """
    if n < 1:
        raise ValueError("n must be at least 1")

    def best(some: DataFrame) -> DataFrame:
        counts = some.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
        return counts.orderBy(F.col(count).desc(), *keys).limit(n)

    some, bound = candidates(rows, keys, n, tracked)
    found = best(some)
    counted = found.collect()  # n rows
    proven = len(counted) == n and counted[-1][count] > bound
    return found if proven else best(rows)
