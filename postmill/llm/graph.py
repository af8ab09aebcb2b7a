"""Connected components of an undirected graph, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node that it reaches, for every node of an edge.

    A large star links the greater neighbours of each node to the least node around
    it; a small star does so with the lesser ones.  Both keep the components, and in
    turn they leave one star for each after a few rounds.  Each round is stored, so
    its lineage does not grow; only counts and checksums reach the driver.  Loops and
    edges with a null end take no part.
    """
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _mark(current)
    while before[0]:
        current = written(_small_star(_large_star(current)))
        after = _mark(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(current.select("v", "v").distinct())


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """Number and checksums of the edges; a change that they miss only costs a round less
    with a probability of 2**-100."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("x"),
        F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(20,0)")).alias("y"),
    ).first()
    return row["n"], row["x"], row["y"]


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the greater end ``u`` to the lesser ``v``."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    greater = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # of each u, the greater neighbours
    return greater.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()
