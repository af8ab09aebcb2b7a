"""Document frequencies kept up to date by signed counts.

A load changes the frequency of a word by the messages that gain it less those that lose
it.  Only messages of the load are tokenised: their stored bodies count -1 for each of
their words, the bodies that replace them +1.  Words with a sum of zero drop out, so a
message that is loaded again unchanged leaves no trace.

Changes are appended to a stored table as files of their own, one folder a load; the
frequency is their sum.  :func:`compact` folds them into one.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import terms

LOAD = "load"


def _signed(bodies: DataFrame, body: str, stop_words: list[str] | None, sign: int) -> DataFrame:
    words = terms.message_words(bodies, [], body, stop_words).select(F.explode(F.array_distinct("words")).alias("word"))
    return words.groupBy("word").agg((F.count(F.lit(1)) * sign).alias("df"))


def frequency_delta(
    stored: DataFrame,
    load: DataFrame,
    keys: list[str],
    body: str = "body",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """``word`` and ``df``, by how much the load changes it (never zero).

    ``stored`` is the table before the load, or the part of it that can hold the load's
    keys (``bucketed.touched_rows``); keys are unique in both.  A null body of the load
    leaves the stored one as it is.
    """
    stop_words = terms.default_stop_words() if stop_words is None else stop_words
    new = load.where(F.col(body).isNotNull()).select(*keys, body)
    replaced = new.select(*[F.col(k).alias(f"__of_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    old = stored.where(F.col(body).isNotNull()).select(*keys, body).join(replaced, same, "left_semi")
    # Each side is summed in its tasks before the words meet.
    both = _signed(old, body, stop_words, -1).unionByName(_signed(new, body, stop_words, 1))
    return both.groupBy("word").agg(F.sum("df").alias("df")).where("df != 0")


def apply_delta(frequency: DataFrame, delta: DataFrame) -> DataFrame:
    """Frequencies after a change: ``word``, ``df`` as :func:`terms.document_frequency` gives them."""
    df = F.col("df").cast("bigint").alias("df")
    both = frequency.select("word", df).unionByName(delta.select("word", df))
    # The word is never null; saying so lets the branches of a plan share a shuffle.
    summed = both.groupBy(F.coalesce("word", F.lit("")).alias("word")).agg(F.sum("df").cast("double").alias("df"))
    return summed.where("df != 0")


def append_delta(delta: DataFrame, path: str, load: int) -> None:
    """Store the change of one load under its number; storing it again replaces it."""
    writer = delta.select("word", F.col("df").cast("bigint").alias("df")).write.mode("overwrite")
    writer.parquet(f"{path}/{LOAD}={load:09d}")
    delta.sparkSession.catalog.refreshByPath(path)


def read_frequency(spark: SparkSession, path: str) -> DataFrame:
    """``word``, ``df``: the sum of all stored changes."""
    stored = spark.read.schema(f"word string, df bigint, {LOAD} int").parquet(path)
    return apply_delta(stored.where("false").select("word", "df"), stored.select("word", "df"))


def total(frequency: DataFrame) -> float:
    """Distinct (message, word) pairs: what frequencies are normalised by; one number."""
    return frequency.agg(F.sum("df")).first()[0] or 0.0


def compact(spark: SparkSession, source: str, target: str, load: int) -> None:
    """All changes of ``source`` as one of the number ``load`` in a new folder."""
    append_delta(read_frequency(spark, source), target, load)
