"""Stored tables, word lists and key:int lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import schemas


def read_cells(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Chosen columns of a stored table under new names, ``{column: name}``.

    Rows that lack one of the columns are skipped.  Only the named columns are
    read from the files.
    """
    table = spark.read.parquet(path).select(*[F.col(c).alias(name) for c, name in columns.items()])
    return table.dropna(subset=list(columns.values()))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``word TAB score`` of a file or a folder.  No lexicon is shipped."""
    return spark.read.csv(path, schema=schemas.LEXICON, sep="\t", quote="")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter(F.col("word") != "")


def parse_keyed_ints(lines: DataFrame) -> DataFrame:
    """``value`` lines ``key:int`` to ``value``, ``key``, ``int``; further parts are ignored.

    ``int`` is null for a bad line.
    """
    parts = F.split("value", ":")
    number = F.get(parts, F.lit(1))
    digits = number.rlike(r"\A[+-]?[0-9]+\z")
    return lines.select(
        "value",
        F.get(parts, F.lit(0)).alias("key"),
        F.when(digits, number.try_cast("int")).alias("int"),
    )


def keyed_ints(lines: DataFrame) -> DataFrame:
    """Good lines: ``key``, ``int``."""
    return parse_keyed_ints(lines).filter(F.col("int").isNotNull()).select("key", "int")


def keyed_int_rejects(lines: DataFrame) -> DataFrame:
    """Bad lines: ``value``."""
    return parse_keyed_ints(lines).filter(F.col("int").isNull()).select("value")


def read_keyed_ints(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good lines and bad lines of text files."""
    lines = spark.read.text(path)
    return keyed_ints(lines), keyed_int_rejects(lines)
