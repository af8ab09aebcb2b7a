"""The batch jobs: stored table in, files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from postmill.operators import sentiment, terms
from postmill.plans import keywords, reports
from postmill.sinks import tables as table_sinks
from postmill.sinks import tsv
from postmill.sources.tables import read_cells

KEYS = ["from", "ts"]


def summary_job(spark: SparkSession, emails: str, output: str) -> None:
    """Top senders and top sender-recipient pairs, each one tab-separated file."""
    senders = read_cells(spark, emails, {"from": "from"})
    tsv.write_tsv(reports.top_senders(senders), f"{output}/{tsv.TOP_SENDERS}", single_file=True)
    pairs = read_cells(spark, emails, {"from": "from", "to": "to"})
    tsv.write_tsv(reports.top_correspondents(pairs), f"{output}/{tsv.TOP_CORRESPONDENTS}", single_file=True)


def keywords_job(
    spark: SparkSession, emails: str, output: str, stop_words: list[str] | DataFrame | None = None
) -> None:
    """Ten best words of every message, tab-separated.

    The term counts are stored under ``output`` first: tokenising is done once,
    and the frequency and score passes read three narrow columns.
    """
    bodies = read_cells(spark, emails, {"from": "from", "ts": "ts", "body": "body"})
    counts = f"{output}/term-counts"
    table_sinks.write_table(terms.term_counts(bodies, KEYS, "body", stop_words), counts)
    best = keywords.keywords_of_counts(spark.read.parquet(counts))
    tsv.write_tsv(best, f"{output}/{tsv.KEYWORDS}")


def sentiment_job(
    spark: SparkSession, emails: str, lexicon: DataFrame, output: str, scored_at: Column | None = None
) -> None:
    """Append the sentiment of every stored message as cells of a feature table."""
    bodies = read_cells(spark, emails, {"from": "from", "ts": "ts", "body": "body"})
    scored = sentiment.score_messages(bodies, lexicon, KEYS)
    table_sinks.write_feature(sentiment.sentiment_cells(scored, KEYS, scored_at), output)
