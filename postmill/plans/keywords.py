"""TF-IDF keywords per message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators import terms

KEYS = ["from", "ts"]


def message_keywords(
    emails: DataFrame,
    stop_words: list[str] | DataFrame | None = None,
    n: int = terms.TOP_WORDS,
    frequent: int = terms.FREQUENT_WORDS,
) -> DataFrame:
    """The ``n`` best words of each message: ``doc``, ``word``, ``score``.

    Words that can't be among them are left out before the scores are made, unless the
    stop words are a table, which is applied later.  The texts are read for the frequencies and again for the scores.
    Of a large corpus write ``terms.message_runs`` to a table once and call :func:`keywords_of_runs` on it.
    """
    bodies = emails.filter(F.col("body").isNotNull())
    frequency = terms.message_frequency(bodies, "body", stop_words)
    if isinstance(stop_words, DataFrame):
        counts = terms.term_counts(bodies, KEYS, "body", stop_words)
    else:
        counts = terms.reachable_counts(bodies, KEYS, frequency, n, "body", stop_words)
    return _best(counts, frequency, n, frequent)


def keywords_of_counts(
    counts: DataFrame, n: int = terms.TOP_WORDS, frequent: int = terms.FREQUENT_WORDS
) -> DataFrame:
    """Keywords from (``from``, ``ts``, ``word``, ``tf``) rows."""
    return _best(counts, terms.document_frequency(counts), n, frequent)


def keywords_of_runs(
    runs: DataFrame, n: int = terms.TOP_WORDS, frequent: int = terms.FREQUENT_WORDS
) -> DataFrame:
    """:func:`message_keywords` from stored ``terms.message_runs``; no text is read."""
    frequency = terms.document_frequency(terms.counts_of_runs(runs, []))
    return _best(terms.reachable_runs(runs, KEYS, frequency, n), frequency, n, frequent)


def _best(counts: DataFrame, frequency: DataFrame, n: int, frequent: int) -> DataFrame:
    best = terms.top_words(terms.word_scores(counts, frequency, KEYS, frequent), KEYS, n)
    return best.select(terms.entity_id(F.col("from"), F.col("ts")).alias("doc"), "word", "score")
