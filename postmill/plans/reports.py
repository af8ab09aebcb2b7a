"""Corpus questions.

``emails`` has one row per (from, ts); ``employee`` has one row per (employee,
ts), so each row is a version.  Every question is narrow work, one partly
aggregated shuffle and, for the top lists, a top-n per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import dates, text
from postmill.operators import versions

TOP = 10


def _top(counts: DataFrame, count: str, keys: list[str], n: int) -> DataFrame:
    """Highest counts first; ties in key order."""
    return counts.orderBy(F.col(count).desc(), *keys).limit(n)


def sender_counts(emails: DataFrame) -> DataFrame:
    """Messages per sender: ``from``, ``email_count``."""
    return emails.groupBy("from").agg(F.count(F.lit(1)).alias("email_count"))


def top_senders(emails: DataFrame, n: int = TOP) -> DataFrame:
    """Senders with the most messages."""
    return _top(sender_counts(emails), "email_count", ["from"], n)


def top_senders_by_versions(employee: DataFrame, n: int = TOP) -> DataFrame:
    """Senders with the most versions of ``mid``: ``from``, ``count``."""
    mids = versions.column_versions(employee, ["employee"], "ts", "mid")
    counts = versions.version_counts(mids, ["employee"])
    named = counts.select(F.col("employee").alias("from"), F.col("versions").alias("count"))
    return _top(named, "count", ["from"], n)


def correspondent_pairs(emails: DataFrame) -> DataFrame:
    """A row for each recipient of each message: ``sender``, ``recipient`` (lower case)."""
    return emails.filter(F.col("from").isNotNull() & F.col("to").isNotNull()).select(
        F.col("from").alias("sender"), F.explode(text.recipients(F.col("to"))).alias("recipient")
    )


def correspondent_counts(emails: DataFrame) -> DataFrame:
    """Messages per pair: ``sender``, ``recipient`` (lower case), ``email_count``."""
    pairs = correspondent_pairs(emails)
    return pairs.groupBy("sender", "recipient").agg(F.count(F.lit(1)).alias("email_count"))


def top_correspondents(emails: DataFrame, n: int = TOP) -> DataFrame:
    """Pairs with the most messages."""
    return _top(correspondent_counts(emails), "email_count", ["sender", "recipient"], n)


def correspondent_version_counts(employee: DataFrame) -> DataFrame:
    """The SQL flavour over all versions: ``from``, ``to`` (case kept), ``count``."""
    lines = versions.column_versions(employee, ["employee"], "ts", "to")
    pairs = lines.select(
        F.col("employee").alias("from"), F.explode(text.recipients_verbatim(F.col("value"))).alias("to")
    )
    return pairs.groupBy("from", "to").agg(F.count(F.lit(1)).alias("count"))


def top_correspondents_by_versions(employee: DataFrame, n: int = TOP) -> DataFrame:
    """Pairs with the most versions of ``to``."""
    return _top(correspondent_version_counts(employee), "count", ["from", "to"], n)


def from_domain(emails: DataFrame, domain: str) -> DataFrame:
    """Messages sent from one domain (case-sensitive).

    Uses the stored ``from_domain`` column if there is one: that filter reaches
    the files.
    """
    if "from_domain" in emails.columns:
        return emails.filter(F.col("from_domain") == domain)
    return emails.filter(text.domain_of(F.col("from")) == domain)


def weekly_statistics(rows: DataFrame, date: Column, value: str, base_year: int = 1999) -> DataFrame:
    """Per week index: mean, population deviation and row count (null values count as rows)."""
    return rows.groupBy(dates.week_index(date, base_year).alias("weeknum")).agg(
        F.avg(value).alias("avgsentiment"),
        F.stddev_pop(value).alias("stddevsentiment"),
        F.count(F.lit(1)).alias("nummessages"),
    )


def week_states(rows: DataFrame, date: Column, value: str, base_year: int = 1999) -> DataFrame:
    """What a week's statistics are made of, to be stored for each load: ``weeknum``, ``messages``
    (rows), ``n`` (values that are not null), ``mean`` and ``m2``, the sum of squared deviations."""
    return rows.groupBy(dates.week_index(date, base_year).alias("weeknum")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of several loads as one for each week.

    Deviations are taken from the common mean, not from zero, so large offsets cost no
    digits.  There is one row a week and load; no message is read again.
    """
    whole = states.groupBy("weeknum").agg(
        F.sum("messages").alias("messages"),
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
    )
    centre = whole.select(F.col("weeknum").alias("__week"), F.col("mean").alias("__mean"))
    apart = states.join(centre, F.col("weeknum").eqNullSafe(F.col("__week")))
    spread = apart.groupBy("__week").agg(
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))).alias("m2")
    )
    merged = whole.join(spread, F.col("weeknum").eqNullSafe(F.col("__week")))
    return merged.select("weeknum", "messages", "n", "mean", "m2")


def state_statistics(states: DataFrame) -> DataFrame:
    """The statistics of merged states, as :func:`weekly_statistics` gives them."""
    deviation = F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0)))
    return states.select(
        "weeknum", F.col("mean").alias("avgsentiment"), deviation.alias("stddevsentiment"),
        F.col("messages").alias("nummessages"),
    )


def weekly_sentiment(scored: DataFrame, domain: str, base_year: int = 1999) -> DataFrame:
    """Sentiment of one domain's messages over time."""
    return weekly_statistics(from_domain(scored, domain), dates.utc_date(F.col("ts")), "sentiment", base_year)


def words_by_sentiment(scored: DataFrame, domain: str) -> DataFrame:
    """Words by the total sentiment of the messages that hold them, most negative first.

    A word counts once per occurrence.
    """
    words = from_domain(scored, domain).select(
        F.explode(text.first_sentence_words(F.col("body"))).alias("word"), "sentiment"
    )
    totals = words.groupBy(F.lower("word").alias("word")).agg(F.sum("sentiment").alias("totalsentiment"))
    return totals.orderBy("totalsentiment", "word")
