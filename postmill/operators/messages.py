"""Raw messages to typed rows, as column expressions only: one narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import dates, headers, text

REFERENCE = "reference"
INTENDED = "intended"

# The headers that are read, by the name of their column.
HEADERS = {
    "date_text": "Date",
    "id_text": "Message-ID",
    "from": "From",
    "to": "To",
    "subject": "Subject",
    "x_cc": "X-cc",
    "x_bcc": "X-bcc",
}

FIELDS = ["from", "ts", "mid", "to", "subject", "cc", "bcc", "body"]


def _check_profile(profile: str) -> None:
    if profile not in (REFERENCE, INTENDED):
        raise ValueError(f"unknown profile: {profile!r}")


def message_id(raw: Column, profile: str = REFERENCE) -> Column:
    """Message-ID without its angle brackets.

    The reference profile also loses the last character of a bracketed id; the
    intended profile keeps it.
    """
    _check_profile(profile)
    bracketed = raw.startswith("<") & raw.endswith(">") & (F.length(raw) > 1)
    lost = 3 if profile == REFERENCE else 2
    inner = F.substr(raw, F.lit(2), F.greatest(F.length(raw) - lost, F.lit(0)))
    return F.when(bracketed, inner).otherwise(raw)


def parse_messages(raw: DataFrame, profile: str = REFERENCE, kept: tuple[str, ...] = ()) -> DataFrame:
    """``(path, value)`` to ``path``, the message fields and ``reason``, and the columns ``kept`` of ``raw``.

    ``reason`` is null for a good message, else the first of ``hidden_name``,
    ``no_date``, ``bad_date``, ``no_id``, ``bad_id`` and ``no_from`` that applies; a
    bad message never stops the run.  A hidden name is that of a file without a
    value, which the reader of folders could not open.  ``profile`` selects three behaviours together:

    ============== ============================= =======================
    \\              reference                     intended
    ============== ============================= =======================
    wrapped lines  not joined                    joined
    ``mid``        last id character lost        whole id
    ``cc``/``bcc`` ``X-bcc`` or else ``X-cc``;   ``X-cc``; ``X-bcc``
                   bcc null
    ============== ============================= =======================
    """
    _check_profile(profile)
    hidden = F.col("value").isNull() & F.col("path").rlike(r"(?:^|/)[_.][^/]*$")
    whole = raw.select("path", *kept, hidden.alias("hidden"), headers.without_tail(headers.unix_lines(F.col("value"))).alias("whole"))
    split = whole.select("path", *kept, "hidden", "whole", headers.header_block(F.col("whole")).alias("head"))
    head = F.col("head")
    if profile == INTENDED:
        head = headers.unfold(head)
    fields = split.select(
        "path",
        *kept,
        "hidden",
        headers.after_head(F.col("whole"), F.col("head")).alias("rest"),
        *[headers.header(head, name).alias(alias) for alias, name in HEADERS.items()],
    )
    cored = fields.withColumn("core", dates.date_core(F.col("date_text")))
    timed = cored.withColumn("ts", dates.core_millis(F.col("core")))
    # A generator of one row: a filter on its output stays above it.  Otherwise
    # the filter on ``reason`` would be pushed below the projections and the
    # headers and dates would be parsed twice.
    one_row = F.inline(F.array(F.struct("date_text", "id_text", "from", "ts")))
    parsed = timed.select("path", *kept, "hidden", "to", "subject", "x_cc", "x_bcc", "rest", one_row)
    reason = (
        F.when(F.col("hidden"), "hidden_name")
        .when(F.col("date_text").isNull(), "no_date")
        .when(F.col("ts").isNull(), "bad_date")
        .when(F.col("id_text").isNull(), "no_id")
        .when(F.col("id_text") == "<>", "bad_id")
        .when(F.col("from").isNull(), "no_from")
    )
    if profile == REFERENCE:
        cc, bcc = F.coalesce("x_bcc", "x_cc"), F.lit(None).cast("string")
    else:
        cc, bcc = F.col("x_cc"), F.col("x_bcc")
    return parsed.select(
        "path",
        "from",
        "ts",
        message_id(F.col("id_text"), profile).alias("mid"),
        "to",
        "subject",
        cc.alias("cc"),
        bcc.alias("bcc"),
        text.clean_body(headers.body_lines(F.col("rest"))).alias("body"),
        reason.alias("reason"),
        *kept,
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Good messages: ``path`` and the message fields."""
    return parsed.filter(F.col("reason").isNull()).select("path", *FIELDS)


def rejected(parsed: DataFrame) -> DataFrame:
    """Bad messages: ``path`` and ``reason``."""
    return parsed.filter(F.col("reason").isNotNull()).select("path", "reason")


def import_tally(parsed: DataFrame) -> DataFrame:
    """One row: files seen (bad ones included), parsed, rejected."""
    return parsed.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("reason").isNull()).alias("parsed"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )
