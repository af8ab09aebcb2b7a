"""Raw messages to stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import messages, versions
from postmill.schemas import MESSAGE_COLUMNS
from postmill.sinks.tables import write_emails, write_table
from postmill.sources.maildir import read_maildir


def table_keys(target: str) -> list[str]:
    """Columns that are unique in the target table."""
    if target not in versions.TARGETS:
        raise ValueError(f"unsupported table: {target!r}")
    return [versions.TARGETS[target], "ts"]


def merge_messages(accepted: DataFrame, target: str = "emails", stored: bool = False) -> DataFrame:
    """Good messages to the target table, one row per (sender, ts).

    Messages of one sender and time are merged cell by cell in path order.  The
    merge is the only shuffle; of a ``stored`` table, which is cheap to read again,
    only messages that share a key take part in it.  The ``date`` cell is the message
    time itself and needs no merge.
    """
    keys = table_keys(target)
    cells = [c for c in MESSAGE_COLUMNS if c not in [*keys, "date"]]
    merge = versions.upsert_stored if stored else versions.upsert
    merged = merge(versions.key_for_target(accepted, target), keys, "path", cells)
    return merged.withColumn("date", F.col("ts")).select(*keys, *[c for c in MESSAGE_COLUMNS if c not in keys])


def import_messages(
    raw: DataFrame, target: str = "emails", profile: str = messages.REFERENCE
) -> tuple[DataFrame, DataFrame]:
    """``(path, value)`` rows to the target table and the rejects."""
    parsed = messages.parse_messages(raw, profile)
    return merge_messages(messages.accepted(parsed), target), messages.rejected(parsed)


def import_maildir(
    spark: SparkSession, root: str, target: str = "emails", profile: str = messages.REFERENCE
) -> tuple[DataFrame, DataFrame]:
    """A folder of messages to the target table and the rejects."""
    return import_messages(read_maildir(spark, root), target, profile)


def import_to_tables(
    raw: DataFrame, folder: str, target: str = "emails", profile: str = messages.REFERENCE
) -> DataFrame:
    """Import into ``folder``: ``parsed``, the target table and ``rejects``; returns the tally.

    The raw files are opened and parsed once: the merge, the rejects and the
    tally read the stored ``parsed`` table, each only its own columns.  It stays
    beside the other tables; remove it once the import has been accepted.
    ``folder`` must be on storage that all executors share.
    """
    spark = raw.sparkSession
    messages.parse_messages(raw, profile).write.parquet(f"{folder}/parsed")
    parsed = spark.read.parquet(f"{folder}/parsed")
    table = merge_messages(messages.accepted(parsed), target, stored=True)
    if target == "emails":
        write_emails(table, f"{folder}/{target}")
    else:
        write_table(table, f"{folder}/{target}", sort_by=table_keys(target))
    write_table(messages.rejected(parsed), f"{folder}/rejects")
    return messages.import_tally(parsed)
