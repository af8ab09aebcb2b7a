"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import text

#: Different values of a column in a row group, as its Bloom filter expects them: about 128 KB.
BLOOM_VALUES = 100_000


def write_table(
    table: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    bloom: dict[str, int] | None = None,
) -> None:
    """Write Parquet files.

    With ``partition_by`` the rows are first rebalanced on those columns:
    adaptive execution joins small pieces and splits a partition value that is
    too large for one task.  ``sort_by`` orders rows inside a file, so that
    row-group statistics prune filters on those columns.  ``bloom`` names columns of which
    each row group gets a Bloom filter, for about so many different values: equality
    filters then skip row groups whose least and greatest value tell nothing.
    """
    if partition_by:
        table = table.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by or partition_by:
        table = table.sortWithinPartitions(*(partition_by or []), *(sort_by or []))
    writer = table.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    writer.parquet(path)


def with_sender_domain(emails: DataFrame) -> DataFrame:
    """Add ``from_domain``, on which a domain filter is pushed down to the files."""
    return emails.withColumn("from_domain", text.domain_of(F.col("from")))


def write_emails(emails: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the ``emails`` table with ``from_domain``, sorted by it inside each file.

    Row groups have a Bloom filter on the message id, by which the order says nothing;
    the domain and the sender are found by the order.
    """
    write_table(
        with_sender_domain(emails), path, mode, sort_by=["from_domain", "from", "ts"], bloom={"mid": BLOOM_VALUES}
    )


def save_bucketed(table: DataFrame, name: str, keys: list[str], buckets: int, mode: str = "errorifexists") -> None:
    """Save a catalog table bucketed by its key, so that joins on the key need no shuffle."""
    table.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def write_feature(cells: DataFrame, path: str, mode: str = "append") -> None:
    """Append derived cells (keys, ``ts``, ``value``) as a table of their own."""
    cells.write.mode(mode).parquet(path)


def write_records(pairs: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    """Write (record, number) pairs as Parquet or JSON."""
    pairs.write.mode(mode).format(form).save(path)
