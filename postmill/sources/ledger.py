"""Incremental import of mail folders: a ledger says which files have been read.

A listing has a row for each file: ``path``, ``length``, ``modified``.  The ledger has the
same for each file that was opened, and the reason if it was rejected.  A file is opened
again only if it is new, if its length or time has changed, or if rejects are retried;
the anti-join of listing and ledger finds these.

The ledger is a narrow view of the stored parse: a file's ledger row is written with its
parsed row, in one go, so an interrupted import has each file in both or in neither.
Paths reach the driver in blocks of a bounded size, never all together.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import messages
from postmill.sources import maildir

LISTING = "path string, length bigint, modified bigint"
#: Files that are listed, or opened by one job, at a time.
BLOCK_FILES = 50_000


def list_files(spark: SparkSession, root: str, block: int = BLOCK_FILES) -> Iterator[DataFrame]:
    """Blocks of the listing of all files below ``root``, from one iterator that is read lazily.

    ``.DS_Store`` is left out; other hidden names are listed, and become rejects.
    """
    rows: list[tuple[str, int, int]] = []
    for path, length, modified in maildir.walk(spark, root):
        rows.append((path, length, modified))
        if len(rows) == block:
            yield spark.createDataFrame(rows, LISTING)
            rows = []
    if rows:
        yield spark.createDataFrame(rows, LISTING)


def write_listing(spark: SparkSession, root: str, path: str, block: int = BLOCK_FILES) -> DataFrame:
    """The listing of ``root`` as a table, written block by block; an empty folder gives an empty table."""
    spark.createDataFrame([], LISTING).write.mode("overwrite").parquet(path)
    for part in list_files(spark, root, block):
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(LISTING).parquet(path)


def ledger_of(parsed: DataFrame) -> DataFrame:
    """``path``, ``length``, ``modified``, ``reason`` of the last time each file was opened.

    ``parsed`` is the stored parse of all loads so far; only four narrow columns are read.
    """
    state = F.struct("modified", "load", "length", "reason")
    newest = parsed.groupBy("path").agg(F.max_by(state, F.struct("load", "modified")).alias("state"))
    return newest.select("path", "state.length", "state.modified", "state.reason")


def unseen(listing: DataFrame, ledger: DataFrame, retry_rejects: bool = False) -> DataFrame:
    """Files of the listing that have to be opened."""
    done = ledger.where(F.col("reason").isNull()) if retry_rejects else ledger
    return listing.join(done.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def current(parsed: DataFrame) -> DataFrame:
    """Of each file the parse of the last time it was opened: narrow columns find the rows.

    Each file has one row a load, so the semi-join keeps one row a file.
    """
    last = parsed.groupBy("path").agg(F.max("load").alias("load"))
    return parsed.join(last, ["path", "load"], "left_semi")


def parse_files(raw: DataFrame, files: DataFrame, load: int, profile: str = messages.REFERENCE) -> DataFrame:
    """Parsed rows of the given files, with what the ledger keeps: ``length``, ``modified``, ``load``."""
    opened = raw.join(files.select("path", "length", "modified"), "path")
    return messages.parse_messages(opened, profile, ("length", "modified")).withColumn("load", F.lit(load))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored parse, or None before the first load."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.parquet(path) if exists else None


def import_new(
    spark: SparkSession,
    root: str,
    folder: str,
    profile: str = messages.REFERENCE,
    retry_rejects: bool = False,
    block: int = BLOCK_FILES,
) -> tuple[int, int]:
    """Open the files of ``root`` that the ledger in ``folder`` lacks and append their parse.

    Gives the number of the load and how many files it has opened.  ``folder`` gets a
    table ``parsed`` and the newest listing.  Files are opened in blocks; each block is
    one job and one append, so an interrupted import goes on where it stopped.
    """
    target = f"{folder}/parsed"
    parsed = _stored(spark, target)
    load = 0 if parsed is None else (parsed.agg(F.max("load")).first()[0] or 0) + 1
    listing = write_listing(spark, root, f"{folder}/listing", block)
    new = listing if parsed is None else unseen(listing, ledger_of(parsed), retry_rejects)
    # The files are fixed before any is opened: the ledger grows while they are read.
    new.orderBy("path").write.mode("overwrite").parquet(f"{folder}/new")
    new = spark.read.schema(LISTING).parquet(f"{folder}/new")
    opened, rows = 0, []

    def store(rows: list) -> None:
        files = spark.createDataFrame(rows, LISTING)
        raw = maildir.read_files(spark, [row["path"] for row in rows])
        parse_files(raw, F.broadcast(files), load, profile).write.mode("append").parquet(target)

    # One partition at a time is held by the driver, and of it one block of paths.
    for row in new.toLocalIterator():
        rows.append(row)
        if len(rows) == block:
            store(rows)
            opened, rows = opened + len(rows), []
    if rows:
        store(rows)
    return load, opened + len(rows)


def tally(parsed: DataFrame) -> DataFrame:
    """One row: files, parsed, rejected, each file as it was read last."""
    return messages.import_tally(ledger_of(parsed))


def accepted_of_load(parsed: DataFrame, load: int) -> DataFrame:
    """Good messages of one load: what an upsert has to bring into the stored table."""
    return messages.accepted(parsed.where(F.col("load") == load))
