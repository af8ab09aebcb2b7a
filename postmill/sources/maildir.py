"""Folders of messages, one message per file."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the only file name that is no message.
IGNORED_FILES = [".DS_Store"]
#: Names of files that are given as rejects by a plain reading, at most.
HIDDEN_NAMES = 100_000
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def walk(spark: SparkSession, root: str) -> Iterator[tuple[str, int, int]]:
    """``path``, ``length`` and time (epoch milliseconds) of every file below ``root``.

    One iterator of the file system, read lazily: no list of a folder or of the whole
    tree is held.  Files that are no message (``IGNORED_FILES``) are passed over.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        raise FileNotFoundError(f"no folder {root}")
    found = system.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        if name.rsplit("/", 1)[1] not in IGNORED_FILES:
            yield name, status.getLen(), status.getModificationTime()


def hidden(name: str) -> bool:
    """Spark reads no file of such a name, and doesn't look into such a folder."""
    return name.startswith(("_", "."))


def hidden_folders(path: str, root: str) -> list[str]:
    """Folders between ``root`` and a file whose own name is hidden."""
    parts = path.split("/")
    depth = len(root.rstrip("/").split("/"))
    return ["/".join(parts[: i + 1]) for i in range(depth, len(parts) - 1) if hidden(parts[i])]


def read_maildir(spark: SparkSession, root: str) -> DataFrame:
    """``(path, value)`` of every file below ``root``, at any depth and of any name.

    ``root`` is an absolute path or a URI.  Spark's recursive listing leaves out
    folders whose name starts with ``_`` or ``.``, such as ``_sent_mail``; these are
    named beside the root, so that each file is listed and read once.

    Spark reads no *file* of such a name.  Those files are given with a null value,
    so that the import counts them and rejects them with a reason; ``.DS_Store`` is
    left out.

    One small file per message is a poor layout for a large corpus; read it
    once and store the imported table.
    """
    if not re.sub(SCHEME, "", root).startswith("/"):
        raise ValueError("root must be an absolute path or a URI")
    # Hidden folders and hidden files are few; of all other files nothing is kept.
    folders, names, anything = set(), [], False
    base = _qualified(spark, root)
    for path, _, _ in walk(spark, root):
        anything = True
        folders.update(hidden_folders(path, base))
        if hidden(path.rsplit("/", 1)[1]):
            names.append(path)
            if len(names) > HIDDEN_NAMES:
                raise ValueError(f"more than {HIDDEN_NAMES} hidden file names: use ledger.import_new, which lists in blocks")
    if not anything:
        raise FileNotFoundError(f"no message below {root}")
    # The recursive lookup also keeps a folder such as year=2001 from being read as a column.
    found = spark.read.text([root, *map(_escaped, sorted(folders))], wholetext=True, recursiveFileLookup=True)
    messages = found.select(F.col("_metadata.file_path").alias("path"), "value")
    return messages.unionByName(_unread(spark, names)) if names else messages


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, value)`` of the named files, a bounded number of them, by the names given.

    Files whose own name is hidden have a null value.
    """
    shown = [path for path in paths if not hidden(path.rsplit("/", 1)[1])]
    unread = _unread(spark, [path for path in paths if hidden(path.rsplit("/", 1)[1])])
    if not shown:
        return unread
    found = spark.read.text(list(map(_escaped, shown)), wholetext=True)
    # Spark names a file by its URI, in which some characters are escaped.
    names = spark.createDataFrame([(path, _uri(spark, path)) for path in shown], "path string, uri string")
    read = found.select(F.col("_metadata.file_path").alias("uri"), "value").join(F.broadcast(names), "uri")
    return read.select("path", "value").unionByName(unread)


def _unread(spark: SparkSession, names: list[str]) -> DataFrame:
    rows = spark.createDataFrame([(name,) for name in names], "path string")
    return rows.select("path", F.lit(None).cast("string").alias("value"))


def _qualified(spark: SparkSession, root: str) -> str:
    """The root as the file system names it, so that it begins the names of its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _uri(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def _escaped(path: str) -> str:
    """A path as a pattern that names itself alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
