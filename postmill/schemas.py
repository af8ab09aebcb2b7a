"""Declared schemas of the stored tables.

A row key and its columns are flat columns here.  A column family is a name
prefix in the description only: nothing in a query depends on it.  A cell that
was never written is null, never the empty string.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def _field(name: str, data_type: T.DataType, note: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, data_type, nullable, {"comment": note})


#: Value columns filled by the import, in table order.
MESSAGE_COLUMNS = ["mid", "date", "from", "to", "subject", "cc", "bcc", "body"]

_MESSAGE_FIELDS = [
    _field("mid", T.StringType(), "Message-ID"),
    _field("date", T.LongType(), "instant of the Date header, in epoch milliseconds"),
    _field("to", T.StringType(), "To"),
    _field("subject", T.StringType(), "Subject"),
    _field("cc", T.StringType(), "cc"),
    _field("bcc", T.StringType(), "bcc"),
    _field("body", T.StringType(), "message body, cleaned"),
    _field("sentiment", T.FloatType(), "mean lexicon score of the body"),
]

#: One row per (sender, message time).
EMAILS = T.StructType(
    [
        _field("from", T.StringType(), "sender, part of the key", False),
        _field("ts", T.LongType(), "message time in epoch milliseconds, part of the key", False),
    ]
    + _MESSAGE_FIELDS
)

#: One row per (sender, version): every version of every column, oldest to newest by ``ts``.
EMPLOYEE = T.StructType(
    [
        _field("employee", T.StringType(), "sender, the key", False),
        _field("ts", T.LongType(), "cell version in epoch milliseconds", False),
        _field("from", T.StringType(), "From"),
    ]
    + _MESSAGE_FIELDS
)

#: The record used as a key by value counting.
RECORD = T.StructType([_field("id", T.StringType(), "record id")])

#: Example table with a bounded number of versions, one row per version.
USERS = T.StructType(
    [
        _field("user", T.StringType(), "row key", False),
        _field("ts", T.LongType(), "cell version in epoch milliseconds", False),
        _field("name", T.StringType(), "display name"),
        _field("example_record", RECORD, "counted record"),
    ]
)
USERS_MAX_VERSIONS = 10

LEXICON = T.StructType(
    [
        _field("word", T.StringType(), "lower-case word"),
        _field("score", T.FloatType(), "weight of the word"),
    ]
)

TABLES = {"emails": EMAILS, "employee": EMPLOYEE, "users": USERS}


def create_tables(spark: SparkSession, names: list[str] | None = None) -> list[str]:
    """Create the named tables (all by default) as Parquet tables in the current catalog."""
    created = []
    for name in names or list(TABLES):
        spark.catalog.createTable(name, source="parquet", schema=TABLES[name])
        created.append(name)
    return created
