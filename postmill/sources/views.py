"""SQL views in which each column is a cell ``struct<ts, value>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators import versions

# Stored column -> name in the views, where reserved words are avoided.
EMAIL_CELLS = {
    "mid": "mid",
    "date": "dateLong",
    "from": "fromStr",
    "to": "toStr",
    "subject": "subject",
    "cc": "cc",
    "bcc": "bcc",
    "body": "body",
    "sentiment": "sentiment",
}
EMPLOYEE_CELLS = {"mid": "mid", "from": "fromStr", "to": "toStr", "subject": "subject", "body": "body"}


def _cell(column: str) -> Column:
    cell = F.struct(F.timestamp_millis("ts").alias("ts"), F.col(column).alias("value"))
    return F.when(F.col(column).isNotNull(), cell)


def cell_view(table: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns of the table as cells; a column the table lacks is left out."""
    return table.select(*[_cell(c).alias(name) for c, name in names.items() if c in table.columns])


def register_emails(emails: DataFrame, name: str = "emails") -> None:
    """View of the newest cells, one row per message."""
    cell_view(emails, EMAIL_CELLS).createOrReplaceTempView(name)


def register_employee(employee: DataFrame, name: str = "employee") -> None:
    """View of all versions: one row per (sender, version), not one array per sender.

    ``count(mid)`` per sender takes the place of ``size(mid)``, and no
    ``explode`` of versions is needed; a sender's messages stay spread over the
    cluster.
    """
    cell_view(employee, EMPLOYEE_CELLS).createOrReplaceTempView(name)


def register_employee_arrays(employee: DataFrame, max_versions: int, name: str = "employee") -> None:
    """View of one row per sender with arrays of its newest cells, under a version bound.

    For statements that use ``size(mid)`` and ``explode(toStr)``.  The column
    ``truncated`` says whether the bound has cut an array of the sender; use
    :func:`register_employee` for all versions.
    """
    columns = list(EMPLOYEE_CELLS)
    cells = versions.all_versions(employee, ["employee"], "ts", columns)
    # One cell more than is shown tells whether there are more.
    table = versions.version_table(cells, ["employee"], columns, max_versions + 1)

    def arrays(column: str) -> Column:
        return F.transform(
            F.slice(column, 1, max_versions),
            lambda cell: F.struct(F.timestamp_millis(cell.ts).alias("ts"), cell.value.alias("value")),
        )

    newest = F.get(arrays("from"), F.lit(0))
    most = F.greatest(*[F.size(c) for c in columns])
    table.select(
        *[(newest if c == "from" else arrays(c)).alias(view) for c, view in EMPLOYEE_CELLS.items()],
        (most > max_versions).alias("truncated"),
    ).createOrReplaceTempView(name)
