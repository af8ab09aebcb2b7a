"""Tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_SENDERS = "top-senders"
TOP_CORRESPONDENTS = "top-correspondents"
KEYWORDS = "tf-idf-matrix"


def write_tsv(table: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    """One line per row, fields as they are, without quotes; null is empty.

    ``single_file`` is for small reports; large results keep one file per task.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]
    lines = table.select(F.concat_ws("\t", *fields).alias("value"))
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode(mode).text(path)
