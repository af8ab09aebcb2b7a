"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from postmill.llm import queries
from postmill.llm.oracle import ORACLE_SQL
from tests.conftest import SMALL

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


def shown(value):
    """A whole number in a column with nulls may come as a float."""
    if pd.isna(value):
        return ""
    return repr(int(value)) if isinstance(value, float) and value.is_integer() else repr(value)


def lines(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted("|".join(map(shown, row)) for row in frame.values.tolist())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    ours = queries.QUERIES[name](spark, SMALL).toPandas()
    theirs = db.execute(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours) > 0
    assert lines(ours) == lines(theirs)


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert queries.QUERIES.items() <= driver.queries().items() and "pipeline" in driver.queries()
    assert ORACLE_SQL.items() <= driver.oracle_sql().items()
