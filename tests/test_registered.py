"""Every registered query against its SQL, and rules that hold for all of them."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from registered.oracle import ORACLE_SQL
from registered.queries import QUERIES
from tests.conftest import SMALL, plan_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    return connection


def lines(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted("|".join("" if pd.isna(v) else repr(v) for v in row) for row in frame.values.tolist())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, db, name):
    frame = driver.queries()[name](spark, SMALL)
    plan = plan_of(frame)
    assert "Cartesian" not in plan and "Python" not in plan and "ArrowEval" not in plan
    assert "FileScan parquet" in plan
    ours, theirs = frame.toPandas(), db.execute(driver.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert lines(ours) == lines(theirs)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE_SQL.items() <= driver.oracle_sql().items()


def test_entry(spark):
    assert driver.entry(spark).columns == ["doc", "word", "score"]


def test_at_most_ten_words_per_message(spark):
    best = driver.entry(spark).groupBy("doc").count()
    assert best.agg({"count": "max"}).first()[0] <= 10


@pytest.mark.parametrize("name", ["message_keywords", "word_scores"])
def test_texts_are_split_once(spark, name):
    """The branches of the plan start from stored runs of words, not from the documents."""
    plan = plan_of(driver.queries()[name](spark, SMALL))
    assert "regexp_replace" not in plan and "documents.parquet" not in plan
