from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postmill.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "postmill-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one expression over a list of texts."""

    def run(texts, expression_of):
        expression = expression_of(F.col("t"))
        rows = [(i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "i int, t string")
        return [r["v"] for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]

    return run


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
