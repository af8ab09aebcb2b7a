from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postmill.plans import reports
from postmill.sources import views
from registered import inputs
from tests.conftest import SMALL, plan_of


@pytest.fixture
def emails(spark):
    day = 86_400_000
    rows = [
        ("a@corp.com", 1, "m1", "X@y, z ,", "one", 1.0),
        ("a@corp.com", 2, "m2", "x@y", "one two", -2.0),
        ("a@corp.com", 3, "m3", None, "", None),
        ("b@corp.com", 4 * day, "m4", ",", "TWO", 4.0),
        ("c@CORP.com", 5, "m5", "x@y", "three", 9.0),
    ]
    return spark.createDataFrame(
        rows, "`from` string, ts bigint, mid string, to string, body string, sentiment float"
    )


@pytest.fixture
def employee(emails):
    return emails.withColumnRenamed("from", "employee").withColumn("from", F.col("employee"))


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_top_senders(emails, employee):
    expected = [("a@corp.com", 3), ("b@corp.com", 1), ("c@CORP.com", 1)]
    assert rows(reports.top_senders(emails)) == expected
    assert rows(reports.top_senders_by_versions(employee)) == expected
    assert rows(reports.top_senders(emails, 1)) == expected[:1]


def test_pairs(emails, employee):
    assert rows(reports.top_correspondents(emails)) == [
        ("a@corp.com", "x@y", 2),
        ("a@corp.com", "z", 1),
        ("c@CORP.com", "x@y", 1),
    ]
    assert rows(reports.top_correspondents_by_versions(employee)) == [
        ("b@corp.com", "", 2),
        ("a@corp.com", "", 1),
        ("a@corp.com", "X@y", 1),
        ("a@corp.com", "x@y", 1),
        ("a@corp.com", "z", 1),
        ("c@CORP.com", "x@y", 1),
    ]


def test_weekly_sentiment(emails):
    weeks = {r["weeknum"]: r for r in reports.weekly_sentiment(emails, "corp.com", base_year=1970).collect()}
    assert weeks[1]["nummessages"] == 3 and weeks[1]["avgsentiment"] == -0.5 and weeks[1]["stddevsentiment"] == 1.5
    assert weeks[2]["nummessages"] == 1


def test_population_deviation(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    row = reports.weekly_statistics(frame, F.lit("1999-01-01").cast("date"), "v").first()
    assert row["weeknum"] == 53 and row["stddevsentiment"] == pytest.approx(1.247219128924647)


def test_words_by_sentiment(emails):
    assert rows(reports.words_by_sentiment(emails, "corp.com")) == [("one", -1.0), ("two", 2.0)]


def test_domain_filter_is_pushed_down_on_the_stored_column(spark, tmp_path, emails):
    from postmill.sinks import tables

    tables.write_emails(emails, str(tmp_path / "emails"))
    stored = spark.read.parquet(str(tmp_path / "emails"))
    kept = reports.from_domain(stored, "corp.com")
    assert "EqualTo(from_domain,corp.com)" in plan_of(kept)
    assert kept.count() == reports.from_domain(emails, "corp.com").count() == 4


def test_top_lists_take_ordered(emails, employee):
    for frame in (
        reports.top_senders(emails),
        reports.top_senders_by_versions(employee),
        reports.top_correspondents(emails),
        reports.top_correspondents_by_versions(employee),
    ):
        plan = plan_of(frame)
        assert "TakeOrderedAndProject" in plan and "partial_count" in plan
        assert "Python" not in plan


def test_words_need_no_join(spark, emails):
    scored = inputs.sentiment.score_messages(emails.drop("sentiment"), inputs.lexicon(spark), ["from", "ts"])
    for frame in (reports.words_by_sentiment(scored, "corp.com"), reports.weekly_sentiment(scored, "corp.com")):
        assert "Join" not in plan_of(frame)


def test_senders_agree_between_the_two_tables(spark):
    emails, employee = inputs.emails(spark, SMALL), inputs.employee(spark, SMALL)
    by_row = reports.sender_counts(emails)
    by_version = reports.top_senders_by_versions(employee, 1_000_000)
    assert sorted(rows(by_row)) == sorted(rows(by_version))
    assert by_row.agg(F.sum("email_count")).first()[0] == emails.count()


def test_questions_as_statements_on_the_views(spark, emails, employee):
    stored = emails.withColumn("date", F.col("ts")).withColumn("subject", F.lit("s"))
    views.register_emails(stored, "v_emails")
    views.register_employee(employee.withColumn("subject", F.lit("s")), "v_employee")
    try:
        assert rows(
            spark.sql("select fromStr.value, count(mid) as n from v_employee group by all order by n desc, 1")
        ) == rows(reports.top_senders(emails))
        assert rows(
            spark.sql(
                """with one as (select fromStr.value as a, explode(split(toStr.value, ',')) as b from v_employee)
                select a, trim(b) as t, count(*) as n from one group by all order by n desc, a, t limit 10"""
            )
        ) == rows(reports.top_correspondents_by_versions(employee))
        by_week = spark.sql(
            """with one as (
              select 52 * (year(dateLong.ts) - 1970) + weekofyear(dateLong.ts) as week, sentiment.value as score
              from v_emails where split_part(fromStr.value, '@', -1) = 'corp.com')
            select week, mean(score), stddev_pop(score), count(*) from one group by week"""
        )
        assert sorted(rows(by_week)) == sorted(rows(reports.weekly_sentiment(emails, "corp.com", 1970)))
    finally:
        spark.catalog.dropTempView("v_emails")
        spark.catalog.dropTempView("v_employee")


@pytest.mark.parametrize("bound", [1, 2, 3, 100])
def test_arrays_say_whether_they_are_cut(spark, employee, bound):
    views.register_employee_arrays(employee.withColumn("subject", F.lit("s")), bound, "v_arrays")
    try:
        found = spark.sql("select fromStr.value as s, size(mid) as n, mid[0].value as m, truncated from v_arrays")
        assert {r["s"]: (r["n"], r["m"], r["truncated"]) for r in found.collect()} == {
            "a@corp.com": (min(3, bound), "m3", bound < 3),
            "b@corp.com": (1, "m4", False),
            "c@CORP.com": (1, "m5", False),
        }
    finally:
        spark.catalog.dropTempView("v_arrays")


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_weeks_equal_one_pass(spark, tmp_path, offset):
    """Three loads of different sizes, one of them without a week of the others; large offsets; nulls."""
    draw = random.Random(5)
    rows = [(draw.randrange(40), None if draw.random() < 0.1 else offset + draw.random()) for _ in range(900)]
    rows += [(500, None), (500, None), (600, offset + 0.5)]
    parts = [rows[:600], rows[600:880], rows[880:]]
    date = F.date_from_unix_date(F.col("day"))
    for part in parts:
        frame = spark.createDataFrame(part, "day int, value double")
        reports.week_states(frame, date, "value").write.mode("append").parquet(str(tmp_path / "weeks"))
    merged = reports.state_statistics(reports.merge_states(spark.read.parquet(str(tmp_path / "weeks"))))
    whole = reports.weekly_statistics(spark.createDataFrame(rows, "day int, value double"), date, "value")
    assert merged.columns == whole.columns
    theirs = {r["weeknum"]: r for r in whole.collect()}
    found = merged.collect()
    assert len(found) == len(theirs)
    for r in found:
        other = theirs[r["weeknum"]]
        assert r["nummessages"] == other["nummessages"]
        for c in ("avgsentiment", "stddevsentiment"):
            assert (r[c] is None) == (other[c] is None)
            assert r[c] is None or abs(r[c] - other[c]) <= 1e-9 * max(1.0, offset)
    states = reports.merge_states(spark.read.parquet(str(tmp_path / "weeks")))
    again = reports.merge_states(states)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, states.collect()), key=str)
