from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from postmill.functions import dates


def millis(t):
    return dates.core_millis(dates.date_core(t))


def test_accepted_and_refused_shapes(values):
    cases = {
        "Mon, 14 May 2001 16:39:00 -0700 (PDT)": 989883540000,
        "Tue, 14 May 2001 16:39:00 -0700 (PDT)": 989883540000,  # the weekday is not checked
        "Mon, 14 May 2001 16:39:00 -0700": None,  # no zone name
        "Mon, 4 Jun 2001 6:39:00 +0000 (UTC)": 991636740000,  # one digit
        "14 May 2001 16:39:00 -0700 (PDT)": None,
        "Xyz, 14 May 2001 16:39:00 -0700 (PDT)": None,
        "Mon, 14 May 2001 16:39:00 -0700 (XYZ)": None,  # no such zone
        "Mon, 14 May 2001 16:39:00 XYZ (PDT)": None,
        "Mon, 14 May 2001 16:39:00 -0560 (PDT)": None,
        "Mon, 14 May 2001 16:39:00 -0500 (PST)": 989876340000,  # the offset decides
        "Mon, 14 May 2001 16:39 -0700 (PDT)": None,
        "yesterday": None,
        "": None,
    }
    assert values(list(cases), millis) == list(cases.values())


def test_same_instant_as_the_lenient_parser_of_the_platform(spark, values):
    """The JDK's own date format is the judge, year 1 and other old dates included."""
    jvm = spark._jvm
    parser = jvm.java.text.SimpleDateFormat("EEE, dd MMM yyyy HH:mm:ss Z (z)", jvm.java.util.Locale.US)
    cases = [
        "Mon, 14 May 2001 16:39:00 -0700 (PDT)",
        "Monday, 14 May 2001 16:39:00 -0700 (PDT)",
        "mon, 14 may 2001 16:39:00 -0700 (PDT)",
        "Mon,  4 September 2000 06:05:04 -0700 (PDT)",
        "Tue, 29 Feb 2000 23:59:59 -0800 (PST)",
        "Fri, 01 Jan 1999 00:00:00 -0800 (PST)",
        "Thu, 31 Dec 1998 23:59:59 -0800 (PST)",
        "Wed, 31 Dec 1969 16:00:00 -0800 (PST)",
        "Mon, 01 Jan 0001 10:00:00 -0800 (PST)",
        "Mon, 30 Dec 0002 10:00:00 -0800 (PST)",
        "Mon, 28 Feb 0100 10:00:00 -0800 (PST)",
        "Mon, 01 Mar 0100 10:00:00 -0800 (PST)",
        "Thu, 04 Oct 1582 00:00:00 -0800 (PST)",
        "Fri, 15 Oct 1582 00:00:00 +0000 (GMT)",
        "Sat, 01 Jan 2044 10:00:00 -0800 (PST)",
        "Mon, 14 May 2001 16:39:00 -0700 (PDT) trailing",
        "Fri, 32 May 2001 16:39:00 -0700 (PDT)",
        "Sun, 31 Jun 2001 16:39:00 -0700 (PDT)",
        "Sun, 00 Jun 2001 16:39:00 -0700 (PDT)",
        "Thu, 29 Feb 2001 16:39:00 -0800 (PST)",
        "Mon, 14 May 2001 25:39:00 -0700 (PDT)",
        "Mon, 14 May 2001 16:39:75 -0700 (PDT)",
        "Mon, 14 May 2001 16:99:00 -0700 (PDT)",
        "Mon, 140 May 2001 1000:39:00 -0700 (PDT)",
        "Mon, 14 May 01 16:39:00 -0700 (PDT)",
        "Mon, 14 May 99 16:39:00 -0700 (PDT)",
        "Mon, 14 May 20011 16:39:00 -0700 (PDT)",
        "Mon, 35 Feb 0100 10:00:00 -0800 (PST)",
        "Mon, 14 May 2001 16:39:00 PDT (PDT)",
        "Mon, 14 May 2001 16:39:00 pst (Pst)",
        "Mon, 14 May 2001 16:39:00 GMT-07:00 (PDT)",
        "Mon, 14 May 2001 16:39:00 GMT-7:00 (GMT-07:00)",
        "Mon, 14 May 2001 16:39:00 GMT (GMT)",
        "Mon, 14 May 2001 16: 39:00 -0700 ( PDT)",
        "Mon, 14 May 2001 16:39:00 -0700 (-0700)",
        "Mon, 14 May 2001 16:39:00 -0700 (Pacific Daylight Time)",
        "Mon, 14 May 2001 16:39:00 Eastern Standard Time (EST)",
        "Mon, 14 May 2001 16:39:00 +0200 (CEST)",
    ]
    assert values(cases, millis) == [parser.parse(c).getTime() for c in cases]


def test_same_refusals_as_the_lenient_parser_of_the_platform(spark, values):
    jvm = spark._jvm
    parser = jvm.java.text.SimpleDateFormat("EEE, dd MMM yyyy HH:mm:ss Z (z)", jvm.java.util.Locale.US)
    cases = [
        "Mon, 14 May 2001 16:39:00 -0700 (XYZ)",
        "Mon, 14 May 2001 16:39:00 -0700 ()",
        "Mon, 14 May 2001 16:39:00 -700 (PDT)",
        "Mon, 14 May 2001 16:39:00 -07:00 (PDT)",
        "Mon, 14 May 2001 16:39:00 -2400 (PDT)",
        "Mon, 14 May 2001 16:39:00 -0700 PDT",
        "Mon,14 May 2001 16:39:00 -0700 (PDT)",
        "Mon, 14 Foo 2001 16:39:00 -0700 (PDT)",
        "Mon, 14 May 2001 16:39:00 -0700 (PDT",
    ]
    assert values(cases, millis) == [None] * len(cases)
    for case in cases:
        with pytest.raises(Exception, match="Unparseable"):
            parser.parse(case)


def test_week_index(values):
    days = ["1999-01-01", "2000-01-01", "2001-12-31", "2001-01-01"]
    assert values(days, lambda t: dates.week_index(F.to_date(t))) == [53, 104, 105, 105]


def test_utc_date_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        frame = spark.createDataFrame([(0,), (86_399_999,), (86_400_000,), (-1,)], "ms bigint")
        got = [r[0] for r in frame.select(dates.utc_date(F.col("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    first = datetime.date(1970, 1, 1)
    day = datetime.timedelta(days=1)
    assert got == [first, first, first + day, first - day]
