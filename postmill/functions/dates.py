"""Message dates and week numbers."""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The shape of a message date, "Mon, 14 May 2001 16:39:00 -0700 (PDT)".
DAY_NAMES = "Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?|Sat(?:urday)?|Sun(?:day)?"
MONTH_NAMES = (
    "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|"
    "Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
)
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
SKIP = r"[ \t]*"
GAP = " " + SKIP
NUMBER = r"(\d{1,9})"
OFFSET = r"[+-](?:[01]\d|2[0-3])[0-5]\d|GMT[+-](?:[01]?\d|2[0-3]):[0-5]\d"
DATE_SHAPE = (
    rf"(?is)\A{SKIP}(?:{DAY_NAMES}),{GAP}{NUMBER}{GAP}({MONTH_NAMES}){GAP}(\d{{1,6}}){GAP}"
    rf"{NUMBER}:{SKIP}{NUMBER}:{SKIP}{NUMBER}{GAP}({OFFSET}|[A-Z][^()|\n]*?) \({SKIP}({OFFSET}|[A-Z][^()|\n]*)\).*"
)

DAY_MS = 86_400_000
# The first day of the Gregorian calendar, 15 October 1582, in days since 1970.
GREGORIAN_YEAR = 1582
GREGORIAN_START = -141_427


@functools.lru_cache(maxsize=1)
def zone_offsets() -> dict[str, int]:
    """Milliseconds east of Greenwich by upper-case zone name, as the Java platform has them.

    The platform's own table of names and abbreviations; of a name in several zones
    the first counts.  A daylight-saving name has the saving in its offset.
    """
    jvm = SparkSession.active()._jvm
    table = jvm.java.text.DateFormatSymbols(jvm.java.util.Locale.US).getZoneStrings()
    found = {"GMT": 0, "UTC": 0, "UT": 0}
    for row in table:
        name, *names = list(row)
        if all(n.upper() in found for n in names[:4]):
            continue
        zone = jvm.java.util.TimeZone.getTimeZone(name)
        for place, text in enumerate(names[:4]):
            offset = zone.getRawOffset() + (zone.getDSTSavings() if place >= 2 else 0)
            found.setdefault(text.upper(), offset)
    return found


def date_core(date: Column) -> Column:
    """Day, month, year, hour, minute, second, offset and zone of a message date, joined by
    bars; empty if the text has another shape.

    The weekday must be a name but need not fit the date.  Numbers may have any value
    of up to nine digits (years: six).  The offset and the zone are numbers such as
    -0700 or GMT-07:00, or names.
    """
    fields = "|".join(f"${i}" for i in range(1, 9))
    return F.when(date.rlike(DATE_SHAPE), F.regexp_replace(date, DATE_SHAPE, fields)).otherwise("")


def core_millis(core: Column) -> Column:
    """Epoch milliseconds of :func:`date_core`, null if it names no instant.

    The calendar is lenient: a day, hour, minute or second beyond its range runs over
    into the next.  Years before 1582 are Julian, so a mistyped year 1 gives the usual
    value of mail tools.  The offset decides, not the zone in brackets, but that must
    be one: an unknown zone name makes no date.
    """
    # The list of one element binds the parts to a name, so that they are made once.
    return F.get(F.transform(F.array(F.split(core, "[|]")), _instant), F.lit(0))


def _instant(part: Column) -> Column:
    def number(at: int) -> Column:
        return F.get(part, F.lit(at)).try_cast("bigint")

    month = ((F.instr(F.lit(MONTHS), F.lower(F.substring(F.get(part, F.lit(1)), 1, 3))) + 2) / 3).cast("int")
    year = number(2).cast("int")
    days = F.unix_date(F.make_date(year, month, F.lit(1))).cast("bigint") + number(0) - 1
    # Years are counted from March, so that the leap day is the last one.
    march_year = year - F.when(month <= 2, 1).otherwise(0)
    shift = F.floor(march_year / 100) - F.floor(march_year / 400) - 2
    julian = (year < GREGORIAN_YEAR) | ((year == GREGORIAN_YEAR) & (days < GREGORIAN_START))
    days = days + F.when(julian, shift).otherwise(0)
    seconds = (number(3) * 60 + number(4)) * 60 + number(5)
    offset, zone = _offset_millis(F.get(part, F.lit(6))), _offset_millis(F.get(part, F.lit(7)))
    return F.when((F.size(part) == 8) & zone.isNotNull(), days * DAY_MS + seconds * 1000 - offset)


def _offset_millis(text: Column) -> Column:
    """Milliseconds of an offset or a zone name; null for an unknown name."""
    digits = F.regexp_replace(text, "(?i)^GMT|:", "")
    sign = F.when(digits.startswith("-"), -1).otherwise(1)
    minutes = F.substring(digits, -2, 2).try_cast("int")
    hours = F.regexp_extract(digits, r"^[+-](\d{1,2})\d\d$", 1).try_cast("int")
    names = F.from_json(F.lit(json.dumps(zone_offsets())), "map<string, int>")
    numeric = (sign * (hours * 60 + minutes) * 60_000).cast("bigint")
    return F.when(text.rlike(f"(?i)^(?:{OFFSET})$"), numeric).otherwise(
        F.try_element_at(names, F.upper(text)).cast("bigint")
    )


def utc_date(millis: Column) -> Column:
    """Calendar date in UTC of epoch milliseconds, whatever the session zone is."""
    return F.date_from_unix_date(F.floor(millis / DAY_MS).cast("int"))


def week_index(date: Column, base_year: int = 1999) -> Column:
    """``(year - base_year) * 52 + ISO week``.

    By this definition the index is not monotone around the new year: the
    calendar year and the ISO week can belong to different years.
    """
    return (F.year(date) - base_year) * 52 + F.weekofyear(date)
