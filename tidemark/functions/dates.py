"""Match dates in three spellings, and the clock columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import SPACE, bind, strip

MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
NAMED = (
    rf"(?i)^(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec){SPACE}+([0-9]{{1,2}}),{SPACE}+"
    r"((?!0000)[0-9]{4}|[0-9]{2})\z"
)
SLASHED = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2})\z"


def _day_there_is() -> str:
    """One pattern of all texts that are a date: the days that each month has, in leap years a 29th of February."""
    up_to = {28: "(?:0?[1-9]|1[0-9]|2[0-8])", 30: "(?:0?[1-9]|[12][0-9]|30)", 31: "(?:0?[1-9]|[12][0-9]|3[01])"}
    fourth = "(?:[02468][048]|[13579][26])"
    years = {False: "(?:(?!0000)[0-9]{4}|[0-9]{2})", True: f"(?:(?!0000)(?:[0-9]{{2}}(?!00){fourth}|{fourth}00)|{fourth})"}
    named = {28: "feb", 30: "(?:apr|jun|sep|nov)", 31: "(?:jan|mar|may|jul|aug|oct|dec)"}
    slashed = {28: "0?2", 30: "(?:0?[469]|11)", 31: "(?:0?[13578]|1[02])"}
    # a month's last days are settled by its length, the 29th of February by the year
    day = [(m, up_to[n], False) for m, n in ((28, 28), (30, 30), (31, 31))] + [(28, "29", True)]
    words = "|".join(f"{named[m]}{SPACE}+{d},{SPACE}+{years[leap]}" for m, d, leap in day)
    short = "|".join(f"{slashed[m]}/{d}/{fourth if leap else '[0-9]{2}'}" for m, d, leap in day)
    return rf"(?i)^(?:{words}|{short})\z"


#: True of the same texts as ``match_date`` is a date of, by one search.
DAY_THERE_IS = _day_there_is()


def _date(parts: Column) -> Column:
    """Date of (year, month, day) texts, null where there is no such day.

    Two-digit years: 69-99 are the 1900s, 00-68 the 2000s (Spark's own pivot differs).
    """
    year, month, day = (F.get(parts, F.lit(i)) for i in range(3))
    century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
    named = ((F.position(month, F.lit(MONTHS)) + 2) / 3).cast("int")
    number = F.when(F.length(month) == 3, named.cast("string")).otherwise(month)
    return F.concat(century, year, F.lit("-"), number, F.lit("-"), day).try_cast("date")


def match_date(value: Column) -> Column:
    """``Sep 3, 2025``, ``9/13/25`` or ``Aug 2, 25`` as a date; everything else is null.

    The parts are read by pattern and put together again, which avoids the
    formatter's own ideas about lenient widths and two-digit years.
    """
    ordered = F.when(
        value.rlike(NAMED), F.lower(F.regexp_replace(value, NAMED, "$3 $1 $2"))
    ).when(value.rlike(SLASHED), F.regexp_replace(value, SLASHED, "$3 $1 $2"))
    return bind(F.split(ordered, " "), _date)


def is_match_date(value: Column) -> Column:
    return F.coalesce(value.rlike(DAY_THERE_IS), F.lit(False))


def iso_match_date(value: Column) -> Column:
    return match_date(strip(value)).cast("string")


def scrape_date_or(value: Column, today: dt.date) -> Column:
    """The given scrape date, else the day of the run."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(today.isoformat()))


def utc_stamp(now: dt.datetime) -> Column:
    """The run's clock as ISO text; one value for the whole job, so results repeat."""
    return F.lit(now.astimezone(dt.timezone.utc).isoformat())
