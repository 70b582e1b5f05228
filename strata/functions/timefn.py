"""Time helpers. All stored times are timestamp_ntz holding UTC wall-clock."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.model import END_OF_DAY_SECONDS

_ISO_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def parse_as_of(value) -> dt.date:
    """Strict ISO date (YYYY-MM-DD); compact forms are refused so text compares stay sound."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value)
    if not _ISO_DATE.match(text):
        raise ValueError(f"as_of {text!r} is not a date of the form YYYY-MM-DD")
    return dt.date.fromisoformat(text)


def valid_as_of(text: Column) -> Column:
    """Requested dates of a table: the date where the text is a valid YYYY-MM-DD,
    null for any other text (the row form of ``parse_as_of``); dates pass."""
    plain = text.cast("string")
    return F.when(F.regexp_like(plain, F.lit("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")), plain.try_cast("date"))


def ntz(value) -> Column:
    """A timestamp_ntz literal from a naive (UTC wall-clock) datetime.

    Built from ISO text, so neither the Python process zone nor the session
    zone can shift it (a datetime literal would pass through both).
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def end_of_day(day: Column) -> Column:
    """as_of date -> timestamp_ntz at 23:59:59 of that day (the visibility cutoff)."""
    return F.timestamp_add("SECOND", F.lit(END_OF_DAY_SECONDS), day.cast("timestamp_ntz"))


def end_of_day_literal(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day) + dt.timedelta(seconds=END_OF_DAY_SECONDS)


def age_micros(now: Column, then: Column) -> Column:
    """Exact age in microseconds; timestamp_ntz arithmetic, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", then, now)
