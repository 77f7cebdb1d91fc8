"""Column builders for dates and times. None depends on the session time zone
as long as the text carries its own zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date followed by at least hours and minutes.
FULL = r"^\s*[+-]?\d{4,6}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}"


def parse_instant(value: Column) -> Column:
    """An ISO date with a time as a timestamp; null for any other text.

    Spark would complete a time, or a year, from the clock of the run.
    """
    return F.when(value.cast("string").rlike(FULL), F.try_to_timestamp(value))


def calendar_day(value: Column) -> Column:
    """The day as written in an ISO text (its offset is not applied), else null."""
    return value.try_cast("date")


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end`` as a double, on whole seconds."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / 60


def utc_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, as a timestamp without zone."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_day(instant: Column) -> Column:
    return utc_clock(instant).cast("date")


def utc_minute_text(instant: Column) -> Column:
    """``2026-07-01 10:00 UTC``."""
    return F.concat(F.substring(utc_clock(instant).cast("string"), 1, 16), F.lit(" UTC"))


def utc_iso_text(instant: Column) -> Column:
    """``2026-07-01T10:00:00+00:00``; six fraction digits unless they are all zero."""
    text = F.translate(utc_clock(instant).cast("string"), " ", "T")
    whole = F.substring(text, 1, 19)
    micros = F.unix_micros(instant) % 1_000_000
    fraction = F.concat(F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    return F.concat(whole, F.when(micros != 0, fraction).otherwise(""), F.lit("+00:00"))
