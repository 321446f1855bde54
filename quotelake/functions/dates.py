"""Dates and time zones, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compact_date(day: Column | str) -> Column:
    """A date as 'YYYYMMDD' text."""
    return F.date_format(_col(day), "yyyyMMdd")


def compact_date_int(text: Column | str) -> Column:
    """Date text ('YYYY-MM-DD') as the integer YYYYMMDD, NULL when unreadable."""
    return compact_date(_col(text).try_cast("date")).try_cast("int")


def calendar_text_date(text: Column | str) -> Column:
    """Date from 'MM/DD/YYYY' text; other text fails the job.

    Cutting the fixed-width text costs a fraction of a pattern parse.
    """
    text = _col(text)
    year, month, day = (F.substring(text, start, size).cast("int") for start, size in ((7, 4), (1, 2), (4, 2)))
    return F.make_date(year, month, day)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def week_end(day: Column | str) -> Column:
    """The Sunday that closes the ISO week of ``day``."""
    day = _col(day)
    return F.date_add(day, (F.lit(6) - F.weekday(day)).cast("int"))


def epoch_millis_utc(millis: Column | str) -> Column:
    """Epoch milliseconds as a UTC wall-clock timestamp without zone."""
    seconds = (_col(millis).cast("bigint") / F.lit(1000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return epoch + F.make_dt_interval(zero, zero, zero, seconds)


def eastern_time(utc: Column | str, zone: str = "America/New_York") -> Column:
    """UTC wall clock to the wall clock of ``zone`` (daylight saving included)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(utc))


def eastern_offset_text(utc: Column | str, local: Column | str) -> Column:
    """'YYYY-MM-DD HH:MM:SS±hhmm' for a local wall clock and its UTC twin."""
    utc, local = _col(utc), _col(local)
    minutes = F.timestamp_diff("MINUTE", utc, local).cast("int")
    size = F.abs(minutes)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    hours = F.lpad(F.floor(size / 60).cast("string"), 2, "0")
    rest = F.lpad((size % 60).cast("string"), 2, "0")
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), sign, hours, rest)
