"""Dates and times.

Instants are kept as TIMESTAMP_NTZ holding UTC, so no result depends on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.config import CIVIL_ZONE, CLOCK_OFFSETS

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
CLOCK_PATTERN = r"^(\d{1,2}):(\d{2}) ([ap])m ([a-z]{3})$"


def strict_date(text: str) -> date:
    """A run argument written YYYY-MM-DD; anything else is an error."""
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"{text!r} is no date written YYYY-MM-DD") from error


def parse_date(c: Column) -> Column:
    """Date, or null where the text is none."""
    return F.try_to_date(c.cast("string"), "yyyy-MM-dd")


def parse_utc(c: Column) -> Column:
    """Instant written like 2026-07-01T00:00:00Z, or null where the text is none."""
    plain = F.regexp_replace(c.cast("string"), r"Z$", "")
    return F.replace(plain, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def epoch_ms_to_utc(c: Column) -> Column:
    """Milliseconds since 1970 to a UTC instant; null where the value is no whole number."""
    ms = F.trim(c.cast("string")).try_cast("bigint")
    return F.expr(EPOCH) + F.make_dt_interval(
        secs=(ms / F.lit(1000)).cast("decimal(18,6)")
    )


def hour_start(ts: Column) -> Column:
    """Start of the hour of a zone-less timestamp."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def hour_index(ts: Column) -> Column:
    """Whole hours since 1970 of a zone-less timestamp."""
    days = F.datediff(ts.cast("date"), F.lit(date(1970, 1, 1)))
    return days.cast("bigint") * 24 + F.hour(ts)


def iso_weekday(d: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(d) + 1


def lst_to_utc(ts: Column, offset_hours: Column) -> Column:
    """Local standard time to UTC: one fixed offset the whole year, no summer time."""
    return ts - F.make_dt_interval(hours=offset_hours.cast("int"))


def civil_date(utc: Column, zone: str = CIVIL_ZONE) -> Column:
    """Calendar date of a UTC instant in a civil zone, summer time included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


def civil_hour(utc: Column, zone: str = CIVIL_ZONE) -> Column:
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def clock_to_utc(d: Column, clock: Column) -> Column:
    """Date plus clock text such as ``4:00 pm EDT`` to UTC.

    The abbreviation itself fixes the offset. A zone-name parser would read EST in July as summer
    time, which is not what the text says.
    """
    text = F.lower(F.trim(clock))
    hour12 = F.regexp_extract(text, CLOCK_PATTERN, 1).try_cast("int")
    minute = F.regexp_extract(text, CLOCK_PATTERN, 2).try_cast("int")
    half = F.regexp_extract(text, CLOCK_PATTERN, 3)
    offset = F.lit(None).cast("int")
    for name, hours in CLOCK_OFFSETS.items():
        offset = F.when(F.endswith(text, F.lit(" " + name.lower())), F.lit(hours)).otherwise(offset)
    hour24 = hour12 % 12 + F.when(half == "p", 12).otherwise(0)
    minutes = (hour24 - offset) * 60 + minute
    return d.cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)


def stamp_label(ts: Column) -> Column:
    """Label such as 20260731T045931Z."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
