"""Times of provider exports to zone-less UTC, and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import UTC_TIME


def local_to_utc(local: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` to UTC.

    The hour that occurs twice when clocks go back is read as its second pass (standard time);
    Spark alone would read the first.
    """
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    an_hour_on = F.convert_timezone(F.lit("UTC"), F.lit(zone), first + F.expr("INTERVAL 1 HOUR"))
    return first + F.when(an_hour_on == local, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))


def clock_parts(day: Column, time: Column) -> Column:
    """``a/b/yyyy`` + ``HH:mm:ss`` to its six numbers as text. Put it in a column of its own: both
    readings of the date share it."""
    return F.split(F.trim(F.concat(day, F.lit(" "), time)), "[/ :]+")


def clock_time(parts: Column, order: str) -> Column:
    """The reading of ``clock_parts`` as month first ('mdy') or day first ('dmy'); null where that is
    no calendar date. One-digit days and months are accepted."""
    def number(i: int) -> Column:
        return F.get(parts, i).try_cast("int")

    month, dom = (number(0), number(1)) if order == "mdy" else (number(1), number(0))
    year = F.when(F.size(parts) == 6, number(2))
    return F.try_make_timestamp_ntz(year, month, dom, number(3), number(4), number(5).cast("decimal(8,6)"))


def worded_date(day: Column, time: Column) -> Column:
    """``Jul 1, 2026`` + ``02:40:10`` to a timestamp; an unreadable value fails the run."""
    return F.to_timestamp_ntz(F.concat(day, F.lit(" "), time), F.lit("MMM d, yyyy HH:mm:ss"))


def utc(text: Column) -> Column:
    return text.cast(UTC_TIME)


def day_of(ts: Column) -> Column:
    return ts.cast("date")


def period_of(ts: Column, unit: str = "month") -> Column:
    """First day of the period a time falls in, as a date."""
    return F.trunc(day_of(ts), unit)
