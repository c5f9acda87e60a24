"""Date and time expressions.

Two day counts exist on purpose and are not interchangeable: the fact table
counts calendar boundaries, the feature table counts full 24-hour periods.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def boundary_days(start: Column, end: Column) -> Column:
    """Calendar midnights crossed between two timestamps."""
    return F.datediff(F.to_date(end), F.to_date(start))


def floored_days(start: Column, end: Column) -> Column:
    """Full 24-hour periods between two timestamps, rounded down (also below zero)."""
    span = micros(end) - micros(start)
    return ((span - F.pmod(span, F.lit(MICROS_PER_DAY))) / MICROS_PER_DAY).cast("int")


def sunday_weekday(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday, the calendar dimension's convention."""
    return F.dayofweek(day) - 1


def monday_weekday(day: Column) -> Column:
    """0 = Monday .. 6 = Sunday, the feature table's convention."""
    return F.weekday(day)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_month_number(year: Column, month: Column) -> Column:
    return year * 100 + month
