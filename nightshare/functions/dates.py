"""Calendar helpers. Weekdays run from 1 (Monday) to 7 (Sunday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def saturday_after(day: Column) -> Column:
    """The next Saturday, never the day itself."""
    return F.next_day(day, "Sat")


def saturday_before(day: Column) -> Column:
    return F.date_sub(F.next_day(day, "Sat"), F.when(F.weekday(day) == 5, 14).otherwise(7))


def nth_weekday(month_start: Column, weekday: str, n: int) -> Column:
    """The n-th given weekday of a month, for example the second Sunday."""
    return F.date_add(F.next_day(F.date_sub(month_start, 1), weekday), 7 * (n - 1))


def dates_valid(start: Column, end: Column, capture: Column, back: int = 2, ahead: int = 3) -> Column:
    """Both dates parse, are in order, and start within some years of the capture."""
    ok = (start <= end) & (F.year(start) - F.year(capture)).between(-back, ahead)
    return F.coalesce(ok, F.lit(False))


def lead_days(night: Column, capture: Column) -> Column:
    return F.datediff(night, capture)
