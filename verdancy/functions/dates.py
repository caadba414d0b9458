"""Calendar arithmetic; weekdays are 0 for Monday to 6 for Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weekday labels.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def weekday_label(day: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in WEEKDAYS]), F.weekday(day))


def add_business_days(start: Column, n: Column) -> Column:
    """The n-th Monday-to-Friday day after start (start itself for n = 0), in closed form."""
    # from a weekend, count on from the Friday before
    back = F.greatest(F.lit(0), F.weekday(start) - 4)
    from_friday = F.date_sub(start, back)
    at = F.weekday(from_friday) + n
    weeks = F.floor(at / 5).cast("int")
    return F.when(n == 0, start).otherwise(F.date_add(from_friday, (weeks * 7 + (at % 5) - F.weekday(from_friday)).cast("int")))


def working_days(start: Column, end: Column) -> Column:
    """Monday-to-Friday days from start to end, both counted; 0 if end is before start."""
    upto = lambda d: F.floor(d / 7) * 5 + F.least(d % 7, F.lit(5))  # noqa: E731  days since a Monday
    monday = F.to_date(F.lit("1900-01-01"))
    return F.when(end < start, 0).otherwise(upto(F.datediff(end, monday) + 1) - upto(F.datediff(start, monday))).cast("int")


def age_on(birth: Column, day: Column) -> Column:
    """Full years, by month and day."""
    later = F.struct(F.month(day), F.dayofmonth(day)) < F.struct(F.month(birth), F.dayofmonth(birth))
    return F.year(day) - F.year(birth) - later.cast("int")


def same_month(a: Column, b: Column) -> Column:
    return F.trunc(a, "MM") == F.trunc(b, "MM")


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Closed intervals that share a day."""
    return ~((a_end < b_start) | (a_start > b_end))
