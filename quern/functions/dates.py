"""Dates held as numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_number(value: Column) -> Column:
    """Date of an eight-digit number yyyymmdd; NULL for zero, other lengths and impossible days.

    Arithmetic instead of parsing: an impossible day costs no exception.
    """
    year, month, day = (value / 10_000).cast("int"), (value / 100 % 100).cast("int"), (value % 100).cast("int")
    first = F.when((value >= 10_000_000) & (value <= 99_999_999) & month.between(1, 12), F.make_date(year, month, F.lit(1)))
    return F.when((day >= 1) & (day <= F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1))


def past_only(value: Column, as_of: Column | None = None) -> Column:
    """NULL for a date after ``as_of`` (now, when not given)."""
    bound = F.current_timestamp() if as_of is None else as_of
    return F.when(value > bound, F.lit(None)).otherwise(value)


def month_start(value: Column) -> Column:
    """First day of a month written yyyy-MM; a text of another form fails the job."""
    parsed = F.try_to_timestamp(value, F.lit("yyyy-MM"))
    wrong = F.raise_error(F.concat(F.lit("not a month: "), value)).cast("timestamp")
    return F.when(value.isNull() | parsed.isNotNull(), parsed).otherwise(wrong)
