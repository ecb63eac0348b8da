"""Dates, pay cycles and clock times.

Functions that the source systems tie to "today" take an ``as_of`` date instead, so that a run can be repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = Column | dt.date | str


def as_date(value: DateLike) -> Column:
    """A column, a Python date or ISO text as a date column."""
    if isinstance(value, Column):
        return value
    return F.to_date(F.lit(str(value)))


def erp_date(c: Column, fmt: str = "yyyyMMdd") -> Column:
    """ERP date text as a date. Blank, invalid and the 1900-01-01 stand-in for blank are NULL."""
    parsed = F.try_to_date(F.trim(c), fmt)
    return F.nullif(parsed, F.to_date(F.lit("1900-01-01")))


def period_date(c: Column) -> Column:
    """A ``yyyyMM`` number as the first day of that month; an invalid month is NULL."""
    whole = F.floor(c).cast("string")
    return F.try_to_date(F.concat(whole, F.lit("01")), "yyyyMMdd")


def weekday_label(d: Column, labels: list[str]) -> Column:
    """Label of a weekday, Monday first."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.weekday(d) + 1)


def month_start(as_of: DateLike, months: int = 0) -> Column:
    return F.add_months(F.trunc(as_date(as_of), "MM"), months)


def month_end(as_of: DateLike, months: int = 0) -> Column:
    return F.last_day(F.add_months(as_date(as_of), months))


def in_month_window(d: Column, as_of: DateLike, first: int = 0, last: int = 0) -> Column:
    """Whether a date lies in the calendar months ``first..last`` counted from ``as_of``."""
    return d.between(month_start(as_of, first), month_end(as_of, last))


def between_open(d: Column, low: DateLike | None, high: DateLike | None) -> Column:
    """Open range ``low < d < high``; a missing bound does not restrict."""
    test = F.lit(True)
    if low is not None:
        test = test & (d > as_date(low))
    if high is not None:
        test = test & (d < as_date(high))
    return test


def pay_cycle(as_of: DateLike) -> tuple[Column, Column]:
    """First and last day of the pay cycle: day 21 of the month before yesterday's, and yesterday."""
    yesterday = F.date_sub(as_date(as_of), 1)
    return F.date_add(F.add_months(F.trunc(yesterday, "MM"), -1), 20), yesterday


def weekday_count(first: Column, last: Column, dow: Column | int) -> Column:
    """How many days of ``first..last`` fall on a weekday (Sunday = 1), without listing the days."""
    days = F.greatest(F.datediff(last, first) + 1, F.lit(0))
    skip = F.pmod(F.lit(dow) - F.dayofweek(first), F.lit(7))
    return F.floor((days - skip + 6) / 7).cast("int")


def clock_minutes(text: Column) -> Column:
    """``HHmm`` text as minutes of the day; anything that is no time is NULL."""
    hour = F.substring(text, 1, 2).try_cast("int")
    minute = F.substring(text, 3, 2).try_cast("int")
    return F.when(hour.between(0, 23) & minute.between(0, 59), hour * 60 + minute)


def clock_seconds(text: Column) -> Column:
    """``HH:mm:ss`` text as seconds of the day; anything that is no time is NULL."""
    time = F.try_to_timestamp(F.trim(text), F.lit("HH:mm:ss"))
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def minutes_text(minutes: Column) -> Column:
    """Minutes of the day as ``HH:mm:00``."""
    return F.format_string("%02d:%02d:00", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"))


def punch_timestamp(text: Column) -> Column:
    """``ddMMyyyyHHmmss`` text as a timestamp."""
    return F.try_to_timestamp(text, F.lit("ddMMyyyyHHmmss"))
