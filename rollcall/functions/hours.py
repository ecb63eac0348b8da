"""Hour quantities written as HH.MM (7.30 is 7 h 30 min).

They are summed as whole hundredths, which gives the same total in any order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_hundredths(c: Column) -> Column:
    """HH.MM as whole hundredths: 7.30 -> 730."""
    return F.round(c * 100).cast("long")


def hhmm_minutes(c: Column) -> Column:
    """HH.MM as minutes: 7.30 -> 450."""
    h = hhmm_hundredths(c)
    return F.floor(h / 100) * 60 + h % 100


def hundredths_to_hours(h: Column) -> Column:
    """Hundredths of HH.MM as decimal hours: 730 -> 7.5."""
    return F.floor(h / 100) + (h % 100) / 60


def hhmm_to_hours(c: Column) -> Column:
    """HH.MM as decimal hours: 7.30 -> 7.5."""
    return hundredths_to_hours(hhmm_hundredths(c))


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent, halves rounded to the even neighbour (12.5 hundredths are 0.12); NULL where ``whole`` is zero.

    Worked out in decimals, so that a value halfway between two results does not depend on binary fractions.
    """
    exact = F.try_divide(part.cast("decimal(20,6)") * 100, whole.cast("decimal(20,6)"))
    return F.bround(exact, digits).cast("double")
