"""Text functions, all built from native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Text without the blanks that pad fixed-width ERP columns."""
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """Stripped text; an empty value becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def remove_chars(c: Column, chars: str) -> Column:
    """Text without any of the given characters."""
    return F.trim(F.translate(c, chars, ""))


def pad_left(c: Column, width: int, fill: str = "0") -> Column:
    """Left-pad up to ``width``; longer text stays whole, NULL stays NULL."""
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def keep_last(c: Column, width: int) -> Column:
    """The last ``width`` characters; shorter text is unchanged."""
    return F.when(F.length(c) > width, F.right(c, F.lit(width))).otherwise(c)


def count_char(c: Column, char: str) -> Column:
    """How often a single character occurs."""
    return F.length(c) - F.length(F.translate(c, char, ""))


def drop_decimal_suffix(c: Column) -> Column:
    """Id text without the ``.0`` a float-typed column leaves at its end."""
    return F.regexp_replace(F.trim(c), r"\.0+$", "")


def comma_decimal(c: Column) -> Column:
    """Comma-decimal text (``7,33``) as double; anything else is NULL."""
    return F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")


def brazilian_money(c: Column) -> Column:
    """Money text such as ``1.234,56`` as decimal(18,2)."""
    plain = F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("decimal(18,2)")


def capture(c: Column, pattern: str, may_be_empty: bool = False) -> Column:
    """First capture group of a pattern, NULL where the pattern does not match.

    ``may_be_empty`` keeps an empty capture apart from a missing match.
    """
    found = F.regexp_extract(c, pattern, 1)
    if may_be_empty:
        return F.when(c.rlike(pattern), found)
    return F.nullif(found, F.lit(""))


def joined(values: Column, separator: str = " | ") -> Column:
    """A list rendered as one text."""
    return F.array_join(values, separator)


def run_text(value: Column, copies: Column) -> Column:
    """A value that occurs once as it is, and one that occurs N times as ``value xN``, whatever N is."""
    return F.when(copies > 1, F.concat(value, F.lit(" x"), copies.cast("string"))).otherwise(value)
