"""Month dimension, active months and days of an employee."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.dates import DateLike, as_date


def month_columns(month: Column, snapshot: str = "start") -> list[Column]:
    """Number, label, first, last and snapshot day of a month. ``snapshot="next"`` is the first day of the month after."""
    shift = {"start": 0, "next": 1}[snapshot]
    return [
        F.month(month).alias("month_no"),
        F.date_format(month, "MM/yyyy").alias("month_label"),
        month.alias("first_day"),
        F.last_day(month).alias("last_day"),
        F.add_months(month, shift).alias("snapshot_day"),
    ]


def month_dim(spark: SparkSession, first: DateLike, months: int | Column, snapshot: str = "start") -> DataFrame:
    """One row per month, for a number of months."""
    start = as_date(first)
    month = F.explode(months_between(start, F.add_months(start, months - 1))).alias("month")
    return spark.range(1).select(month).select(*month_columns(F.col("month"), snapshot))


def months_between(low: Column, high: Column) -> Column:
    """Array of the first days of months ``low..high``; empty where low is after high."""
    return F.when(low <= high, F.sequence(low, high, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def active_months(emp: DataFrame, first: DateLike, months: int) -> DataFrame:
    """One row per employee and month of employment, with the first and last active day.

    An employee counts in a month when admitted by its last day and not terminated by its first day.
    """
    start = as_date(first)
    low = F.greatest(start, F.trunc("admission", "MM"))
    high = F.least(F.add_months(start, months - 1), F.trunc("termination", "MM"))
    return (
        emp.withColumn("month", F.explode(months_between(low, high)))
        .filter(F.col("termination").isNull() | (F.col("termination") > F.col("month")))
        .withColumn("start_day", F.greatest("admission", "month"))
        .withColumn("end_day", F.least("termination", F.last_day("month")))
        .filter("start_day <= end_day")
    )


def active_day_spine(emp: DataFrame, first: DateLike, months: int) -> DataFrame:
    """One row per employee and active day."""
    spans = active_months(emp, first, months)
    days = F.sequence("start_day", "end_day", F.expr("interval 1 day"))
    return spans.withColumn("day", F.explode(days)).drop("start_day", "end_day")


def day_grid(emp: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """Every employee on every day of a period."""
    return emp.withColumn("day", F.explode(F.sequence(as_date(first), as_date(last), F.expr("interval 1 day"))))
