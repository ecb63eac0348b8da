"""Scheduled hours, absenteeism and absence days."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.functions.dates import DateLike, as_date, between_open, weekday_count, weekday_label
from rollcall.functions.hours import hhmm_minutes, rate
from rollcall.functions.text import comma_decimal, strip
from rollcall.operators.calendar import active_months

EMPLOYEE = ["branch", "emp_no"]
WEEKDAYS = range(1, 8)


def scheduled_hours(schedule: DataFrame) -> DataFrame:
    """Planned minutes and hours per shift, week and day: the sum of up to four intervals, given in minutes."""
    intervals = [F.coalesce(F.col(f"out{i}") - F.col(f"in{i}"), F.lit(0)) for i in range(1, 5)]
    total = intervals[0] + intervals[1] + intervals[2] + intervals[3]
    return (
        schedule.groupBy("shift", "week", "day")
        .agg(F.sum(total).alias("minutes"))
        .withColumn("hours", F.col("minutes") / 60)
    )


def weekday_minutes(schedule: DataFrame, keys: Sequence[str] = ("week", "day")) -> DataFrame:
    """One row per shift with its planned minutes per weekday, ``m1`` (Sunday) to ``m7``.

    A day of the plan counts for the weekday that all of ``keys`` name, by default both its week and its day number. Where
    several days of a plan then count for a weekday, the longest does.
    """
    planned = scheduled_hours(schedule)

    def on(w: int) -> Column:
        return reduce(and_, [F.col(k) == w for k in keys])

    return planned.groupBy("shift").agg(*[F.max(F.when(on(w), F.col("minutes"))).alias(f"m{w}") for w in WEEKDAYS])


def ideal_minutes(first: Column, last: Column, default: Column) -> Column:
    """Planned minutes of a span of days, from the ``m1..m7`` columns; ``default`` fills an unplanned weekday."""
    return reduce(add, [weekday_count(first, last, w) * F.coalesce(F.col(f"m{w}"), default) for w in WEEKDAYS])


def absence_hours(
    events: DataFrame, first: DateLike, measures: dict[str, tuple[Column, DateLike]], codes_in: Sequence[str]
) -> DataFrame:
    """Absence minutes per employee and month, one column ``<measure>_minutes`` each, in one pass over the events.

    A measure is a condition on the event and the last day it looks at.
    """
    low, high = as_date(first), F.greatest(*[as_date(d) for _, d in measures.values()], F.lit(None))
    minutes = hhmm_minutes(F.col("hours_calc"))
    sums = [
        F.sum(F.when(test & (F.col("date") <= as_date(last)), minutes)).alias(f"{name}_minutes")
        for name, (test, last) in measures.items()
    ]
    return (
        events.filter(F.col("code").isin(list(codes_in)) & F.col("date").between(low, high))
        .groupBy(*EMPLOYEE, F.trunc("date", "MM").alias("month"))
        .agg(*sums)
    )


def _monthly(
    emp: DataFrame,
    events: DataFrame,
    schedule: DataFrame,
    first: DateLike,
    months: int,
    measures: dict[str, tuple[Column, DateLike]],
    codes_in: Sequence[str],
) -> DataFrame:
    spans = active_months(emp.join(weekday_minutes(schedule), "shift", "left"), first, months)
    planned = spans.withColumn(
        "ideal_minutes", ideal_minutes(F.col("start_day"), F.col("end_day"), F.col("daily_hours") * 60)
    )
    absent = absence_hours(events, first, measures, codes_in)
    joined = planned.join(absent, [*EMPLOYEE, "month"], "left")
    hours = {f"{name}_hours": F.coalesce(F.col(f"{name}_minutes"), F.lit(0)) / 60 for name in ["ideal", *measures]}
    return joined.withColumns(hours)


def absenteeism(
    emp: DataFrame,
    events: DataFrame,
    schedule: DataFrame,
    cost_centres: DataFrame,
    first: DateLike,
    months: int,
    codes_in: Sequence[str] = tuple(codes.ABSENCE_CODES),
) -> DataFrame:
    """Absenteeism rate per employee and month: absent hours over planned hours, in percent.

    Planned hours come from counting weekdays per span, so no row per day is built, and descriptions join last.
    """
    last = F.last_day(F.add_months(as_date(first), months - 1))
    measures = {"absent": (F.lit(True), last)}
    rows = _monthly(emp, events, schedule, first, months, measures, codes_in)
    return rows.join(cost_centres, ["branch", "cost_centre"], "left").select(
        F.date_format("month", "dd/MM/yyyy").alias("month_label"),
        "emp_no",
        "name",
        F.trim("cost_centre").alias("cost_centre"),
        "cost_centre_desc",
        "shift",
        "branch",
        "ideal_hours",
        "absent_hours",
        rate(F.coalesce("absent_minutes", F.lit(0)), F.col("ideal_minutes")).alias("absenteeism_rate"),
    )


def absenteeism_split(
    emp: DataFrame,
    events: DataFrame,
    schedule: DataFrame,
    cost_centres: DataFrame,
    shifts: DataFrame,
    first: DateLike,
    months: int,
    unwaived_until: DateLike,
    codes_in: Sequence[str] = tuple(codes.ABSENCE_CODES),
) -> DataFrame:
    """Absent hours without waiver and with a medical waiver, side by side, per employee and month."""
    last = F.last_day(F.add_months(as_date(first), months - 1))
    measures = {
        "absent": (F.col("waiver") == "", as_date(unwaived_until)),
        "medical": (F.col("waiver") == codes.MEDICAL_WAIVER, last),
    }
    rows = _monthly(emp.join(shifts, "shift"), events, schedule, first, months, measures, codes_in)
    return rows.join(cost_centres, ["branch", "cost_centre"], "left").select(
        F.date_format("month", "MM/yyyy").alias("month_label"),
        "emp_no",
        "name",
        "cost_centre",
        "cost_centre_desc",
        "shift",
        "shift_desc",
        "branch",
        "ideal_hours",
        "absent_hours",
        "medical_hours",
    )


def shift_hours_dim(raw: DataFrame) -> DataFrame:
    """Shift-hours sheet with its comma-decimal texts as numbers."""
    return raw.select(
        strip(F.col("shift_desc")).alias("shift_desc"),
        F.coalesce(comma_decimal(F.col("main_hours")), F.lit(0.0)).alias("main_hours"),
        F.coalesce(comma_decimal(F.col("secondary_hours")), F.lit(0.0)).alias("secondary_hours"),
        strip(F.col("secondary_weekday")).alias("secondary_weekday"),
    )


def shifts_in_use(emp: DataFrame, shifts: DataFrame) -> DataFrame:
    """Shifts of employees who have not left, one row per code and description."""
    return (
        emp.filter(F.col("status") != "D")
        .select("shift")
        .distinct()
        .join(shifts, "shift")
        .select("shift", strip(F.col("shift_desc")).alias("shift_desc"))
        .distinct()
    )


def shift_catalogue(emp: DataFrame, shifts: DataFrame, hours: DataFrame, how: str = "right") -> DataFrame:
    """Shift-hours sheet against the shifts in use: ``right`` keeps every shift in use, ``full_outer`` also sheet rows
    no shift uses. One row per shift code; ``shift_missing`` marks shifts without hours.
    """
    sheet = hours.withColumn("in_sheet", F.lit(True))
    joined = sheet.join(shifts_in_use(emp, shifts), "shift_desc", how)
    flagged = joined.withColumn("shift_missing", F.col("in_sheet").isNull()).drop("in_sheet")
    matched = flagged.filter("shift IS NOT NULL")
    first = (
        matched.groupBy("shift")
        .agg(F.min(F.struct(*[c for c in matched.columns if c != "shift"])).alias("r"))
        .select("shift", "r.*")
        .select(*flagged.columns)
    )
    return first if how == "right" else first.unionByName(flagged.filter("shift IS NULL"))


def hours_for_day(day: Column, labels: Sequence[str] = tuple(codes.ABSENCE_WEEKDAYS)) -> Column:
    """Planned hours of a shift on a date: the secondary weekday has hours of its own."""
    return F.when(
        weekday_label(day, list(labels)) == F.col("secondary_weekday"), F.col("secondary_hours")
    ).otherwise(F.col("main_hours"))


def is_absent_day(hours: Column, planned: Column) -> Column:
    """1 from half a planned day on. A shift without planned hours counts as a whole day."""
    return F.when(F.try_divide(hours, planned) < 0.5, 0).otherwise(1)


def planned_hours(emp: DataFrame, shifts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Planned hours of the day for each employee, from the catalogue of shifts."""
    return (
        emp.select(*EMPLOYEE, "shift")
        .join(shifts.select("shift").distinct(), "shift")
        .join(catalogue.select("shift", "main_hours", "secondary_hours", "secondary_weekday"), "shift", "left")
    )


def absence_days(
    events: DataFrame, planned: DataFrame, since: DateLike | None, until: DateLike | None = None
) -> DataFrame:
    """Medical and unexcused absence days per employee, with one scan of the events.

    ``planned`` has the hours of each employee's shift. HH.MM quantities become minutes row by row and add up per employee
    and date; that total decides whether the day counts.
    """
    medical = ~F.col("waiver").isin(codes.NON_MEDICAL_WAIVERS)
    unexcused = (F.col("waiver") == "") & (F.col("code") == codes.UNEXCUSED_CODE)
    daily = (
        events.filter(between_open(F.col("date"), since, until) & (medical | unexcused))
        .groupBy(*EMPLOYEE, "date")
        .agg(
            F.sum(F.when(medical, hhmm_minutes(F.col("hours_waived")))).alias("medical"),
            F.sum(F.when(unexcused, hhmm_minutes(F.col("hours_calc")))).alias("unexcused"),
        )
        .filter("medical > 0 OR unexcused IS NOT NULL")
    )
    hours = hours_for_day(F.col("date"))
    flags = daily.join(planned, EMPLOYEE).select(
        *EMPLOYEE,
        F.when(F.col("medical") > 0, is_absent_day(F.col("medical") / 60, hours)).alias("medical"),
        F.when(
            F.col("unexcused").isNotNull(), is_absent_day(F.col("unexcused") / 60, hours)
        ).alias("unexcused"),
    )
    return (
        flags.groupBy(*EMPLOYEE)
        .agg(
            F.coalesce(F.sum("medical"), F.lit(0)).alias("medical_days"),
            F.coalesce(F.sum("unexcused"), F.lit(0)).alias("unexcused_days"),
        )
        .filter("medical_days > 0 OR unexcused_days > 0")
    )


def medical_days(days: DataFrame) -> DataFrame:
    """Employees with medical absence days."""
    return days.filter("medical_days > 0").select(*EMPLOYEE, "medical_days")


def unexcused_days(days: DataFrame) -> DataFrame:
    """Employees with unexcused absence days."""
    return days.filter("unexcused_days > 0").select(*EMPLOYEE, "unexcused_days")
