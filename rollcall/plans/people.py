"""Queries on head count, absenteeism, absence days, leave and the employee registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.operators import absence, calendar, headcount, intervals, leave, registry
from rollcall.plans import roles
from rollcall.plans.report import report

YEAR = ("1998-01-01", "1999-01-01")


def month_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The months from the first order to the last."""
    orders = roles.table(spark, folder, "orders")
    first, last = (orders.agg(f(F.trunc("o_orderdate", "MM"))).scalar() for f in (F.min, F.max))
    months = F.months_between(last, first).cast("int") + 1
    return report(calendar.month_dim(spark, first, months, "next"))


def turnover_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return report(headcount.turnover(roles.employees(spark, folder), roles.FIRST_MONTH, roles.MONTHS))


def turnover_report(spark: SparkSession, folder: str) -> DataFrame:
    """Turnover, the latest month first; months sort as dates, not by their label."""
    rows = headcount.turnover(roles.employees(spark, folder), roles.FIRST_MONTH, roles.MONTHS)
    month = F.to_date(F.concat(F.lit("01/"), F.col("month_label")), "dd/MM/yyyy")
    return report(rows.orderBy(month.desc(), "cost_centre"), "month_label", "cost_centre", "turnover_rate")


def headcount_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return report(headcount.headcount(roles.employees(spark, folder), roles.FIRST_MONTH, roles.MONTHS, "start"))


def headcount_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Active employees per cost centre on days at irregular distances: admitted before the day and not terminated before it."""
    counted = intervals.counts_on(
        roles.snapshots(spark, folder), roles.employees(spark, folder), "day", "admission", "termination", ["cost_centre"], True, "headcount"
    )
    return report(counted)


def active_on_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The employees themselves on each of these days, as their number and the sum of their salaries per branch."""
    emp = roles.employees(spark, folder).select("branch", "emp_no", "admission", "termination")
    pairs = intervals.interval_join(roles.snapshots(spark, folder), emp, "day", "admission", "termination", after_start=True)
    return report(pairs.groupBy("branch", "day").agg(F.count(F.lit(1)).alias("employees"), F.sum("emp_no").alias("numbers")))


def events_on_leave(spark: SparkSession, folder: str) -> DataFrame:
    """Clock events of employees on days on which they were on leave."""
    events = roles.clock_events(spark, folder, *YEAR).select("branch", "emp_no", "date", "code")
    leaves = roles.leaves(spark, folder)
    pairs = intervals.interval_join(events, leaves, "date", "start_date", "end_date", ["branch", "emp_no"])
    return report(pairs.groupBy("emp_no", "date", "leave_type").agg(F.count(F.lit(1)).alias("events"), F.min("start_date").alias("first_start")))


def active_days(spark: SparkSession, folder: str) -> DataFrame:
    emp = roles.employees(spark, folder).select("branch", "emp_no", "admission", "termination")
    spine = calendar.active_day_spine(emp, roles.FIRST_MONTH, roles.MONTHS)
    return report(spine.groupBy("branch", "day").agg(F.count(F.lit(1)).alias("employees")))


def scheduled_hours(spark: SparkSession, folder: str) -> DataFrame:
    return report(absence.scheduled_hours(roles.schedule(spark, folder)))


def absence_hours(spark: SparkSession, folder: str) -> DataFrame:
    measures = {
        "all": (F.lit(True), "1998-12-31"),
        "unwaived": (F.col("waiver") == "", "1998-10-31"),
        "medical": (F.col("waiver") == codes.MEDICAL_WAIVER, "1998-12-31"),
    }
    rows = absence.absence_hours(
        roles.clock_events(spark, folder, *YEAR), roles.FIRST_MONTH, measures, codes.ABSENCE_CODES
    )
    return report(rows.fillna(0))


def absenteeism_rate(spark: SparkSession, folder: str) -> DataFrame:
    rows = absence.absenteeism(
        roles.employees(spark, folder),
        roles.clock_events(spark, folder, *YEAR),
        roles.schedule(spark, folder),
        roles.cost_centres(spark, folder),
        roles.FIRST_MONTH,
        roles.MONTHS,
    )
    return report(rows)


def absenteeism_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = absence.absenteeism_split(
        roles.employees(spark, folder),
        roles.clock_events(spark, folder, *YEAR),
        roles.schedule(spark, folder),
        roles.cost_centres(spark, folder),
        roles.shifts(spark),
        roles.FIRST_MONTH,
        roles.MONTHS,
        unwaived_until="1998-10-31",
    )
    return report(rows)


def catalogue(spark: SparkSession, folder: str, how: str = "right") -> DataFrame:
    return absence.shift_catalogue(
        roles.employees(spark, folder), roles.shifts(spark), roles.shift_hours(spark), how
    )


def absences(spark: SparkSession, folder: str, until: str | None = None) -> DataFrame:
    """Absence days of the cycle that starts after ``CYCLE_START``."""
    return absence.absence_days(
        roles.clock_events(spark, folder, roles.CYCLE_START, until),
        absence.planned_hours(roles.employees(spark, folder), roles.shifts(spark), catalogue(spark, folder)),
        roles.CYCLE_START,
        until,
    )


def medical_days(spark: SparkSession, folder: str) -> DataFrame:
    return report(absence.medical_days(absences(spark, folder)))


def unexcused_days(spark: SparkSession, folder: str) -> DataFrame:
    return report(absence.unexcused_days(absences(spark, folder)))


def absence_days_cycle(spark: SparkSession, folder: str) -> DataFrame:
    return report(absences(spark, folder, "1998-07-21"))


def shift_catalogue_check(spark: SparkSession, folder: str) -> DataFrame:
    return report(catalogue(spark, folder).fillna(0.0, subset=["main_hours", "secondary_hours"]))


def shift_catalogue_outer(spark: SparkSession, folder: str) -> DataFrame:
    return report(catalogue(spark, folder, "full_outer").fillna(0.0, subset=["main_hours", "secondary_hours"]))


def terminated_employees(spark: SparkSession, folder: str) -> DataFrame:
    return report(headcount.terminated_flag(roles.employees(spark, folder), roles.AS_OF, 0, 1))


def new_employees(spark: SparkSession, folder: str) -> DataFrame:
    rows = headcount.new_employees(
        roles.employees(spark, folder),
        roles.cost_centres(spark, folder),
        roles.departments(spark, folder),
        roles.synced_employees(spark, folder),
    )
    return report(rows)


def erp_normalize(spark: SparkSession, folder: str) -> DataFrame:
    rows = roles.normalized_employees(spark, folder)
    return report(rows, "branch", "emp_no", "name", "admission", "termination", "cost_centre", "dept", "union_code")


def registry_rows(spark: SparkSession, folder: str, active_only: bool = True) -> DataFrame:
    return registry.employee_registry(
        roles.normalized_employees(spark, folder),
        roles.jobs(spark),
        roles.cost_centres(spark, folder),
        roles.unions(spark),
        roles.shifts(spark),
        roles.departments(spark, folder),
        active_only,
    )


def employee_registry(spark: SparkSession, folder: str) -> DataFrame:
    return report(registry_rows(spark, folder))


def admitted_between(spark: SparkSession, folder: str) -> DataFrame:
    rows = registry.admitted_between(registry_rows(spark, folder), "1998-02-01", "1998-02-28")
    return report(rows, "branch", "emp_no", "name", "admission", "cost_centre_desc", "job_desc")


def registry_segment(spark: SparkSession, folder: str) -> DataFrame:
    rows = registry.segment(registry_rows(spark, folder, active_only=False), "ABANDONO")
    return report(rows, "branch", "emp_no", "cost_centre_desc", "status", "termination")


def leave_now(spark: SparkSession, folder: str) -> DataFrame:
    return leave.current_leave(
        roles.leaves(spark, folder),
        roles.leave_types(spark),
        roles.employees(spark, folder),
        roles.unions(spark),
        roles.AS_OF,
    )


def payments(spark: SparkSession, folder: str, missing_limit: int | None = 0) -> DataFrame:
    return leave.leave_payment(leave_now(spark, folder), roles.union_rules(spark), missing_limit)


def current_leave(spark: SparkSession, folder: str) -> DataFrame:
    return report(leave_now(spark, folder))


def latest_leave(spark: SparkSession, folder: str) -> DataFrame:
    rows = leave.latest_leave(roles.leaves(spark, folder), roles.leave_types(spark), roles.AS_OF)
    return report(rows)


def leave_payment(spark: SparkSession, folder: str) -> DataFrame:
    rows = payments(spark, folder)
    return report(rows, "branch", "emp_no", "leave_desc", "union_code", "days_away", "leave_limit_days", "payment")
