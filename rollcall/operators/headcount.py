"""Head count, admissions, terminations and turnover; new-employee sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import DateLike, as_date, in_month_window
from rollcall.functions.hours import rate
from rollcall.operators.calendar import months_between
from rollcall.operators.relational import anti_load


def _ones(months: Column, head: int, admitted: int, terminated: int) -> Column:
    return F.transform(
        months,
        lambda m: F.struct(
            m.alias("month"),
            F.lit(head).alias("headcount"),
            F.lit(admitted).alias("admitted"),
            F.lit(terminated).alias("terminated"),
        ),
    )


def _one_month(month: Column, test: Column) -> Column:
    return F.when(test, F.array(month)).otherwise(F.array().cast("array<date>"))


def month_movements(emp: DataFrame, first: DateLike, months: int, snapshot: str = "next") -> DataFrame:
    """Head count, admissions and terminations per cost centre and month.

    The head count of a month looks at one snapshot day: with ``snapshot="next"`` the first day of the month after, with
    ``"start"`` its own first day. An employee counts when admitted before that day and not terminated before it.
    Each employee lists the months it counts in, so the range condition needs no join, and one pass over the
    employees feeds all three counts.
    """
    start = as_date(first)
    end = F.add_months(start, months - 1)
    lag = {"next": 0, "start": 1}[snapshot]
    adm, term = F.trunc("admission", "MM"), F.trunc("termination", "MM")
    counted = months_between(
        F.greatest(start, F.add_months(adm, lag)), F.least(end, F.add_months(term, lag - 1))
    )
    admitted = _one_month(adm, F.col("admission").isNotNull() & adm.between(start, end))
    terminated = _one_month(term, (F.col("status") == "D") & term.between(start, end))
    moves = F.concat(_ones(counted, 1, 0, 0), _ones(admitted, 0, 1, 0), _ones(terminated, 0, 0, 1))
    return (
        emp.select("cost_centre", F.explode(moves).alias("m"))
        .groupBy("cost_centre", F.col("m.month").alias("month"))
        .agg(*[F.sum(f"m.{c}").alias(c) for c in ("headcount", "admitted", "terminated")])
    )


def headcount(emp: DataFrame, first: DateLike, months: int, snapshot: str = "next") -> DataFrame:
    """Active employees per cost centre and month."""
    moves = month_movements(emp, first, months, snapshot)
    return moves.filter("headcount > 0").select("cost_centre", "month", "headcount")


def turnover(emp: DataFrame, first: DateLike, months: int) -> DataFrame:
    """Turnover rate per cost centre and month: the mean of admissions and terminations over the head count, in percent.

    A cost centre without head count in a month has no row for it.
    """
    moves = month_movements(emp, first, months).filter("headcount > 0")
    return moves.select(
        F.trim("cost_centre").alias("cost_centre"),
        F.date_format("month", "MM/yyyy").alias("month_label"),
        "headcount",
        "admitted",
        "terminated",
        rate((F.col("terminated") + F.col("admitted")) / 2, F.col("headcount")).alias("turnover_rate"),
    )


def terminated_flag(emp: DataFrame, as_of: DateLike, first: int = 0, last: int = 0) -> DataFrame:
    """Employees terminated in the calendar months ``first..last`` counted from ``as_of``, with a flag."""
    return emp.filter(in_month_window(F.col("termination"), as_of, first, last)).select(
        "branch", "emp_no", F.lit(True).alias("terminated")
    )


def new_employees(emp: DataFrame, cost_centres: DataFrame, departments: DataFrame, target: DataFrame) -> DataFrame:
    """Active employees, with their descriptions, whose number the target does not hold yet."""
    active = (
        emp.filter(F.col("status") != "D")
        .select("branch", "emp_no", "name", "admission", "cost_centre", "dept", "cpf")
        .distinct()
    )
    return (
        anti_load(active, target, ["emp_no"])
        .join(cost_centres, ["branch", "cost_centre"])
        .join(departments.select("dept", "cost_centre", "dept_desc").distinct(), ["dept", "cost_centre"])
    )
