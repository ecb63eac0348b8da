"""Current leave per employee, and whether it is paid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.functions.dates import DateLike, as_date
from rollcall.operators.relational import keep_first, keep_last

EMPLOYEE = ["branch", "emp_no"]


def open_leaves(
    leaves: DataFrame,
    leave_types: DataFrame,
    as_of: DateLike,
    excluded: Sequence[str] = tuple(codes.EXCLUDED_LEAVE_TYPES),
) -> DataFrame:
    """Leaves without an end and leaves that end later, with description and days since the start.

    ``priority`` is 0 for a leave without an end and 1 for the others; both come out of one scan.
    """
    now = as_date(as_of)
    running = F.col("end_date").isNull() | (F.col("end_date") > now)
    return (
        leaves.filter(running & ~F.col("leave_type").isin(list(excluded)))
        .join(leave_types, "leave_type")
        .withColumn("leave_desc", F.trim("leave_desc"))
        .withColumn("days_away", F.datediff(now, F.col("start_date")))
        .withColumn("priority", F.when(F.col("end_date").isNull(), 0).otherwise(1))
    )


def first_leave(
    leaves: DataFrame, leave_types: DataFrame, as_of: DateLike, excluded: Sequence[str] = tuple(codes.EXCLUDED_LEAVE_TYPES)
) -> DataFrame:
    """One running leave per employee: one without an end before one with an end, then the earliest start."""
    rows = open_leaves(leaves, leave_types, as_of, excluded)
    return keep_first(rows, EMPLOYEE, ["priority", "start_date", "leave_type"]).drop("priority")


def current_leave(
    leaves: DataFrame,
    leave_types: DataFrame,
    emp: DataFrame,
    unions: DataFrame,
    as_of: DateLike,
    excluded: Sequence[str] = tuple(codes.EXCLUDED_LEAVE_TYPES),
) -> DataFrame:
    """The first running leave of each employee, with name and union."""
    people = emp.select(*EMPLOYEE, "name", "union_code").join(unions, "union_code")
    return first_leave(leaves, leave_types, as_of, excluded).join(people, EMPLOYEE)


def latest_leave(leaves: DataFrame, leave_types: DataFrame, as_of: DateLike) -> DataFrame:
    """One leave per employee for the timesheet: the one that started last; no type is left out."""
    return keep_last(
        open_leaves(leaves, leave_types, as_of, excluded=()).drop("priority"), EMPLOYEE, ["start_date", "leave_type"]
    )


def payment_of(leave_desc: Column, days: Column, limit: Column, maternity_120: Column) -> Column:
    """Whether a leave is paid. The first rule that applies decides:

    disability retirement or prison: no; maternity leave paid by the company or extended, where the union grants 120
    days: yes; longer than the union's limit: no; shorter: yes; no days and no limit: no. What is left is undefined.
    """
    maternity = leave_desc.isin(codes.MATERNITY_LEAVES) & (maternity_120 == codes.YES)
    return (
        F.when(leave_desc.isin(codes.NEVER_PAID_LEAVES), codes.NOT_PAID)
        .when(maternity, codes.PAID)
        .when(days > limit, codes.NOT_PAID)
        .when(days < limit, codes.PAID)
        .when((days == 0) & (limit == 0), codes.NOT_PAID)
        .otherwise(codes.UNDEFINED)
    )


def leave_payment(leave: DataFrame, union_rules: DataFrame, missing_limit: int | None = 0) -> DataFrame:
    """Leaves with their payment; a paid-leave licence has no row. ``missing_limit`` is the limit of a union without a rule."""
    rules = union_rules.select("union_code", "maternity_120", "leave_limit_days")
    joined = leave.filter(F.col("leave_desc") != codes.PAID_LEAVE).join(rules, "union_code", "left")
    if missing_limit is not None:
        joined = joined.fillna(missing_limit, subset=["leave_limit_days"])
    columns = [F.col(c) for c in ("leave_desc", "days_away", "leave_limit_days", "maternity_120")]
    return joined.withColumn("payment", payment_of(*columns))
