"""Employee registry with decoded labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.functions.dates import DateLike, as_date
from rollcall.operators.relational import star_join

# Registry column -> (coded column, labels).
DECODED = {
    "unhealthy": ("unhealthy_code", codes.UNHEALTHY_LABELS),
    "hazard": ("hazard_code", codes.HAZARD_LABELS),
    "marital": ("marital_code", codes.MARITAL_LABELS),
    "schooling": ("schooling_code", codes.SCHOOLING_LABELS),
    "disabled": ("disabled_code", codes.DISABLED_LABELS),
    "disability": ("disability_code", codes.DISABILITY_LABELS),
    "hour_bank": ("hour_bank_code", codes.HOUR_BANK_LABELS),
}


def employee_registry(
    emp: DataFrame,
    jobs: DataFrame,
    cost_centres: DataFrame,
    unions: DataFrame,
    shifts: DataFrame,
    departments: DataFrame,
    active_only: bool = True,
) -> DataFrame:
    """Employees with job, cost centre, union, shift and department, and readable labels for the coded columns.

    The coded columns an input lacks are left out. An employee missing from one of the five tables has no row.
    """
    if active_only:
        emp = emp.filter(F.col("status") != "D")
    joined = star_join(
        emp,
        [
            (jobs, ["job"]),
            (cost_centres, ["branch", "cost_centre"]),
            (unions, ["union_code"]),
            (shifts, ["shift"]),
            (departments.select("dept", "dept_desc").distinct(), ["dept"]),
        ],
    )
    decoded = {
        name: codes.label(F.trim(source), labels) for name, (source, labels) in DECODED.items() if source in emp.columns
    }
    return joined.withColumns(decoded).drop(*[source for source, _ in DECODED.values()])


def admitted_between(registry: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """Registry rows admitted in a closed period."""
    return registry.filter(F.col("admission").between(as_date(first), as_date(last)))


def segment(df: DataFrame, text: str, column: str = "cost_centre_desc") -> DataFrame:
    """Rows whose description contains a text."""
    return df.filter(F.col(column).contains(text))
