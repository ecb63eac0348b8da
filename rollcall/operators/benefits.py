"""Meal and food benefit entitlement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.functions.dates import DateLike, as_date, in_month_window, month_end, month_start, weekday_count
from rollcall.operators.leave import payment_of
from rollcall.operators.relational import fill_missing, keyed_join, label_by

EMPLOYEE = ["branch", "emp_no"]

# Shift classes in the order they are tried: a text, and whether a description with DIAS is left out.
SHIFT_CLASSES = [
    ("25 DIAS", False), ("30 DIAS", False), ("12X36", True), ("FOL SAB", True), ("FOL DOM", True), ("4X2", True),
    ("SAB", True),
]


@dataclass(frozen=True)
class Benefit:
    """What tells one benefit run from another."""

    voucher_type: str
    benefit_types: tuple[str, ...]
    base_days: str = "prop_days"
    site_from_dept: bool = False
    admitted_months: tuple[int, int] = (0, 0)
    terminated_months: tuple[int, int] = (0, 0)
    missing_limit: int | None = None


FOOD = Benefit("2", ("90", "92"), missing_limit=0)
FOOD_SHEET = Benefit("2", ("90", "92"))
MEAL_TICKET = Benefit("1", ("87",))
MEAL_TICKET_SHEET = Benefit("1", ("87",), base_days="calc_days", admitted_months=(-1, -1), terminated_months=(0, 1))
MEAL_CARD = Benefit("2", ("94",), site_from_dept=True)


def shift_class(description: Column) -> Column:
    """Class 1..7 of a shift by its description, 0 if none fits."""
    by_days = description.contains("DIAS")
    result = F
    for number, (text, without_days) in enumerate(SHIFT_CLASSES, start=1):
        test = description.contains(text)
        result = result.when(test & ~by_days if without_days else test, number)
    return result.otherwise(0)


def prorata_days(admission_day: Column, klass: Column, count_month: DateLike, holidays: Column) -> Column:
    """Benefit days of an employee admitted on a day of the month, by shift class.

    Days are counted in ``count_month``. Saturdays and Sundays count from the admission day on, holidays over the whole
    month. Class 3 (12x36) takes every second day from the admission day on; class 6 (4x2) twenty thirtieths, halves
    to the even number.
    """
    start, last_day = month_start(count_month), month_end(count_month)
    left = F.dayofmonth(last_day) - admission_day
    since = F.date_add(start, admission_day - 1)
    saturdays, sundays = weekday_count(since, last_day, 7), weekday_count(since, last_day, 1)
    every_second = F.when(left >= 0, F.floor(left / 2) + 1).otherwise(0)
    days = (
        F.when(klass.isin(1, 2), left)
        .when(klass == 3, every_second)
        .when(klass == 4, left - saturdays)
        .when(klass == 5, left - sundays)
        .when(klass == 6, F.bround(left * 20 / 30, 0))
        .when(klass == 7, left - holidays - sundays)
        .otherwise(left - saturdays - sundays - holidays)
    )
    return days.cast("int")


def holidays_in_month(holidays: DataFrame, month: DateLike) -> Column:
    """How many different dates of a holiday table fall in a month."""
    found = holidays.filter(in_month_window(F.col("date"), month)).select("date").distinct()
    return found.agg(F.count("date")).scalar()


def admission_prorata(
    emp: DataFrame,
    shifts: DataFrame,
    holidays: DataFrame,
    as_of: DateLike,
    count_month: DateLike | None = None,
    months: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Benefit days of employees admitted in the months around ``as_of`` and still employed.

    Days are counted in the month before ``as_of`` unless ``count_month`` names another.
    """
    counted = F.add_months(as_date(as_of), -1) if count_month is None else as_date(count_month)
    admitted = emp.filter(in_month_window(F.col("admission"), as_of, *months) & F.col("termination").isNull())
    classed = admitted.join(shifts, "shift").withColumn("shift_class", shift_class(F.col("shift_desc")))
    return classed.select(
        *EMPLOYEE,
        "admission",
        "shift_class",
        prorata_days(
            F.dayofmonth("admission"), F.col("shift_class"), counted, holidays_in_month(holidays, counted)
        ).alias("admission_days"),
    )


def benefit_rows(benefits: DataFrame, definitions: DataFrame, kind: Benefit) -> DataFrame:
    """Benefit rows of one kind, with the description of the benefit."""
    wanted = definitions.filter(F.col("voucher_type") == kind.voucher_type).select("benefit_code", "benefit_desc")
    rows = benefits.filter(F.col("benefit_type").isin(list(kind.benefit_types))).join(wanted, "benefit_code")
    days = F.col(kind.base_days)
    return rows.withColumns({"base_days": days, "unused_days": F.col("work_days") - days})


def benefit_people(
    emp: DataFrame,
    cost_centres: DataFrame,
    unions: DataFrame,
    shifts: DataFrame,
    departments: DataFrame,
    contracts: DataFrame,
    kind: Benefit,
) -> DataFrame:
    """Active employees with all descriptions and the contract of their branch; on the meal card also what it prints."""
    columns = ["name", "cpf", "admission", "termination", "cost_centre", "union_code", "shift", "dept"]
    card = {
        "full_name": F.col("full_name"),
        "printed_name": F.col("name"),
        "birth_date": F.date_format("birth", "dd/MM/yyyy"),
        "sex": F.col("sex"),
        "site": F.right(F.trim("dept"), F.lit(4)),
    }
    own = [c.alias(name) for name, c in card.items()] if kind.site_from_dept else []
    return (
        emp.filter("termination IS NULL")
        .select(*EMPLOYEE, *columns, *own)
        .join(cost_centres, ["branch", "cost_centre"])
        .join(unions, "union_code")
        .join(shifts, "shift")
        .join(departments.select("dept", "dept_desc").distinct(), "dept")
        .join(contracts, "branch", "left")
        .withColumn("contract", F.coalesce("contract", F.lit(codes.UNKNOWN_CONTRACT)))
    )


def with_own_dates(people: DataFrame, holidays: DataFrame, as_of: DateLike, kind: Benefit) -> DataFrame:
    """``admission_days`` and ``terminated``, which follow from the employee's own row; 0 days for those not admitted then."""
    counted = F.add_months(as_date(as_of), -1)
    days = prorata_days(
        F.dayofmonth("admission"), shift_class(F.col("shift_desc")), counted, holidays_in_month(holidays, counted)
    )
    admitted = in_month_window(F.col("admission"), as_of, *kind.admitted_months) & F.col("termination").isNull()
    left = in_month_window(F.col("termination"), as_of, *kind.terminated_months)
    return people.withColumns(
        {
            "admission_days": F.when(admitted, days).otherwise(0),
            "terminated": F.coalesce(left, F.lit(False)),
        }
    )


def enrich_people(
    people: DataFrame, absences: DataFrame, leave: DataFrame, union_rules: DataFrame, missing_limit: int | None
) -> DataFrame:
    """Employees with absence days and leave payment.

    ``absences`` and ``leave`` have one row per employee; they meet the employees here, so that the benefit rows join
    once. A paid-leave licence has no payment.
    """
    rules = union_rules.select("union_code", "maternity_120", "leave_limit_days")
    joined = (
        people.join(absences.select(*EMPLOYEE, "medical_days", "unexcused_days"), EMPLOYEE, "left")
        .join(leave.select(*EMPLOYEE, "leave_desc", "days_away"), EMPLOYEE, "left")
        .join(rules, "union_code", "left")
    )
    limit = F.col("leave_limit_days") if missing_limit is None else F.coalesce("leave_limit_days", F.lit(missing_limit))
    paid = payment_of(F.col("leave_desc"), F.col("days_away"), limit, F.col("maternity_120"))
    joined = joined.withColumn("payment", F.when(F.col("leave_desc") != codes.PAID_LEAVE, paid))
    return fill_missing(joined, numbers=["medical_days", "unexcused_days"], texts=["payment"])


def benefit_base(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Benefit rows with their employee."""
    return keyed_join(rows, people, EMPLOYEE)


def benefit_enriched(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Benefit rows with their enriched employee, and the amount for the admission days."""
    base = benefit_base(rows, people)
    return base.withColumn("admission_amount", F.col("unit_value") * F.col("admission_days"))


def corrected_days() -> Column:
    """Days to pay: base days less absences, and less vacation where the benefit is paid by ``DIAS``."""
    days = F.col("base_days") - F.col("medical_days") - F.col("unexcused_days")
    return F.when(F.col("benefit_desc").contains("DIAS"), days - F.col("vacation_days")).otherwise(days)


def meal_rule(rows: DataFrame) -> DataFrame:
    """Corrected days of a meal or food voucher."""
    return rows.withColumn("corrected_days", corrected_days())


def basket_days() -> Column:
    """A food basket is due unless the leave is unpaid."""
    return F.when(F.col("payment") == codes.NOT_PAID, 0).otherwise(1)


def basket_amount() -> Column:
    """The whole basket from 15 admission days on, else nothing."""
    return F.when(F.col("admission_days") >= 15, F.col("unit_value")).otherwise(F.lit(0))


def basket_rule(rows: DataFrame) -> DataFrame:
    """Corrected days and admission amount of a food basket."""
    return rows.withColumns({"corrected_days": basket_days(), "admission_amount": basket_amount()})


def route_payment(
    rows: DataFrame, calendar: DataFrame, meal_text: str = "TK VA", basket_text: str = "TK CESTA"
) -> DataFrame:
    """Food and basket rows under their rules, with the payment day of the cost centre (``none`` if it has none).

    One pass: a row lists the rules its benefit falls under and comes out once per rule.
    """
    kinds = F.array_compact(
        F.array(
            F.when(F.col("benefit_desc").contains(meal_text), "food"),
            F.when(F.col("benefit_desc").contains(basket_text), "basket"),
        )
    )
    is_food = F.col("rule") == "food"
    return (
        rows.withColumn("rule", F.explode(kinds))
        .join(calendar, "cost_centre", "left")
        .withColumns(
            {
                "payment_day": F.coalesce("payment_day", F.lit("none")),
                "corrected_days": F.when(is_food, corrected_days()).otherwise(basket_days()),
                "admission_amount": F.when(is_food, F.col("admission_amount")).otherwise(basket_amount()),
            }
        )
    )


def abandonment_split(rows: DataFrame, text: str = "ABANDONO") -> DataFrame:
    """Rows of cost centres named after abandonment and all others, told apart by ``part``."""
    return label_by(rows, F.col("cost_centre_desc").contains(text), "part", "abandonment", "other")
