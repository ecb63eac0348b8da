"""Queries on meal and food benefits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import absence, benefits, leave
from rollcall.operators.benefits import Benefit
from rollcall.plans import roles
from rollcall.plans.report import report

BASE = [
    "branch", "emp_no", "benefit_row", "benefit_desc", "name", "cost_centre", "cost_centre_desc", "union_desc",
    "shift_desc", "dept_desc", "contract", "base_days", "unused_days", "unit_value", "vacation_days",
]
ENRICHED = ["branch", "emp_no", "benefit_row", "medical_days", "unexcused_days", "admission_days", "admission_amount",
            "terminated", "payment"]


def rows_of(spark: SparkSession, folder: str, kind: Benefit) -> DataFrame:
    return benefits.benefit_rows(roles.benefits(spark, folder), roles.benefit_definitions(spark), kind)


def people_of(spark: SparkSession, folder: str, kind: Benefit) -> DataFrame:
    emp = roles.card_holders if kind.site_from_dept else roles.employees
    return benefits.benefit_people(
        emp(spark, folder),
        roles.cost_centres(spark, folder),
        roles.unions(spark),
        roles.shifts(spark),
        roles.departments(spark, folder),
        roles.contracts(spark),
        kind,
    )


def base(spark: SparkSession, folder: str, kind: Benefit) -> DataFrame:
    return benefits.benefit_base(rows_of(spark, folder, kind), people_of(spark, folder, kind))


def prorata(spark: SparkSession, folder: str, months: tuple[int, int] = (0, 0)) -> DataFrame:
    return benefits.admission_prorata(
        roles.employees(spark, folder), roles.shifts(spark), roles.holidays(spark), roles.AS_OF, months=months
    )


def enriched(spark: SparkSession, folder: str, kind: Benefit) -> DataFrame:
    staff = benefits.with_own_dates(people_of(spark, folder, kind), roles.holidays(spark), roles.AS_OF, kind)
    planned = staff.join(roles.shift_hours(spark), "shift_desc", "left")
    events = roles.clock_events(spark, folder, roles.CYCLE_START)
    staff = benefits.enrich_people(
        staff,
        absence.absence_days(events, planned, roles.CYCLE_START),
        leave.first_leave(roles.leaves(spark, folder), roles.leave_types(spark), roles.AS_OF),
        roles.union_rules(spark),
        kind.missing_limit,
    )
    return benefits.benefit_enriched(rows_of(spark, folder, kind), staff)


def shift_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = roles.employees(spark, folder).join(roles.shifts(spark), "shift")
    classed = rows.withColumn("shift_class", benefits.shift_class(F.col("shift_desc")))
    return report(classed.groupBy("shift_desc", "shift_class").agg(F.count(F.lit(1)).alias("employees")))


def admission_prorata(spark: SparkSession, folder: str) -> DataFrame:
    return report(prorata(spark, folder, (-1, 0)))


def benefit_base_food(spark: SparkSession, folder: str) -> DataFrame:
    return report(base(spark, folder, benefits.FOOD), *BASE)


def benefit_base_meal_ticket(spark: SparkSession, folder: str) -> DataFrame:
    return report(base(spark, folder, benefits.MEAL_TICKET), *BASE)


def benefit_base_meal_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return report(base(spark, folder, benefits.MEAL_TICKET_SHEET), *BASE)


def benefit_base_meal_card(spark: SparkSession, folder: str) -> DataFrame:
    return report(base(spark, folder, benefits.MEAL_CARD), *BASE, "site", "full_name", "printed_name", "birth_date", "sex")


def benefit_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return report(enriched(spark, folder, benefits.FOOD_SHEET), *ENRICHED)


def corrected_days(spark: SparkSession, folder: str) -> DataFrame:
    rows = benefits.meal_rule(enriched(spark, folder, benefits.MEAL_TICKET_SHEET))
    return report(rows, *ENRICHED, "base_days", "corrected_days")


def basket_rule(spark: SparkSession, folder: str) -> DataFrame:
    rows = enriched(spark, folder, benefits.FOOD).filter(F.col("benefit_desc").contains("TK CESTA"))
    return report(benefits.basket_rule(rows), *ENRICHED, "corrected_days")


def payment_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = benefits.route_payment(enriched(spark, folder, benefits.FOOD), roles.payment_calendar(spark, folder))
    return report(rows, *ENRICHED, "rule", "payment_day", "corrected_days")


def abandonment_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = benefits.abandonment_split(base(spark, folder, benefits.MEAL_TICKET_SHEET))
    return report(rows, "branch", "emp_no", "benefit_row", "part")
