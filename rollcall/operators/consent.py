"""Consent registry: one consent per CPF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.relational import anti_load, keep_first

COLUMNS = [
    "emp_no", "name", "admission", "cost_centre", "cost_centre_desc", "dept", "dept_desc", "photo", "accepted", "cpf",
]


def find_employee(emp: DataFrame, cpf: str, branch: str) -> DataFrame:
    """Employees with a CPF in a branch."""
    return emp.filter((F.col("cpf") == cpf) & (F.col("branch") == branch))


def complete_requests(requests: DataFrame) -> DataFrame:
    """Requests with consent given, a CPF and a photo."""
    has_cpf = F.coalesce(F.trim("cpf"), F.lit("")) != ""
    return requests.filter(F.col("accepted") & has_cpf & F.col("photo").isNotNull())


def register_consents(requests: DataFrame, emp: DataFrame, consents: DataFrame) -> DataFrame:
    """Consents to add: complete requests of known employees whose CPF has no consent yet, the earliest per CPF.

    Requests carry ``requested`` for their order. Whether an employee is known is settled before the earliest request is
    chosen, and requests shrink to one per CPF and branch before they meet the employees.
    """
    first = keep_first(complete_requests(requests), ["cpf", "branch"], ["requested"])
    person = keep_first(
        emp.select("branch", "emp_no", "name", "admission", "cost_centre", "cost_centre_desc", "dept", "dept_desc", "cpf"),
        ["cpf", "branch"],
        ["emp_no"],
    )
    matched = first.join(person, ["cpf", "branch"])
    return anti_load(keep_first(matched, ["cpf"], ["requested", "branch"]), consents, ["cpf"]).select(*COLUMNS)


def rejected_requests(requests: DataFrame, emp: DataFrame, consents: DataFrame) -> DataFrame:
    """Requests that are not registered, counted per CPF, branch and reason."""
    reason = (
        F.when(~F.coalesce("accepted", F.lit(False)), "not accepted")
        .when(F.coalesce(F.trim("cpf"), F.lit("")) == "", "no CPF")
        .when(F.col("photo").isNull(), "no photo")
    )
    counted = (
        requests.withColumn("reason", F.coalesce(reason, F.lit("")))
        .groupBy("cpf", "branch", "reason")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    people = emp.select("cpf", "branch").distinct().withColumn("is_known", F.lit(True))
    done = consents.select("cpf").distinct().withColumn("has_consent", F.lit(True))
    later = (
        F.when(F.col("reason") != "", F.col("reason"))
        .when(F.col("is_known").isNull(), "unknown employee")
        .when(F.col("has_consent").isNotNull(), "already registered")
    )
    return (
        counted.join(people, ["cpf", "branch"], "left")
        .join(done, "cpf", "left")
        .withColumn("reason", later)
        .filter("reason IS NOT NULL")
        .select("cpf", "branch", "reason", "requests")
    )
