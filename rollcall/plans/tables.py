"""Queries that write with each sink or source format and read back what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.dates import pay_cycle as cycle_bounds
from rollcall.operators import absence, consent
from rollcall.operators.relational import assign_recno, first_rows, max_or
from rollcall.plans import clock, people, roles, vouchers
from rollcall.plans.report import report
from rollcall.sinks import loads, tables, versions
from rollcall.sources.erp import target_columns as columns_of
from rollcall.sources.files import read_dim, read_receipt_pages
from rollcall.streaming.folders import run_folder

ORDER = ["o_orderkey", "o_custkey", "o_totalprice"]


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return roles.table(spark, folder, "orders").select(*ORDER, "o_orderstatus")


def append_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that are open, then all others, added to one table."""
    out, rows = run_folder(spark, "append"), orders(spark, folder)
    tables.append(rows.filter("o_orderstatus = 'O'"), out, ["o_orderstatus"])
    tables.append(rows.filter("o_orderstatus <> 'O'"), out, ["o_orderstatus"])
    return report(spark.read.parquet(out), *ORDER, "o_orderstatus")


def refresh_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A table of all orders replaced by the open ones."""
    out, rows = run_folder(spark, "refresh"), orders(spark, folder)
    tables.refresh(rows, out)
    tables.refresh(rows.filter("o_orderstatus = 'O'"), out)
    return report(spark.read.parquet(out), *ORDER)


def publish_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A table of all orders refreshed twice: from itself, without the finished ones, and from itself again, by status."""
    out = run_folder(spark, "published")
    versions.publish(orders(spark, folder), out)
    versions.publish(versions.published(spark, out).filter("o_orderstatus <> 'F'"), out)
    versions.publish(versions.published(spark, out).filter("o_orderkey % 2 = 1"), out, ["o_orderstatus"])
    return report(versions.published(spark, out), *ORDER, "o_orderstatus")


def load_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded by year of their date, each year twice, the last with all years before it; rejected ones with their reason."""
    out = run_folder(spark, "loaded")
    rows = roles.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    rows = rows.withColumn("o_custkey", F.when(F.col("o_orderkey") % 40 != 1, F.col("o_custkey")))
    rules = {"round key": F.col("o_orderkey") % 10 != 0, "too cheap": F.col("o_totalprice") >= 20_000, "no customer": F.col("o_custkey").isNotNull()}
    first = rows.filter("year < 1995")
    loads.load(first, out, "until-1994", rules, ["o_orderkey"])
    loads.load(first, out, "until-1994", rules, ["o_orderkey"])
    # Rows that came before, and those of 1997 twice.
    again = rows.filter("year <> 1993").unionByName(rows.filter("year = 1997"))
    loads.load(again, out, "until-1998", rules, ["o_orderkey"])
    return report(loads.rows(spark, out, rows.schema), "o_orderkey", "year", "reason", "copies", "load")


def append_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a round key are rejected; accepted and rejected rows side by side."""
    out = run_folder(spark, "checked")
    tables.append_with_rejects(orders(spark, folder).drop("o_orderstatus"), F.col("o_orderkey") % 10 != 0, out)
    good, bad = tables.accepted(spark, out), tables.rejected(spark, out)
    return report(good.withColumn("part", F.lit("good")).union(bad.withColumn("part", F.lit("bad"))))


def export_report(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "report")
    tables.export(people.turnover_monthly(spark, folder), out)
    return report(spark.read.option("header", "true").csv(out), "cost_centre", "month_label", "headcount")


def split_back(spark: SparkSession, rows: DataFrame, column: str, name: str) -> DataFrame:
    out = run_folder(spark, name)
    tables.export_by(rows, column, out)
    kind = ", ".join(f"`{c}` string" for c in [*(c for c in rows.columns if c != column), column])
    return report(spark.read.schema(kind).option("header", "true").csv(out))


def export_by_payment_day(spark: SparkSession, folder: str) -> DataFrame:
    rows = vouchers.payment_routing(spark, folder).select("branch", "emp_no", "benefit_row", "rule", "payment_day")
    return split_back(spark, rows, "payment_day", "payment-day")


def export_by_manager(spark: SparkSession, folder: str) -> DataFrame:
    rows = clock.attendance_grid(spark, folder).select("branch", "emp_no", "day", "weekday", "manager")
    return split_back(spark, rows, "manager", "manager")


def export_duplicate_punches(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "duplicates")
    tables.export_duplicates(clock.punches(spark, folder).filter("date IS NOT NULL"), clock.timeclock.PUNCH_KEY, out)
    back = spark.read.option("header", "true").csv(out)
    return report(back.selectExpr("tenant", "value", "date", "CAST(minute AS int) AS minute", "CAST(pis AS long) AS pis"))


def export_shift_gaps(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "gaps")
    tables.export_gaps(people.catalogue(spark, folder), out)
    return report(spark.read.option("header", "true").csv(out), "shift", "shift_desc")


def dimension_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The payment calendar exported as a sheet with headings of its own, and read by them."""
    out = run_folder(spark, "sheet")
    sheet = roles.payment_calendar(spark, folder).selectExpr("payment_day AS `Dia`", "'x' AS `Obs`", "concat(' ', cost_centre) AS `Cod CC`")
    tables.export(sheet, out)
    return report(read_dim(spark, out, {"Cod CC": "cost_centre", "Dia": "payment_day", "Nome": "name"}))


def receipt_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Receipt pages landed as a table; those without text are left out."""
    out = run_folder(spark, "pages")
    text = F.when(F.col("page") % 11 != 0, F.col("text")).otherwise("")
    landed = roles.receipt_texts(spark, folder).select("doc", F.col("page").cast("int").alias("page"), text.alias("text"))
    tables.refresh(landed, out)
    return report(read_receipt_pages(spark, out).select("doc", F.col("page").cast("long").alias("page"), F.length("text").alias("chars")))


def target_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the columns of a table written from the employees, with the number of rows that have a value."""
    name = "employees_target"
    roles.employees(spark, folder).select("branch", "emp_no", "termination").createOrReplaceTempView(name)
    counts = [F.count(c).alias(c) for c in columns_of(spark, name)]
    return report(spark.table(name).agg(*counts))


def pay_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """The pay cycle as of each day that has an order."""
    days = roles.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    first, last = cycle_bounds(F.col("as_of"))
    return report(days.select("as_of", first.alias("first_day"), last.alias("last_day")))


def employee_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The employee of a CPF and branch."""
    return report(consent.find_employee(roles.employees(spark, folder), "185", "01"), "branch", "emp_no", "name", "cpf")


def first_punches(spark: SparkSession, folder: str) -> DataFrame:
    """Preview of the punches: the first ten by id."""
    return report(first_rows(roles.punches(spark, folder).select("id", "pis", "device"), ["id"], 10))


def planned_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Planned minutes per weekday where the day number alone names the weekday."""
    return report(absence.weekday_minutes(roles.schedule(spark, folder), ["day"]).fillna(0))


def numbered_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts numbered by type and brand, which are text and repeat."""
    rows = roles.table(spark, folder, "part").select("p_type", "p_brand", "p_partkey")
    start = max_or(roles.table(spark, folder, "supplier"), "s_suppkey", 0)
    return report(assign_recno(rows, start, "p_brand", within=["p_type"]), "p_partkey", "recno")


def numbered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders numbered by a key with wide gaps."""
    rows = roles.table(spark, folder, "orders").selectExpr("o_orderkey * 1000003 AS number", "o_orderkey")
    return report(assign_recno(rows, max_or(spark.range(0), "id", 0), "number"), "o_orderkey", "recno")


QUERIES = (
    numbered_parts, numbered_orders,
    append_orders, refresh_orders, publish_orders, load_orders, append_rejects, export_report, export_by_payment_day, export_by_manager,
    export_duplicate_punches, export_shift_gaps, dimension_sheet, receipt_pages, target_columns, pay_cycle, employee_lookup,
    first_punches, planned_by_day,
)
