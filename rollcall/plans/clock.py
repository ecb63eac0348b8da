"""Queries on clock events, punches, timesheets and punch import."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import leave, timeclock
from rollcall.operators.relational import all_duplicates, assign_recno, expanded, max_or
from rollcall.plans import roles
from rollcall.plans.report import report
from rollcall.sinks import loads
from rollcall.sources.files import parse_clockings
from rollcall.streaming.folders import run_folder
from rollcall.streaming.jobs import pending_days
from rollcall.streaming.jobs import stream_clockings as clocking_stream
from rollcall.streaming.jobs import stream_pending_by_day as pending_stream

AS_OF = str(dt.date.fromisoformat(roles.AS_OF) + dt.timedelta(days=roles.TIME_SHIFT))
LEDGER = ["branch", "emp_no", "name", "job_desc", "cost_centre_desc", "status", "shift_desc", "date", "code",
          "event_desc", "waiver", "hours_calc", "hours_waived", "net_hours", "dept_desc"]


def staff(spark: SparkSession, folder: str) -> DataFrame:
    return roles.employees(spark, folder).join(roles.shifts(spark), "shift")


def ledger_tables(spark: SparkSession, folder: str, first: str | None = None, end: str | None = None) -> list[DataFrame]:
    return [
        roles.clock_events(spark, folder, first, end),
        roles.employees(spark, folder),
        roles.event_codes(spark),
        roles.cost_centres(spark, folder),
        roles.shifts(spark),
        roles.departments(spark, folder),
        roles.jobs(spark),
    ]


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.event_ledger(*ledger_tables(spark, folder))


def event_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return report(ledger(spark, folder), *LEDGER)


def event_report(spark: SparkSession, folder: str) -> DataFrame:
    return report(timeclock.event_report(*ledger_tables(spark, folder), "DEPARTMENT 3"), *LEDGER)


def event_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return report(timeclock.pivot_events(ledger(spark, folder)))


def punches(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.parse_afd(roles.afd_lines(spark, folder))


def matched(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.match_punches(punches(spark, folder), staff(spark, folder))


def worked(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.with_work_date(matched(spark, folder), roles.shift_start(spark))


def afd_parse(spark: SparkSession, folder: str) -> DataFrame:
    return report(punches(spark, folder).fillna(-1, subset=["minute", "pis"]))


def duplicate_punches(spark: SparkSession, folder: str) -> DataFrame:
    return report(all_duplicates(punches(spark, folder).filter("date IS NOT NULL"), timeclock.PUNCH_KEY))


def matched_punches(spark: SparkSession, folder: str) -> DataFrame:
    rows = matched(spark, folder).fillna(-1, subset=["emp_no", "minute"])
    return report(rows, "value", "pis", "date", "minute", "branch", "emp_no", "cost_centre", "shift_desc")


def unmatched_punches(spark: SparkSession, folder: str) -> DataFrame:
    return report(timeclock.unmatched_pis(punches(spark, folder), staff(spark, folder)))


def work_date_shift(spark: SparkSession, folder: str) -> DataFrame:
    rows = worked(spark, folder).filter("emp_no IS NOT NULL").fillna(-1, subset=["start_second"])
    return report(rows, "value", "branch", "emp_no", "date", "minute", "start_second", "work_date")


def reconciled(spark: SparkSession, folder: str) -> DataFrame:
    device = matched(spark, folder).filter("date IS NOT NULL")
    return timeclock.reconcile(device, timeclock.erp_punches(roles.erp_punch_rows(spark, folder)))


def punch_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return report(reconciled(spark, folder))


def punches_missing_in_erp(spark: SparkSession, folder: str) -> DataFrame:
    return report(reconciled(spark, folder).filter("NOT in_erp").drop("in_erp"))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.daily_punches(worked(spark, folder))


def daily_punch_list(spark: SparkSession, folder: str) -> DataFrame:
    return report(daily(spark, folder))


def punch_parity(spark: SparkSession, folder: str) -> DataFrame:
    return report(timeclock.with_parity(daily(spark, folder)).drop("punches"))


def grid(spark: SparkSession, folder: str) -> DataFrame:
    leaves = roles.shifted(roles.leaves(spark, folder), "start_date", "end_date")
    latest = leave.latest_leave(leaves, roles.leave_types(spark), AS_OF)
    people = staff(spark, folder).select("branch", "emp_no", "name", "cost_centre", "shift_desc")
    return timeclock.attendance_grid(
        people, daily(spark, folder), latest, roles.managers(spark, folder), roles.PUNCH_FIRST, roles.PUNCH_LAST
    )


def attendance_grid(spark: SparkSession, folder: str) -> DataFrame:
    return report(grid(spark, folder))


def timesheet(spark: SparkSession, folder: str) -> DataFrame:
    month = timeclock.event_ledger(*ledger_tables(spark, folder, roles.SHEET_FIRST, roles.SHEET_END))
    events = roles.shifted(timeclock.pivot_events(month), "date")
    rows = timeclock.timesheet(grid(spark, folder), events)
    names = ["overtime_events", "absence_events", "other_events"]
    return report(rows, "branch", "emp_no", "day", "manager", "weekday", "punches", *names)


def imports(spark: SparkSession, folder: str, keep_date: bool = False) -> DataFrame:
    delivered = parse_clockings(roles.clockings(roles.punches(spark, folder)))
    return timeclock.import_rows(delivered, keep_date)


def import_rows(spark: SparkSession, folder: str) -> DataFrame:
    return report(imports(spark, folder))


def import_rows_keep_date(spark: SparkSession, folder: str) -> DataFrame:
    return report(imports(spark, folder, keep_date=True), "id", "date", "seconds")


def pending(spark: SparkSession, folder: str) -> DataFrame:
    return timeclock.pending_punches(
        imports(spark, folder), roles.employees(spark, folder), roles.loaded_punches(spark, folder)
    )


def pending_punches(spark: SparkSession, folder: str) -> DataFrame:
    return report(pending(spark, folder))


def pending_punches_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return report(timeclock.pending_by_day(pending(spark, folder)))


def surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = pending(spark, folder).select("id", "date", F.col("id").cast("long").alias("number"))
    start = max_or(roles.loaded_punches(spark, folder), "recno", 0)
    return report(assign_recno(rows, start, "number", within=["date"]), "id", "date", "recno")


def event_list_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of the pivot, entry by entry."""
    lists = timeclock.event_lists(ledger(spark, folder))
    cells = [F.struct(F.lit(c).alias("list"), expanded(F.col(c)).alias("entries")) for c in timeclock.EVENT_COLUMNS.values()]
    cells = lists.select("branch", "emp_no", "date", F.inline(F.array(*cells)))
    return report(cells.select("branch", "emp_no", "date", "list", F.posexplode("entries").alias("position", "event")))


def daily_punch_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The punches of each day, entry by entry."""
    lists = timeclock.punch_lists(worked(spark, folder))
    return report(lists.select("branch", "emp_no", "work_date", F.posexplode(expanded(F.col("punches"))).alias("position", "time")))


def stream_clockings(spark: SparkSession, folder: str) -> DataFrame:
    """Five deliveries, a batch for each of their files: on time, repeated while the state remembers, repeated later, late, late again."""
    out = run_folder(spark, "clockings")
    arriving = parse_clockings(roles.deliver_punches(spark, folder, f"{out}/deliveries"))
    clocking_stream(arriving, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint").awaitTermination()
    schema = "id string, pis string, nsr string, date string, seconds int"
    return report(spark.read.schema(schema).parquet(f"{out}/table"), "id", "pis", "nsr", "date", "seconds")


def punch_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, the second with the first ten days again, each tried twice: what was loaded, and what was not and why."""
    out, rows = run_folder(spark, "punches"), imports(spark, folder)
    emp = roles.employees(spark, folder)
    early = F.coalesce(F.col("date") <= "20240110", F.lit(True))
    for part, name in ((rows.filter(early), "first"), (rows, "all")):
        for _ in range(2):
            timeclock.load_punches(part, emp, out, name)
    schema = T.StructType([*rows.schema.fields, T.StructField("active", T.BooleanType())])
    return report(loads.rows(spark, out, schema).groupBy("load", "date", "reason").agg(F.sum("copies").alias("punches"), F.count("id").alias("rows")))


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Punches of the deliveries whose date could not be read, each once."""
    out = run_folder(spark, "clockings")
    arriving = parse_clockings(roles.deliver_punches(spark, folder, f"{out}/deliveries"))
    clocking_stream(arriving, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint").awaitTermination()
    return report(spark.read.schema("id string, pis string, nsr string").parquet(f"{out}/rejects"), "id", "pis", "nsr")


def stream_pending_by_day(spark: SparkSession, folder: str) -> DataFrame:
    out = run_folder(spark, "by-day")
    arriving = parse_clockings(roles.deliver_punches(spark, folder, f"{out}/deliveries"))
    emp, loaded = roles.employees(spark, folder), roles.loaded_punches(spark, folder)
    pending_stream(arriving, emp, loaded, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return report(pending_days(spark, f"{out}/table"))
