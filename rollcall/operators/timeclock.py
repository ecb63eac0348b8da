"""Clock events, device punches and timesheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.functions.dates import DateLike, clock_minutes, clock_seconds, minutes_text, punch_timestamp, weekday_label
from rollcall.functions.hours import hhmm_minutes
from rollcall.functions.text import drop_decimal_suffix, keep_last
from rollcall.operators.calendar import day_grid
from rollcall.operators.relational import anti_load, keep_first, keyed_join, known, list_text, pivot_lists, value_lists
from rollcall.sinks.loads import load

EMPLOYEE = ["branch", "emp_no"]
AFD_LENGTH = 34
PUNCH_KEY = ["date", "minute", "pis"]


# ---- clock events of the ERP ---------------------------------------------------------------------


def event_ledger(
    events: DataFrame,
    emp: DataFrame,
    event_codes: DataFrame,
    cost_centres: DataFrame,
    shifts: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
) -> DataFrame:
    """Unprocessed events with hours left after the waived ones, and the descriptions around them."""
    open_events = events.filter((F.col("hours_calc") - F.col("hours_waived") > 0) & (F.col("processed") == ""))
    people = (
        emp.select(*EMPLOYEE, "name", "status", "job", "cost_centre", "shift", "dept")
        .join(cost_centres, ["branch", "cost_centre"])
        .join(shifts, "shift")
        .join(departments.select("dept", "dept_desc").distinct(), "dept")
        .join(jobs, "job")
    )
    ledger = keyed_join(open_events.join(event_codes, "code"), people, EMPLOYEE)
    return ledger.withColumn("net_hours", F.col("hours_calc") - F.col("hours_waived"))


def event_report(
    events: DataFrame,
    emp: DataFrame,
    event_codes: DataFrame,
    cost_centres: DataFrame,
    shifts: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    department: str,
    excluded: Sequence[str] = tuple(codes.REPORT_EXCLUDED_CODES),
) -> DataFrame:
    """Ledger rows of one department, without the codes that are no overtime or absence.

    Both restrictions apply before the join.
    """
    wanted = events.filter(~F.col("code").isin(list(excluded)))
    one = departments.filter(F.col("dept_desc") == department)
    return event_ledger(wanted, emp, event_codes, cost_centres, shifts, one, jobs)


def event_class(description: Column) -> Column:
    """Overtime, absence or neither. An event on both lists is an absence."""
    name = F.trim(description)
    return (
        F.when(name.isin(codes.ABSENCE_EVENTS), codes.ABSENCE)
        .when(name.isin(codes.OVERTIME_EVENTS), codes.OVERTIME)
        .otherwise(codes.NO_CLASS)
    )


# Column of the pivot for each class.
EVENT_COLUMNS = {codes.OVERTIME: "overtime_events", codes.ABSENCE: "absence_events", codes.NO_CLASS: "other_events"}


def event_lists(ledger: DataFrame) -> DataFrame:
    """One row per employee and day, the event names of each class as a list of runs, empty where there is none."""
    name = F.lit(None)
    for klass, column in EVENT_COLUMNS.items():
        name = F.when(event_class(F.col("event_desc")) == klass, column).otherwise(name)
    return pivot_lists(ledger.withColumn("_column", name), [*EMPLOYEE, "date"], "_column", list(EVENT_COLUMNS.values()), "event_desc")


def pivot_events(ledger: DataFrame) -> DataFrame:
    """One row per employee and day, the event names of each class as one text."""
    return event_lists(ledger).withColumns({c: list_text(F.col(c)) for c in EVENT_COLUMNS.values()})


# ---- device punches -------------------------------------------------------------------------------


def parse_afd(lines: DataFrame) -> DataFrame:
    """Punches of AFD text: records of 34 characters with date, time and PIS at fixed places.

    Records of another length are left out; an invalid date or time is NULL.
    """
    value = F.col("value")
    return lines.filter(F.length(value) == AFD_LENGTH).select(
        *[c for c in lines.columns if c != "value"],
        "value",
        F.try_to_date(F.substring(value, 11, 8), "ddMMyyyy").alias("date"),
        clock_minutes(F.substring(value, 19, 4)).alias("minute"),
        F.substring(value, 23, 12).try_cast("bigint").alias("pis"),
    )


def employees_by_pis(emp: DataFrame) -> DataFrame:
    """One active employee per PIS: the lowest branch and number."""
    active = emp.filter((F.col("status") != "D") & F.col("pis").isNotNull())
    columns = ["pis", *EMPLOYEE, "name", "cost_centre", "shift", "shift_desc"]
    return keep_first(active.select(*[c for c in columns if c in emp.columns]), ["pis"], EMPLOYEE)


def match_punches(punches: DataFrame, emp: DataFrame) -> DataFrame:
    """Punches with the employee of their PIS; an unknown PIS leaves the employee NULL."""
    return keyed_join(punches, employees_by_pis(emp), ["pis"], "left")


def unmatched_pis(punches: DataFrame, emp: DataFrame) -> DataFrame:
    """Each PIS of the punches that belongs to no active employee."""
    return anti_load(punches.select("pis").distinct(), employees_by_pis(emp), ["pis"])


def work_date(date: Column, minute: Column, shift_start: Column) -> Column:
    """Day a punch belongs to: on shifts that start after 13:20:00, a punch after 00:00 and before 10:00 ends the day before.

    The shift start counts in seconds of the day, the punch in minutes.
    """
    night = (shift_start > (13 * 60 + 20) * 60) & (minute > 0) & (minute < 10 * 60)
    return F.when(night, F.date_sub(date, 1)).otherwise(date)


def shift_starts(raw: DataFrame) -> DataFrame:
    """Shift-start sheet (``HH:mm:ss`` text) as seconds of the day; rows that repeat are dropped."""
    return raw.select("shift_desc", clock_seconds(F.col("start")).alias("start_second")).distinct()


def with_work_date(matched: DataFrame, starts: DataFrame) -> DataFrame:
    joined = matched.join(starts, "shift_desc", "left")
    return joined.withColumn("work_date", work_date(F.col("date"), F.col("minute"), F.col("start_second")))


def erp_punches(raw: DataFrame) -> DataFrame:
    """Punches known to the ERP, one row per employee, date and minute. The ERP writes the time as HH.MM."""
    return raw.select(*EMPLOYEE, "date", hhmm_minutes(F.col("hhmm")).cast("int").alias("minute")).distinct()


def reconcile(matched: DataFrame, erp: DataFrame) -> DataFrame:
    """Device punches against the ERP, one row per employee, date and minute with the number of device punches."""
    device = (
        matched.filter("emp_no IS NOT NULL").groupBy(*EMPLOYEE, "date", "minute").agg(F.count(F.lit(1)).alias("punches"))
    )
    flagged = erp.withColumn("in_erp", F.lit(True))
    joined = device.join(flagged, [*EMPLOYEE, "date", "minute"], "left")
    return joined.withColumn("in_erp", F.coalesce("in_erp", F.lit(False)))


def punch_lists(worked: DataFrame) -> DataFrame:
    """Punches of an employee and work date in time order, as a list of runs."""
    timed = worked.filter("emp_no IS NOT NULL AND work_date IS NOT NULL").withColumn(
        "time", minutes_text(F.col("minute"))
    )
    return value_lists(timed, [*EMPLOYEE, "work_date"], "time", "punches", order="minute")


def daily_punches(worked: DataFrame) -> DataFrame:
    """Punches of an employee and work date in time order, as one text."""
    return punch_lists(worked).withColumn("punches", list_text(F.col("punches")))


def with_parity(daily: DataFrame) -> DataFrame:
    """Marks days with an odd number of punches."""
    return daily.withColumn("inconsistent", F.col("punches_count") % 2 != 0)


def attendance_grid(
    emp: DataFrame,
    daily: DataFrame,
    leave: DataFrame,
    managers: DataFrame,
    first: DateLike,
    last: DateLike,
) -> DataFrame:
    """Every employee on every day of a period, with punches or a remark that there are none, leave and manager.

    Employees of a cost centre without manager are left out. What does not depend on the day joins before the days unfold.
    """
    people = (
        emp.join(managers.filter("manager IS NOT NULL"), "cost_centre")
        .join(leave.select(*EMPLOYEE, "leave_desc", "start_date", "end_date"), EMPLOYEE, "left")
    )
    grid = day_grid(people, first, last)
    joined = grid.join(daily.withColumnRenamed("work_date", "day"), [*EMPLOYEE, "day"], "left")
    return joined.withColumns(
        {
            "punches": F.coalesce("punches", F.lit(codes.NO_PUNCH)),
            "punches_count": F.coalesce("punches_count", F.lit(0)),
            "weekday": weekday_label(F.col("day"), codes.TIMESHEET_WEEKDAYS),
            "leave_desc": F.coalesce("leave_desc", F.lit("")),
        }
    )


def timesheet(grid: DataFrame, events: DataFrame) -> DataFrame:
    """The attendance grid with the events of each day.

    Event days outside the grid have no cost centre and would be dropped again, so this is a left join.
    """
    joined = grid.join(events.withColumnRenamed("date", "day"), [*EMPLOYEE, "day"], "left")
    return joined.fillna("", subset=["overtime_events", "absence_events", "other_events"])


# ---- punch import ---------------------------------------------------------------------------------

CLOCKING_FIELDS = ["id", "personPIS", "clockingCollectorName", "clockingDate", "timezone"]


def import_rows(clockings: DataFrame, keep_date: bool = False) -> DataFrame:
    """ERP import rows of device punches.

    Local time is device time plus the zone's offset; the date moves with it unless ``keep_date``. Seconds are cut.
    """
    device = punch_timestamp(F.col("clockingDate"))
    offset = codes.zone_offset(F.col("timezone"))
    local_hour = F.hour(device) + offset
    day = F.to_date(device)
    moved = day if keep_date else F.date_add(day, F.floor(local_hour / 24).cast("int"))
    seconds = F.pmod(local_hour, F.lit(24)) * 3600 + F.minute(device) * 60
    return clockings.select(
        "id",
        F.trim("personPIS").alias("pis"),
        F.col("clockingCollectorName").alias("collector"),
        F.col("clockingCollectorName").alias("rep"),
        keep_last(F.col("id"), 9).alias("nsr"),
        F.date_format(moved, "yyyyMMdd").alias("date"),
        seconds.cast("int").alias("seconds"),
        F.lit(codes.PUNCH_UNIT).alias("unit"),
        F.lit("0").alias("ip"),
        F.lit("0").alias("geofence"),
        F.lit(codes.PUNCH_COST_CENTRE).alias("cc_rep"),
        F.lit(codes.PUNCH_LAYOUT).alias("layout"),
    )


def active_pis(emp: DataFrame) -> DataFrame:
    """PIS of the active employees as text."""
    return emp.filter(F.col("status") != "D").select(F.trim(F.col("pis").cast("string")).alias("pis"))


def loaded_ids(loaded: DataFrame) -> DataFrame:
    """Ids of the punches loaded before, without the ending a float column leaves."""
    return loaded.select(drop_decimal_suffix(F.col("id").cast("string")).alias("id"))


def pending_punches(rows: DataFrame, emp: DataFrame, loaded: DataFrame) -> DataFrame:
    """Import rows of active employees that are not loaded yet, one per punch id. Rows without a date cannot be loaded."""
    dated = rows.filter(F.col("date").isNotNull())
    once = keep_first(known(dated, active_pis(emp), ["pis"]), ["id"], ["date", "seconds"])
    return anti_load(once, loaded_ids(loaded), ["id"])


#: Why a punch is not loaded, in the order of the checks; ``sinks.loads`` adds ids that were loaded before or come twice.
NO_DATE, UNKNOWN_EMPLOYEE = "no readable date", "no active employee"


def load_punches(rows: DataFrame, emp: DataFrame, path: str, load_id: str) -> bool:
    """Load import rows into the table at ``path`` under the id of their delivery: those of active employees with a date, each id once.
    The others are kept with their reason. False where that delivery was loaded before."""
    flagged = rows.join(active_pis(emp).distinct().withColumn("_active", F.lit(True)), "pis", "left")
    flagged = flagged.select(*rows.columns, F.coalesce("_active", F.lit(False)).alias("active"))
    rules = {NO_DATE: F.col("date").isNotNull(), UNKNOWN_EMPLOYEE: F.col("active")}
    return load(flagged, path, load_id, rules, ["id"])


def pending_by_day(pending: DataFrame) -> DataFrame:
    """Number of pending punches per day."""
    return pending.groupBy("date").agg(F.count(F.lit(1)).alias("punches"))
