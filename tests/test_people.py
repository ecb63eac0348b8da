from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.operators import absence, calendar, headcount, leave, registry
from rollcall.sources.erp import normalize

D = dt.date
EMP = "branch string, emp_no long, name string, admission date, termination date, status string, cost_centre string, shift string, daily_hours double"


@pytest.fixture(scope="module")
def emp(spark):
    rows = [
        ("1", 1, "whole", D(2023, 5, 1), None, "A", "A", "S", 8.0),
        ("1", 2, "joins mid", D(2024, 2, 15), None, "A", "A", "S", 8.0),
        ("1", 3, "joins last day", D(2024, 2, 29), None, "A", "A", "T", 6.0),
        ("1", 4, "leaves first day", D(2023, 1, 1), D(2024, 2, 1), "D", "A", "S", 8.0),
        ("1", 5, "leaves mid", D(2023, 1, 1), D(2024, 2, 10), "D", "A", "S", 8.0),
        ("1", 6, "leaves before joining", D(2024, 2, 20), D(2024, 2, 10), "D", "B", "S", 8.0),
        ("1", 7, "joins first day", D(2024, 2, 1), None, "A", "B", "S", 8.0),
        ("1", 8, "notice given", D(2023, 1, 1), D(2024, 2, 29), "A", "B", "S", 8.0),
    ]
    return spark.createDataFrame(rows, EMP)


def test_normalize(spark):
    rows = [("x  ", "20240101", " ", 1), ("y", "        ", "*", 2), ("z", "19000101", None, 3), ("w", "bad", "", 4)]
    df = spark.createDataFrame(rows, "t string, d string, deleted string, n int")
    out = normalize(df, dates=["d"])
    assert out.dtypes == [("t", "string"), ("d", "date"), ("n", "int")]
    assert [tuple(r) for r in out.orderBy("n").collect()] == [("x", D(2024, 1, 1), 1), ("z", None, 3), ("w", None, 4)]


def test_month_dim(spark):
    rows = calendar.month_dim(spark, "2024-01-01", 12, "next").orderBy("first_day").collect()
    assert len(rows) == 12
    assert rows[1].asDict() == {
        "month_no": 2, "month_label": "02/2024", "first_day": D(2024, 2, 1), "last_day": D(2024, 2, 29),
        "snapshot_day": D(2024, 3, 1),
    }


def test_active_days(emp):
    spine = calendar.active_day_spine(emp, "2024-02-01", 1)
    days = {r.emp_no: r.n for r in spine.groupBy("emp_no").agg(F.count("*").alias("n")).collect()}
    assert days == {1: 29, 2: 15, 3: 1, 5: 10, 7: 29, 8: 29}


def test_spine_rows_equal_span_length(emp):
    spans = calendar.active_months(emp, "2023-01-01", 24)
    want = spans.agg(F.sum(F.datediff("end_day", "start_day") + 1)).first()[0]
    assert calendar.active_day_spine(emp, "2023-01-01", 24).count() == want


def test_turnover(emp):
    rows = {(r.cost_centre, r.month_label): r for r in headcount.turnover(emp, "2024-01-01", 3).collect()}
    # Head count on the first of March: 1, 2, 3 in A, 7 in B. Employee 8 left the day before.
    feb_a, feb_b = rows["A", "02/2024"], rows["B", "02/2024"]
    assert (feb_a.headcount, feb_a.admitted, feb_a.terminated, feb_a.turnover_rate) == (3, 2, 2, 66.67)
    assert (feb_b.headcount, feb_b.admitted, feb_b.terminated, feb_b.turnover_rate) == (1, 2, 1, 150.0)
    jan_a = rows["A", "01/2024"]
    assert (jan_a.headcount, jan_a.admitted) == (3, 0)


def test_headcount_at_month_start(emp):
    rows = {(r.cost_centre, r.month): r.headcount for r in headcount.headcount(emp, "2024-02-01", 1, "start").collect()}
    assert rows == {("A", D(2024, 2, 1)): 3, ("B", D(2024, 2, 1)): 1}


def test_terminated_window(emp):
    flagged = headcount.terminated_flag(emp, "2024-02-15")
    assert sorted(r.emp_no for r in flagged.collect()) == [4, 5, 6, 8]
    assert headcount.terminated_flag(emp, "2024-01-31", 0, 0).count() == 0
    assert headcount.terminated_flag(emp, "2024-01-31", 0, 1).count() == 4


@pytest.fixture(scope="module")
def schedule(spark):
    rows = [("S", w, w, 480, 720, 780, 1020, None, None, None, None) for w in range(2, 7)]
    rows += [("S", 7, 7, 480, 720, None, None, None, None, None, None), ("S", 1, 2, 0, 99, *[None] * 6)]
    columns = ["in1", "out1", "in2", "out2", "in3", "out3", "in4", "out4"]
    return spark.createDataFrame(rows, "shift string, week int, day int, " + ", ".join(f"{c} int" for c in columns))


def events(spark, rows):
    schema = "branch string, emp_no long, date date, code string, waiver string, hours_calc double, hours_waived double"
    return spark.createDataFrame([("1", *r) for r in rows], schema)


def test_scheduled_hours(schedule):
    rows = {(r.week, r.day): r.hours for r in absence.scheduled_hours(schedule).collect()}
    assert rows[2, 2] == 8.0 and rows[7, 7] == 4.0 and rows[1, 2] == 1.65


def test_absenteeism(spark, emp, schedule):
    ev = events(
        spark,
        [
            (1, D(2024, 2, 5), "010", "", 7.30, 0.0), (1, D(2024, 2, 6), "008", "001", 0.45, 0.45),
            (1, D(2024, 2, 7), "999", "", 9.0, 0.0), (1, D(2024, 3, 1), "010", "", 9.0, 0.0),
        ],
    )
    centres = spark.createDataFrame([("1", "A", "first")], "branch string, cost_centre string, cost_centre_desc string")
    rows = {r.emp_no: r for r in absence.absenteeism(emp, ev, schedule, centres, "2024-02-01", 1).collect()}
    # February 2024: 21 weekdays of 8 hours, 4 Saturdays of 4 hours, 4 Sundays without plan that count the 8 daily hours.
    assert rows[1].ideal_hours == 21 * 8 + 4 * 4 + 4 * 8 and rows[1].absent_hours == 8.25
    assert rows[1].absenteeism_rate == 3.82 and rows[1].cost_centre_desc == "first" and rows[7].cost_centre_desc is None
    assert rows[3].ideal_hours == 6.0 and rows[3].absenteeism_rate == 0.0
    shifts = spark.createDataFrame([("S", "day")], "shift string, shift_desc string")
    split = absence.absenteeism_split(emp, ev, schedule, centres, shifts, "2024-02-01", 1, "2024-02-29")
    one = {r.emp_no: r for r in split.collect()}
    assert (one[1].absent_hours, one[1].medical_hours) == (7.5, 0.75) and 3 not in one


@pytest.fixture(scope="module")
def hours(spark):
    rows = [("day ", "8,00", "4,00", "Sab"), ("zero", None, None, None), ("unused", "5,00", None, None)]
    return absence.shift_hours_dim(
        spark.createDataFrame(rows, "shift_desc string, main_hours string, secondary_hours string, secondary_weekday string")
    )


def test_catalogue_and_absence_days(spark, emp, hours):
    shifts = spark.createDataFrame([("S", "day   "), ("T", "zero"), ("U", "missing"), ("V", "nobody")], "shift string, shift_desc string")
    more = emp.union(spark.createDataFrame([("1", 9, "u", D(2023, 1, 1), None, "A", "A", "U", 8.0)], EMP))
    catalogue = absence.shift_catalogue(more, shifts, hours)
    assert {r.shift: r.shift_missing for r in catalogue.collect()} == {"S": False, "T": False, "U": True}
    outer = absence.shift_catalogue(more, shifts, hours, "full_outer")
    assert sorted(r.shift_desc for r in outer.collect()) == ["day", "missing", "unused", "zero"]
    ev = events(
        spark,
        [
            (1, D(2024, 2, 5), "010", "", 4.00, 0.0),       # exactly half a day: counts
            (1, D(2024, 2, 6), "010", "", 3.59, 0.0),       # just below: does not
            (1, D(2024, 2, 10), "010", "", 2.00, 0.0),      # Saturday of four hours: counts
            (1, D(2024, 2, 7), "008", "001", 9.0, 2.00),    # two medical entries add up to half a day
            (1, D(2024, 2, 7), "008", "001", 9.0, 2.00),
            (1, D(2024, 2, 8), "008", "004", 9.0, 8.00),    # no medical waiver
            (1, D(2024, 1, 31), "010", "", 8.0, 0.0),       # not after the lower bound
            (3, D(2024, 2, 29), "010", "", 0.0, 0.0),       # shift without hours: counts
            (9, D(2024, 2, 5), "010", "", 0.10, 0.0),       # shift not in the sheet: counts
        ],
    )
    got = absence.absence_days(ev, absence.planned_hours(more, shifts, catalogue), "2024-01-31")
    assert {r.emp_no: (r.medical_days, r.unexcused_days) for r in got.collect()} == {1: (1, 2), 3: (0, 1), 9: (0, 1)}
    assert [r.emp_no for r in absence.medical_days(got).collect()] == [1]
    bounded = absence.absence_days(ev, absence.planned_hours(more, shifts, catalogue), "2024-01-31", "2024-02-06")
    assert {r.emp_no for r in bounded.collect()} == {1, 9}


def test_leave(spark):
    leaves = spark.createDataFrame(
        [
            ("1", 1, "A", D(2024, 1, 1), D(2024, 12, 1)), ("1", 1, "A", D(2024, 3, 1), None),   # both kinds: open first
            ("1", 2, "A", D(2024, 5, 31), None), ("1", 3, "A", D(2024, 1, 1), D(2024, 6, 1)),   # ends today: over
            ("1", 4, "001", D(2024, 1, 1), None), ("1", 5, "P", D(2024, 1, 1), None),
            ("1", 6, "M", D(2023, 1, 1), None), ("1", 7, "M", D(2024, 5, 22), None), ("1", 8, "L", D(2024, 1, 1), None),
            ("1", 9, "A", D(2024, 6, 1), None),
        ],
        "branch string, emp_no long, leave_type string, start_date date, end_date date",
    )
    types = spark.createDataFrame(
        [("A", "AUXILIO "), ("001", "x"), ("P", "CARCERE"), ("M", codes.MATERNITY_LEAVES[1]), ("L", codes.PAID_LEAVE)],
        "leave_type string, leave_desc string",
    )
    people = spark.createDataFrame(
        [("1", i, f"n{i}", {2: "B", 7: "B", 9: "Z"}.get(i, "A")) for i in range(1, 10)], "branch string, emp_no long, name string, union_code string"
    )
    unions = spark.createDataFrame([("A", "a"), ("B", "b"), ("Z", "z")], "union_code string, union_desc string")
    rules = spark.createDataFrame([("A", "SIM", 30), ("B", "NAO", 10)], "union_code string, maternity_120 string, leave_limit_days int")
    current = leave.current_leave(leaves, types, people, unions, "2024-06-01")
    assert {r.emp_no: r.start_date for r in current.collect()} == {
        1: D(2024, 3, 1), 2: D(2024, 5, 31), 5: D(2024, 1, 1), 6: D(2023, 1, 1), 7: D(2024, 5, 22), 8: D(2024, 1, 1), 9: D(2024, 6, 1),
    }
    paid = {r.emp_no: r.payment for r in leave.leave_payment(current, rules).collect()}
    assert paid == {1: "NÃO PAGA", 2: "PAGA", 5: "NÃO PAGA", 6: "PAGA", 7: "UNDEFINED", 9: "NÃO PAGA"}
    unknown = {r.emp_no: r.payment for r in leave.leave_payment(current, rules, missing_limit=None).collect()}
    assert unknown[9] == "UNDEFINED"
    latest = leave.latest_leave(leaves, types, "2024-06-01")
    assert {r.emp_no: r.start_date for r in latest.filter("emp_no IN (1, 4)").collect()} == {1: D(2024, 3, 1), 4: D(2024, 1, 1)}


def test_registry(spark, emp):
    people = emp.withColumns({"job": F.lit("J"), "union_code": F.lit("U"), "dept": F.lit("D"), "hazard_code": F.lit("1 "), "schooling_code": F.lit("99")})
    frames = [
        spark.createDataFrame([("J", "job")], "job string, job_desc string"),
        spark.createDataFrame([("1", "A", "North SEGMENT")], "branch string, cost_centre string, cost_centre_desc string"),
        spark.createDataFrame([("U", "u")], "union_code string, union_desc string"),
        spark.createDataFrame([("S", "s")], "shift string, shift_desc string"),
        spark.createDataFrame([("D", "X", "d"), ("D", "Y", "d")], "dept string, cost_centre string, dept_desc string"),
    ]
    everyone = registry.employee_registry(people, *frames, active_only=False)
    assert sorted(r.emp_no for r in everyone.collect()) == [1, 2, 4, 5]
    row = registry.admitted_between(registry.employee_registry(people, *frames), "2024-02-01", "2024-02-29").first()
    assert (row.emp_no, row.hazard, row.schooling) == (2, "Não", "Não") and "hazard_code" not in row.asDict()
    assert registry.segment(everyone, "SEGMENT").count() == 4 and registry.segment(everyone, "none").count() == 0
