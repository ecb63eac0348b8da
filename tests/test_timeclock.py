from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.functions import codes
from rollcall.operators import timeclock as tc
from rollcall.operators.relational import all_duplicates
from rollcall.sources.files import split_records

D = dt.date


def afd(date, time, pis, extra=""):
    return f"0000000013{date}{time}{pis:012d}{extra}"


def test_afd(spark):
    good = afd("29022024", "0815", 77)
    records = [good, good, good + "X", good[:-1], afd("31022024", "0900", 77), afd("01032024", "2460", 78)]
    lines = split_records(spark.createDataFrame([("A", "\r\n".join(records) + "\r\n")], "tenant string, value string"))
    parsed = tc.parse_afd(lines)
    rows = sorted(((r.date, r.minute, r.pis) for r in parsed.collect()), key=repr)
    assert rows == sorted([(D(2024, 2, 29), 495, 77)] * 2 + [(None, 540, 77), (D(2024, 3, 1), None, 78)], key=repr)
    assert all_duplicates(parsed, tc.PUNCH_KEY).count() == 2


def test_match(spark):
    punches = spark.createDataFrame([(5,), (5,), (6,), (None,)], "pis long")
    emp = spark.createDataFrame(
        [("1", 20, 5, "A"), ("1", 10, 5, "A"), ("1", 5, 5, "D"), ("1", 30, 6, "D")], "branch string, emp_no long, pis long, status string"
    )
    got = [(r.pis, r.emp_no) for r in tc.match_punches(punches, emp).collect()]
    assert sorted(got, key=repr) == sorted([(5, 10), (5, 10), (6, None), (None, None)], key=repr)
    assert sorted((r.pis for r in tc.unmatched_pis(punches, emp).collect()), key=repr) == [6, None]


def test_work_date(spark):
    rows = [(m, s) for s in (None, 48000, 48001) for m in (0, 1, 599, 600)]
    df = spark.createDataFrame(rows, "m int, s int").withColumn("d", F.to_date(F.lit("2024-03-01")))
    moved = {(r.m, r.s) for r in df.withColumn("w", tc.work_date(F.col("d"), F.col("m"), F.col("s"))).filter("w <> d").collect()}
    assert moved == {(1, 48001), (599, 48001)}
    starts = tc.shift_starts(spark.createDataFrame([("a", "13:20:01"), ("a", "13:20:01"), ("b", "x")], "shift_desc string, start string"))
    assert {(r.shift_desc, r.start_second) for r in starts.collect()} == {("a", 48001), ("b", None)}


def test_reconcile_and_daily(spark):
    rows = [("1", 1, D(2024, 1, 2), 485), ("1", 1, D(2024, 1, 2), 485), ("1", 1, D(2024, 1, 2), 61), ("1", 2, D(2024, 1, 2), 720), ("1", None, D(2024, 1, 2), 1)]
    matched = spark.createDataFrame(rows, "branch string, emp_no long, date date, minute int")
    erp = tc.erp_punches(spark.createDataFrame([("1", 1, D(2024, 1, 2), 8.05), ("1", 1, D(2024, 1, 2), 8.05)], "branch string, emp_no long, date date, hhmm double"))
    got = {(r.emp_no, r.minute): (r.punches, r.in_erp) for r in tc.reconcile(matched, erp).collect()}
    assert got == {(1, 485): (2, True), (1, 61): (1, False), (2, 720): (1, False)}
    daily = tc.with_parity(tc.daily_punches(matched.withColumn("work_date", F.col("date"))))
    lists = {r.emp_no: (r.punches, r.inconsistent) for r in daily.collect()}
    assert lists == {1: ("01:01:00 | 08:05:00 | 08:05:00", True), 2: ("12:00:00", True)}


def test_grid_and_timesheet(spark):
    emp = spark.createDataFrame([("1", 1, "A"), ("1", 2, "B"), ("1", 3, "C")], "branch string, emp_no long, cost_centre string")
    managers = spark.createDataFrame([("A", "s", "m"), ("B", "s", None)], "cost_centre string, supervisor string, manager string")
    leave = spark.createDataFrame([("1", 1, "away", D(2024, 1, 1), None)], "branch string, emp_no long, leave_desc string, start_date date, end_date date")
    daily = spark.createDataFrame([("1", 1, D(2024, 1, 2), "08:00:00", 1)], "branch string, emp_no long, work_date date, punches string, punches_count long")
    grid = tc.attendance_grid(emp, daily, leave, managers, "2024-01-01", "2024-01-03")
    rows = [(r.emp_no, r.day.day, r.punches, r.weekday, r.leave_desc) for r in grid.orderBy("day").collect()]
    assert rows == [(1, 1, codes.NO_PUNCH, "Seg", "away"), (1, 2, "08:00:00", "Ter", "away"), (1, 3, codes.NO_PUNCH, "Qua", "away")]
    ledger = spark.createDataFrame(
        [("1", 1, D(2024, 1, 2), t) for t in ("FALTA   ", "ATRASO", "FALTA   ", "SAIDA ANTECIPADA", "HE 60% - IN", "x")] + [("1", 1, D(2024, 2, 2), "FALTA")],
        "branch string, emp_no long, date date, event_desc string",
    )
    events = tc.pivot_events(ledger)
    sheet = tc.timesheet(grid, events).orderBy("day").collect()
    assert len(sheet) == 3 and sheet[0].absence_events == ""
    assert sheet[1].absence_events == "ATRASO | FALTA    | FALTA    | SAIDA ANTECIPADA"
    assert (sheet[1].overtime_events, sheet[1].other_events) == ("HE 60% - IN", "x")


def clocking(spark, rows):
    return spark.createDataFrame(rows, "id string, personPIS string, clockingCollectorName string, clockingDate string, timezone string")


def test_import_rows(spark):
    rows = [
        ("1234567890123", "5 ", "d", "01032024013045", "America/Sao_Paulo"), ("2", "5", "d", "31122023233000", "EUROPE/MADRID"), ("3", "5", "d", "01032024120059", "MOON/BASE"),
    ]
    moved = {r.id: (r.date, r.seconds, r.nsr, r.pis) for r in tc.import_rows(clocking(spark, rows)).collect()}
    assert moved == {
        "1234567890123": ("20240229", 22 * 3600 + 30 * 60, "567890123", "5"), "2": ("20240101", 3600 + 30 * 60, "2", "5"), "3": ("20240301", 43200, "3", "5"),
    }
    kept = {r.id: (r.date, r.seconds) for r in tc.import_rows(clocking(spark, rows), keep_date=True).collect()}
    assert kept["1234567890123"] == ("20240301", 22 * 3600 + 30 * 60) and kept["2"] == ("20231231", 5400)


def test_pending_is_idempotent(spark):
    rows = tc.import_rows(clocking(spark, [(i, p, "d", "01032024080000", "x") for i, p in [("1", "5"), ("1", "5"), ("2", "5"), ("3", "6"), ("105", "5"), ("9", "7")]]))
    emp = spark.createDataFrame([(5, "A"), (6, "A"), (7, "D")], "pis long, status string")
    loaded = spark.createDataFrame([("2.0",), ("10.05",)], "id string")
    first = tc.pending_punches(rows, emp, loaded)
    assert sorted(r.id for r in first.collect()) == ["1", "105", "3"]
    assert {r.date: r.punches for r in tc.pending_by_day(first).collect()} == {"20240301": 3}
    assert tc.pending_punches(rows, emp, loaded.union(first.select("id"))).count() == 0


def test_each_event_day_is_on_the_sheet_once(spark):
    """Every event day of an employee on the grid, in the month of the timesheet, is on exactly one line of it."""
    from pathlib import Path

    from rollcall.plans import clock, roles

    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        return
    ledger = tc.event_ledger(*clock.ledger_tables(spark, folder, roles.SHEET_FIRST, roles.SHEET_END))
    people = clock.grid(spark, folder).select("branch", "emp_no").distinct()
    days = roles.shifted(tc.pivot_events(ledger), "date").join(people, ["branch", "emp_no"], "left_semi")
    names = ["overtime_events", "absence_events", "other_events"]
    want = sorted((r.branch, r.emp_no, str(r.date), *(r[n] for n in names)) for r in days.collect())
    rows = clock.timesheet(spark, folder).filter(" OR ".join(f"{n} <> ''" for n in names))
    assert want and want == sorted((r.branch, r.emp_no, r.day, *(r[n] for n in names)) for r in rows.collect())
