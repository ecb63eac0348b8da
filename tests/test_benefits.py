from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import benefits

D = dt.date
E = "branch string, emp_no long"


def test_base_variants(spark):
    rows = spark.createDataFrame(
        [("1", 1, "10", "90", 22, 20, 21, 30.0, 0), ("1", 1, "20", "92", 22, 20, 21, 100.0, 0), ("1", 2, "30", "87", 22, 18, 17, 9.0, 2), ("9", 3, "40", "94", 22, 22, 22, 5.0, 0)],
        E + ", benefit_code string, benefit_type string, work_days int, prop_days int, calc_days int, unit_value double, vacation_days int",
    )
    defs = spark.createDataFrame([("10", "TK VA", "2"), ("20", "TK CESTA", "2"), ("30", "VR DIAS", "1"), ("40", "CARD", "2")], "benefit_code string, benefit_desc string, voucher_type string")
    emp = spark.createDataFrame(
        [("1", 1, "a", "1", D(2020, 1, 1), None, "C", "U", "S", "DP1234 ", "a b", D(1990, 12, 31), "F"), ("1", 2, "b", "2", D(2020, 1, 1), None, "C", "U", "S", "DP1234 ", "b b", None, "M"),
         ("9", 3, "c", "3", D(2020, 1, 1), None, "C", "U", "S", "DP1234 ", "c d", D(1990, 12, 31), "F"), ("1", 4, "gone", "4", D(2020, 1, 1), D(2024, 1, 1), "C", "U", "S", "DP1234 ", "g", None, "F")],
        E + ", name string, cpf string, admission date, termination date, cost_centre string, union_code string, shift string, dept string, full_name string, birth date, sex string",
    )
    dims = [
        spark.createDataFrame([("1", "C", "c"), ("9", "C", "c ABANDONO")], "branch string, cost_centre string, cost_centre_desc string"),
        spark.createDataFrame([("U", "u")], "union_code string, union_desc string"),
        spark.createDataFrame([("S", "s")], "shift string, shift_desc string"),
        spark.createDataFrame([("DP1234 ", "d")], "dept string, dept_desc string"),
        spark.createDataFrame([("1", "K1")], "branch string, contract string"),
    ]

    def base(kind):
        return benefits.benefit_base(benefits.benefit_rows(rows, defs, kind), benefits.benefit_people(emp, *dims, kind))

    assert sorted(r.benefit_desc for r in base(benefits.FOOD).collect()) == ["TK CESTA", "TK VA"]
    ticket, sheet = base(benefits.MEAL_TICKET).first(), base(benefits.MEAL_TICKET_SHEET).first()
    assert (ticket.base_days, ticket.unused_days, sheet.base_days) == (18, 4, 17)
    card = base(benefits.MEAL_CARD)
    one = card.first()
    assert (one.contract, one.site) == ("Verificar", "1234")
    assert (one.full_name, one.printed_name, one.birth_date, one.sex) == ("c d", "c", "31/12/1990", "F")
    assert [r.part for r in benefits.abandonment_split(card).collect()] == ["abandonment"]
    assert [r.part for r in benefits.abandonment_split(base(benefits.MEAL_TICKET)).collect()] == ["other"]


def test_rules_and_routing(spark):
    rows = spark.createDataFrame(
        [
            (1, "TK VA", "A", 20, 2, 1, 5, 10.0, 0, 0.0, ""), (2, "TK VA 25 DIAS", "B", 20, 0, 1, 5, 10.0, 3, 30.0, ""),
            (3, "TK CESTA", "A", 20, 0, 0, 0, 100.0, 14, 1400.0, "PAGA"), (4, "TK CESTA", "Z", 20, 0, 0, 0, 100.0, 15, 1500.0, "NÃO PAGA"),
            (5, "OUTRO", "A", 20, 0, 0, 0, 1.0, 0, 0.0, ""),
        ],
        "emp_no int, benefit_desc string, cost_centre string, base_days int, medical_days int, unexcused_days int, vacation_days int, "
        "unit_value double, admission_days int, admission_amount double, payment string",
    )
    calendar = spark.createDataFrame([("A", "5"), ("B", "0")], "cost_centre string, payment_day string")
    got = {r.emp_no: (r.rule, r.payment_day, r.corrected_days, r.admission_amount) for r in benefits.route_payment(rows, calendar).collect()}
    assert got == {1: ("food", "5", 17, 0.0), 2: ("food", "0", 14, 30.0), 3: ("basket", "5", 1, 0.0), 4: ("basket", "none", 0, 100.0)}
    assert benefits.basket_rule(rows.filter("emp_no = 4")).first().admission_amount == 100.0
    assert benefits.meal_rule(rows.filter("emp_no = 2")).first().corrected_days == 14


def test_prorata_uses_previous_month(spark):
    emp = spark.createDataFrame(
        [("1", 1, D(2024, 1, 31), None, "S"), ("1", 2, D(2024, 1, 1), None, "S"), ("1", 3, D(2024, 1, 5), D(2024, 1, 9), "S"), ("1", 4, D(2023, 12, 5), None, "S")],
        E + ", admission date, termination date, shift string",
    )
    shifts = spark.createDataFrame([("S", "ADM")], "shift string, shift_desc string")
    holidays = spark.createDataFrame([(D(2023, 12, 25),), (D(2023, 12, 25),), (D(2024, 1, 1),)], "date date")
    got = benefits.admission_prorata(emp, shifts, holidays, "2024-01-10")
    # December 2023 has 31 days, five Saturdays, five Sundays and one holiday in the table.
    assert {r.emp_no: r.admission_days for r in got.collect()} == {1: -2, 2: 30 - 11}
    earlier = benefits.admission_prorata(emp, shifts, holidays, "2024-01-10", months=(-1, -1))
    assert [r.emp_no for r in earlier.collect()] == [4]


def test_own_dates(spark):
    people = spark.createDataFrame(
        [("1", 1, D(2024, 1, 31), None, "ADM"), ("1", 2, D(2023, 12, 1), None, "ADM"), ("1", 3, D(2024, 1, 5), D(2024, 1, 9), "ADM")],
        E + ", admission date, termination date, shift_desc string",
    )
    holidays = spark.createDataFrame([(D(2023, 12, 25),)], "date date")
    got = benefits.with_own_dates(people, holidays, "2024-01-10", benefits.FOOD).collect()
    assert {r.emp_no: (r.admission_days, r.terminated) for r in got} == {1: (-2, False), 2: (0, False), 3: (0, True)}


def test_enrich(spark):
    people = spark.createDataFrame([("1", 1, "U", 4), ("1", 2, "U", 0), ("1", 4, "V", 0)], E + ", union_code string, admission_days int")
    absences = spark.createDataFrame([("1", 1, 2, 1)], E + ", medical_days int, unexcused_days int")
    leave = spark.createDataFrame([("1", 1, "DOENCA", 5), ("1", 4, "DOENCA", 5)], E + ", leave_desc string, days_away int")
    rules = spark.createDataFrame([("U", "NAO", 15)], "union_code string, maternity_120 string, leave_limit_days int")
    rows = spark.createDataFrame([("1", 1, 2.5), ("1", 2, 2.5), ("1", 3, 2.5), ("1", 4, 2.5)], E + ", unit_value double")
    columns = ["medical_days", "unexcused_days", "admission_days", "payment", "admission_amount"]

    def rich(missing):
        staff = benefits.enrich_people(people, absences, leave, rules, missing)
        return {r[0]: tuple(r)[1:] for r in benefits.benefit_enriched(rows, staff).select("emp_no", *columns).collect()}

    assert rich(0) == {1: (2, 1, 4, "PAGA", 10.0), 2: (0, 0, 0, "", 0.0), 4: (0, 0, 0, "NÃO PAGA", 0.0)}
    assert rich(None)[4][3] == "UNDEFINED"
