from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions import codes, dates, hours, text
from rollcall.operators.benefits import prorata_days, shift_class


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def lit(value):
    return F.lit(value).cast("string") if value is None else F.lit(value)


def test_text(spark):
    row = one(
        spark,
        padded=text.pad_left(F.lit("123"), 5),
        long=text.pad_left(F.lit("123456789012"), 11),
        none=text.pad_left(lit(None), 11),
        last=text.keep_last(F.lit("1234567890123"), 9),
        short=text.keep_last(F.lit("77"), 9),
        pipes=text.count_char(F.lit("a | b | c"), "|"),
        suffix=text.drop_decimal_suffix(F.lit("123.0 ")),
        inside=text.drop_decimal_suffix(F.lit("10.05")),
        comma=text.comma_decimal(F.lit(" 7,33 ")),
        bad=text.comma_decimal(F.lit("x")),
        money=text.brazilian_money(F.lit("1.234,56")),
        missing=text.capture(F.lit("abc"), r"x(\d*)"),
        empty=text.capture(F.lit("NO: "), r"NO:\s*(\d*)", may_be_empty=True),
        clean=text.remove_chars(F.lit(" E.M/P-R "), "./-"),
        blank=text.blank_to_null(F.lit("   ")),
        few=text.run_text(F.lit("08:00"), F.lit(3)),
        one=text.run_text(F.lit("08:00"), F.lit(1)),
        many=text.run_text(F.lit("08:00"), F.lit(1_000_000)),
    )
    assert row.asDict() == {
        "padded": "00123", "long": "123456789012", "none": None, "last": "567890123", "short": "77", "pipes": 2,
        "suffix": "123", "inside": "10.05", "comma": 7.33, "bad": None, "money": Decimal("1234.56"), "missing": None,
        "empty": "", "clean": "EMPR", "blank": None, "few": "08:00 x3", "one": "08:00", "many": "08:00 x1000000",
    }


def test_dates(spark):
    day = F.to_date(F.lit("2024-03-31"))
    row = one(
        spark,
        good=dates.erp_date(F.lit("20240229 ")),
        blank=dates.erp_date(F.lit("        ")),
        stand_in=dates.erp_date(F.lit("19000101")),
        invalid=dates.erp_date(F.lit("20240230")),
        period=dates.period_date(F.lit(202402.0)),
        no_period=dates.period_date(F.lit(202413)),
        sunday=dates.weekday_label(day, codes.ABSENCE_WEEKDAYS),
        wednesday=dates.weekday_label(F.date_sub(day, 4), codes.ABSENCE_WEEKDAYS),
        start=dates.month_start("2024-01-15", -1),
        end=dates.month_end("2024-01-31", 1),
        noon=dates.clock_minutes(F.lit("1200")),
        no_time=dates.clock_minutes(F.lit("2460")),
        written=dates.minutes_text(F.lit(605)),
    )
    d = dt.date
    assert row.asDict() == {
        "good": d(2024, 2, 29), "blank": None, "stand_in": None, "invalid": None, "period": d(2024, 2, 1),
        "no_period": None, "sunday": "Dom", "wednesday": "Quar", "start": d(2023, 12, 1), "end": d(2024, 2, 29),
        "noon": 720, "no_time": None, "written": "10:05:00",
    }


def test_pay_cycle(spark):
    def cycle(day):
        first, last = dates.pay_cycle(day)
        return tuple(one(spark, first=first, last=last))

    assert cycle(dt.date(2024, 1, 10)) == (dt.date(2023, 12, 21), dt.date(2024, 1, 9))
    assert cycle("2024-03-01") == (dt.date(2024, 1, 21), dt.date(2024, 2, 29))


def test_hours(spark):
    row = one(
        spark,
        half=hours.hhmm_to_hours(F.lit(7.30)),
        minutes=hours.hhmm_minutes(F.lit(8.59)),
        zero=hours.hhmm_to_hours(F.lit(0.0)),
        tie=hours.rate(F.lit(261), F.lit(12000.0)),
        nothing=hours.rate(F.lit(1), F.lit(0)),
    )
    assert row.asDict() == {"half": 7.5, "minutes": 539, "zero": 0.0, "tie": 2.18, "nothing": None}


def test_rates_round_halves_to_even(spark):
    """Exact ties as pandas rounds them."""
    parts = [1, 3, 5, 7, 9, 11]
    row = one(spark, **{f"r{p}": hours.rate(F.lit(p), F.lit(800)) for p in parts})
    assert list(row) == [float(pd.Series([p / 800 * 100]).round(2)[0]) for p in parts] == [0.12, 0.38, 0.62, 0.88, 1.12, 1.38]


@settings(max_examples=20, deadline=None)
@given(h=st.integers(0, 400), m=st.integers(0, 59))
def test_hhmm_round_trip(spark, h, m):
    value = one(spark, v=hours.hhmm_minutes(F.lit(h + m / 100))).v
    assert value == h * 60 + m


def test_labels(spark):
    row = one(
        spark,
        known=codes.label(F.lit("3"), codes.UNHEALTHY_LABELS),
        other=codes.label(F.lit("9"), codes.UNHEALTHY_LABELS),
        none=codes.label(lit(None), codes.HAZARD_LABELS),
        mixed=codes.zone_offset(F.lit("America/Sao_Paulo")),
        unknown=codes.zone_offset(F.lit("MOON/BASE")),
    )
    assert row.asDict() == {"known": "Média", "other": "Não", "none": "Sim", "mixed": -3, "unknown": 0}


def test_fixed_lists():
    assert len(codes.REPORT_EXCLUDED_CODES) == len(set(codes.REPORT_EXCLUDED_CODES)) == 52
    assert len(codes.ZONE_OFFSETS) == 34
    assert len(codes.OVERTIME_EVENTS) == 19 and len(codes.ABSENCE_EVENTS) == 7


def test_weekday_count_equals_listing(spark):
    spans = [(dt.date(2024, 2, 1) + dt.timedelta(a), dt.date(2024, 2, 1) + dt.timedelta(a + n)) for a in range(7) for n in range(-2, 33)]
    df = spark.createDataFrame(spans, "a date, b date")
    counted = df.select("a", "b", *[dates.weekday_count(F.col("a"), F.col("b"), w).alias(f"w{w}") for w in range(1, 8)])
    for row in counted.collect():
        days = [row.a + dt.timedelta(i) for i in range((row.b - row.a).days + 1)]
        for w in range(1, 8):
            assert row[f"w{w}"] == sum(d.isoweekday() % 7 + 1 == w for d in days)


@pytest.mark.parametrize("month", ["2024-01-10", "2023-02-10", "2024-06-10"])
def test_prorata_equals_listing(spark, month):
    first = dt.date.fromisoformat(month).replace(day=1)
    last = (first + dt.timedelta(32)).replace(day=1) - dt.timedelta(1)
    df = spark.createDataFrame([(a, k) for a in range(1, 32) for k in range(8)], "a int, k int")
    rows = df.withColumn("days", prorata_days(F.col("a"), F.col("k"), month, F.lit(2))).collect()
    for row in rows:
        days = [first.replace(day=d) for d in range(row.a, last.day + 1)]
        sat, sun = sum(d.weekday() == 5 for d in days), sum(d.weekday() == 6 for d in days)
        n = last.day - row.a
        wanted = {
            0: n - sat - sun - 2, 1: n, 2: n, 3: sum(d.day % 2 == row.a % 2 for d in days), 4: n - sat, 5: n - sun,
            6: round(n * 20 / 30), 7: n - 2 - sun,
        }[row.k]
        assert row.days == wanted, (row, wanted)


def test_shift_class(spark):
    texts = ["SEG 25 DIAS", "30 DIAS 12X36", "X (12X36)", "FOL SAB", "FOL DOM", "4X2", "SEG-SAB", "FOL SAB DIAS", "ADM"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.c for r in df.select("i", shift_class(F.col("t")).alias("c")).orderBy("i").collect()] == [1, 2, 3, 4, 5, 6, 7, 0, 0]
