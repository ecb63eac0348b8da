from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import intervals

FIRST = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else FIRST + dt.timedelta(days=n)


def frames(spark, seed=3):
    """Intervals of a day up to many years, open ones, reversed ones and some without a start; repeated points and repeated intervals."""
    rng = random.Random(seed)
    points = [(i, rng.choice("ab"), day(rng.choice([None, *range(-50, 900)]))) for i in range(150)]
    spans = []
    for i in range(200):
        start = rng.choice([None, rng.randint(-3000, 900), rng.randint(-40, 900), rng.randint(-40, 900)])
        length = rng.choice([0, 1, 31, 32, 33, 64, 365, 4000, rng.randint(-5, 700)])
        spans.append((i, rng.choice("ab"), day(start), None if start is None or rng.random() < 0.2 else day(start + length)))
    points, spans = points + points[:3], spans + spans[:3]
    return points, spans, spark.createDataFrame(points, "p int, g string, at date"), spark.createDataFrame(spans, "i int, g string, s date, e date")


def holds(at, start, end, after):
    return at is not None and start is not None and (start < at if after else start <= at) and (end is None or at <= end)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("on", [[], ["g"]])
def test_join_equals_comparing_all(spark, after, on):
    points, spans, p, s = frames(spark)
    s = s if on else s.drop("g")
    got = intervals.interval_join(p, s, "at", "s", "e", on, after_start=after)
    assert set(got.columns) == {"p", "g", "at", "i", "s", "e"}
    want = [(a[0], b[0]) for a in points for b in spans if holds(a[2], b[2], b[3], after) and (not on or a[1] == b[1])]
    assert sorted((r.p, r.i) for r in got.collect()) == sorted(want)


def test_join_needs_no_nested_loop(spark):
    _, _, p, s = frames(spark)
    plan = intervals.interval_join(p, s.drop("g"), "at", "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" in plan


@pytest.mark.parametrize("bin_days", [1, 7, 1000])
def test_any_width_gives_the_same_pairs(spark, bin_days):
    _, _, p, s = frames(spark, 8)
    rows = [intervals.interval_join(p, s, "at", "s", "e", ["g"], bin_days=b).select("p", "i").collect() for b in (32, bin_days)]
    assert sorted(rows[0]) == sorted(rows[1])


def test_a_join_without_keys_is_dealt_to_all_tasks(spark):
    """One bin holds everything, and what the sides weigh says nothing about their pairs."""
    points = spark.range(40).select(F.date_add(F.lit(FIRST), F.col("id").cast("int")).alias("at"))
    spans = spark.range(300).select("id", F.lit(FIRST).alias("s"), F.lit(None).cast("date").alias("e"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = intervals.interval_join(points, spans, "at", "s", "e").withColumn("task", F.spark_partition_id())
        shares = [r["count"] for r in pairs.groupBy("task").count().collect()]
        few = intervals.interval_join(points, spans.limit(2), "at", "s", "e").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(shares) == 40 * 300 and len(shares) > 1 and max(shares) < 40 * 300
    assert few == 40 * 2


@pytest.mark.parametrize("after", [False, True])
def test_counts_equal_the_join(spark, after):
    points, spans, p, s = frames(spark, 5)
    got = {(r.g, r["at"]): r.active for r in intervals.counts_on(p, s, "at", "s", "e", ["g"], after).collect()}
    days = {a[2] for a in points if a[2]}
    want = {(g, d): sum(holds(d, b[2], b[3], after) for b in spans if b[1] == g) for g in "ab" for d in days}
    assert got == {k: n for k, n in want.items() if n}


def test_empty(spark):
    _, _, p, s = frames(spark)
    for a, b in ((p.limit(0), s), (p, s.limit(0))):
        assert intervals.interval_join(a, b.drop("g"), "at", "s", "e").count() == 0
        assert intervals.counts_on(a, b, "at", "s", "e", ["g"]).count() == 0
