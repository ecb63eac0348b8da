"""Days that fall into intervals: joins and counts without a join of every day to every interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Days of the shortest bins.
BIN_DAYS = 32


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
    after_start: bool = False,
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """Each row of ``points`` with each interval that holds its day ``at``: ``start <= at <= end``, or ``start < at`` with ``after_start``.

    An interval without an end is still open; one without a start, and a point without a day, hold nothing. Rows with equal ``on`` columns
    meet. An interval belongs to the level whose bins (``bin_days`` times a power of two) are as long as it is, so it lies in two or three of
    them; a point is looked up in its bin of each level. Point and interval meet in one bin, so no pair comes twice, and bins are an equality
    that Spark joins by hash or by sorting. Without ``on`` there are few bins, however many rows they hold, so both sides are also dealt to
    cells (see ``dealt``).
    """
    day = F.unix_date(F.col(at).cast("date"))
    dated = points.filter(F.col(at).isNotNull()).withColumn("_day", day)
    first, last = (dated.agg(f("_day")).scalar() for f in (F.min, F.max))
    # Nothing outside the days that are asked for counts, so open intervals end there.
    begin = F.greatest(F.unix_date(F.col(start).cast("date")) + (1 if after_start else 0), first)
    until = F.least(F.coalesce(F.unix_date(F.col(end).cast("date")), last), last)
    cut = intervals.filter(F.col(start).isNotNull()).withColumns({"_begin": begin, "_until": until}).filter("_begin <= _until")
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.col("_until") - F.col("_begin") + 1) / bin_days))).cast("int")
    levelled = cut.withColumn("_level", level)

    def bin_of(day: str):
        return F.floor(F.col(day) / (F.lit(bin_days) * F.pow(F.lit(2), F.col("_level")))).cast("long")

    held = levelled.withColumn("_bin", F.explode(F.sequence(bin_of("_begin"), bin_of("_until"))))
    # The levels that intervals have: a number for each doubling of their length.
    levels = levelled.agg(F.collect_set("_level")).scalar()
    asked = dated.withColumn("_level", F.explode(levels)).withColumn("_bin", bin_of("_day"))
    keys = [*on, "_level", "_bin"]
    if not on:
        keys += ["_row", "_column"]
        asked, held = dealt(asked, held, dated, levelled, keys)
    pairs = asked.join(held, keys).filter("_day BETWEEN _begin AND _until")
    return pairs.drop("_level", "_bin", "_row", "_column", "_day", "_begin", "_until")


def dealt(asked: DataFrame, held: DataFrame, points: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on few keys in the cells of a grid, a cell for each shuffle partition: a point belongs to a row of it and an
    interval to a column, so each pair meets in one cell. The side with fewer rows is copied more often.

    A task is given by the number of cells, not by the size of what it reads, which says nothing about its pairs.
    """
    cells = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, m = (df.agg(F.count(F.lit(1))).scalar() for df in (points, intervals))
    rows = F.least(F.lit(cells), F.greatest(F.lit(1), F.round(F.sqrt(cells * n / F.greatest(m, F.lit(1)))).cast("int")))
    columns = F.ceil(cells / rows).cast("int")

    def place(df: DataFrame, count: Column) -> Column:
        # Worked out from the row alone, so that a task that runs again deals alike.
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]), count).cast("int")

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    asked = asked.withColumn("_row", place(points, rows)).withColumn("_column", every(columns))
    held = held.withColumn("_column", place(intervals, columns)).withColumn("_row", every(rows))
    return asked.repartition(cells, *keys), held.repartition(cells, *keys)


def counts_on(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, by: Sequence[str], after_start: bool = False, into: str = "active"
) -> DataFrame:
    """How many intervals of each group ``by`` hold each day ``at``; days that no interval of a group holds are left out.

    Starts and ends are counted per group and day before they are added up, so a group has a row per day at most, however many intervals it
    has, and no interval meets a day.
    """
    began = F.unix_date(F.col(start).cast("date")) + (1 if after_start else 0)
    ended = F.unix_date(F.col(end).cast("date")) + 1
    some = intervals.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (ended > began)))
    change = F.array(F.struct(began.alias("_day"), F.lit(1).alias("_n")), F.struct(ended.alias("_day"), F.lit(-1).alias("_n")))
    changes = some.select(*by, F.inline(change)).filter("_day IS NOT NULL").groupBy(*by, "_day").agg(F.sum("_n").alias("_n"))
    days = points.filter(F.col(at).isNotNull()).select(F.unix_date(F.col(at).cast("date")).alias("d")).distinct()
    # One list of the days asked for, a number for each.
    listed = days.agg(F.array_sort(F.collect_list("d"))).scalar()
    asked = changes.select(*by).distinct().withColumn("_day", F.explode(listed)).withColumns({"_n": F.lit(0).cast("long"), "_asked": F.lit(1)})
    both = changes.withColumn("_asked", F.lit(0)).unionByName(asked)
    running = W.partitionBy(*by).orderBy("_day", "_asked").rowsBetween(W.unboundedPreceding, 0)
    counted = both.withColumn(into, F.sum("_n").over(running)).filter(f"_asked = 1 AND {into} > 0")
    return counted.select(*by, F.date_from_unix_date(F.col("_day").cast("int")).alias(at), into)
