"""Ordered dedup, anti-join loads, typed joins, schema alignment and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from rollcall.functions.text import joined, run_text
from rollcall.streaming.folders import staged

#: Entries of a list that is written out; longer lists stay as runs.
LIST_LIMIT = 10_000


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], aggregate) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg(aggregate(row).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, ties broken by the other columns.

    An aggregate, not a row number: each task keeps one row per key before the shuffle, so a key with very many
    rows costs no more than any other.
    """
    return _pick(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``, ties broken by the other columns."""
    return _pick(df, keys, order, F.max)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, as ``rows_per_key``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key"))


def keyed_join(fact: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of the same types; a type that differs is an error instead of a silent cast.

    A key with very many rows needs nothing here: the adaptive planner splits its partition on the side of ``fact`` (see
    ``session``), also where that costs a shuffle more.
    """
    on = list(on)
    types = [[df.schema[c].dataType for c in on] for df in (fact, other)]
    if types[0] != types[1]:
        raise TypeError(f"join keys {on} differ in type: {types[0]} and {types[1]}")
    return fact.join(other, on, how)


def all_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    repeated = key_counts(df, keys).filter("rows_per_key > 1").select(*keys)
    return keyed_join(df, repeated, keys, "left_semi")


def anti_load(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet. The keys of ``new`` are unique or nearly so."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def known(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists in the reference frame."""
    return keyed_join(df, reference.select(*keys).distinct(), keys, "left_semi")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "inner") -> DataFrame:
    """Join a frame to several dimension tables. Spark broadcasts those below its size threshold."""
    for dim, on in dims:
        fact = fact.join(dim, list(on), how)
    return fact


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy a predicate, and all the others (also those where it is NULL)."""
    test = F.coalesce(predicate, F.lit(False))
    return df.filter(test), df.filter(~test)


def label_by(df: DataFrame, predicate: Column, into: str, yes: str, no: str) -> DataFrame:
    """Both parts of a split in one frame, told apart by a column; ``export_by`` then writes them in one job."""
    return df.withColumn(into, F.when(predicate, yes).otherwise(no))


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of the target in its order; extra columns go, missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def with_literals(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def fill_missing(df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """NULL as 0 in number columns and as empty text in text columns."""
    if numbers:
        df = df.fillna(0, subset=list(numbers))
    return df.fillna("", subset=list(texts)) if texts else df


def first_rows(df: DataFrame, order: Sequence[str], rows: int = 1) -> DataFrame:
    """The first rows in an order, as a preview. Each task keeps that many, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(rows)


def max_or(df: DataFrame, column: str, default) -> DataFrame:
    """One row with the highest value of a column, or the default for an empty frame."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(column))


def run_lists(df: DataFrame, keys: Sequence[str], value: str, into: str, order: str | None = None) -> DataFrame:
    """Per key, the values in order as one text; copies are counted before the lists are built.

    A list holds one entry per distinct value (minutes of a day, names of a catalogue), however many rows share it.
    """
    order = order or value
    columns = list(dict.fromkeys([*keys, order, value]))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    runs = F.array_sort(
        F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"), F.col("_n").alias("n")))
    )
    return (
        counted.groupBy(*keys)
        .agg(runs.alias("_runs"), F.sum("_n").alias(f"{into}_count"))
        .withColumn(into, F.array_join(F.transform("_runs", lambda r: run_text(r.v.cast("string"), r.n)), " | "))
        .drop("_runs")
    )


def _runs(value: str, order: str) -> Column:
    run = F.struct(F.col(order).alias("o"), F.col(value).alias("value"), F.col("_n").alias("copies"))
    return F.transform(F.array_sort(F.collect_list(run)), lambda r: F.struct(r["value"].alias("value"), r["copies"].alias("copies")))


def value_lists(df: DataFrame, keys: Sequence[str], value: str, into: str, order: str | None = None) -> DataFrame:
    """Per key, the values in order as a list of runs ``(value, copies)`` and their number, as ``into`` and ``into_count``.

    Copies are counted before a list is built, so a list has an entry per distinct value (minutes of a day, names of a catalogue), however
    many rows share it. ``expanded`` makes the list of all values of it, ``list_text`` its text. NULL values are left out.
    """
    order = order or value
    columns = list(dict.fromkeys([*keys, order, value]))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(_runs(value, order).alias(into), F.sum("_n").alias(f"{into}_count"))


def pivot_lists(df: DataFrame, keys: Sequence[str], column: str, names: Sequence[str], value: str, order: str | None = None) -> DataFrame:
    """One row per key and a list of runs for each of the given values of ``column``; a value that a key lacks has an empty list."""
    order = order or value
    columns = list(dict.fromkeys([*keys, column, order, value]))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    wide = counted.groupBy(*keys).pivot(column, list(names)).agg(_runs(value, order))
    kind = wide.schema[names[0]].dataType
    return wide.withColumns({n: F.coalesce(n, F.array().cast(kind)) for n in names})


def expanded(runs: Column) -> Column:
    """The list of all values of a list of runs."""
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(r["value"], r["copies"].cast("int"))))


def list_text(runs: Column, limit: int = LIST_LIMIT) -> Column:
    """A list of runs as text, each value as often as it occurs: ``a | a | b``. A list of more than ``limit`` values is written by runs,
    ``a x20000 | b``, which says the same."""
    count = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["copies"])
    by_runs = F.transform(runs, lambda r: run_text(r["value"].cast("string"), r["copies"]))
    return F.when(count <= limit, joined(expanded(runs))).otherwise(joined(by_runs))


def assign_recno(df: DataFrame, start: DataFrame, key: str, within: Sequence[str] = (), into: str = "recno") -> DataFrame:
    """Gapless ids in the order of ``(within, key)`` that go on from the number in the one-row frame ``start``.

    The key may have any type that can be ordered, be sparse, and repeat: ties go by the other columns, so the ids depend on the rows alone;
    rows that are alike in all columns are exchangeable. Rows are dealt to the tasks by ranges of that order and sorted there, and written
    with their place; an id is that place plus the number of rows in the ranges before. Only the ranges' counts, a row for each task, are added
    up in one place.
    """
    order = list(dict.fromkeys([*within, key, *df.columns]))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The lower 33 bits of Spark's increasing id are the place of a row in its task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Ranges are drawn from a sample, anew in each run, so the rows are written once.
    placed = staged(ranged.withColumns({"_range": F.spark_partition_id(), "_at": place}), "numbered")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    total = F.col("_before") + F.col("_at") + 1 + F.coalesce(start.scalar(), F.lit(0))
    return placed.join(before, "_range").withColumn(into, total).drop("_range", "_at", "_before")
