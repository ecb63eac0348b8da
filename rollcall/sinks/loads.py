"""Loads that count once: rows are checked, kept apart by reason, and a log beside the table says which loads are complete.

A load writes its rows to a folder of its own, ``rows/load=ID``, and then adds its id to the log. Readers take only loads of the log. A load
that is in the log is not run again; one that failed before it got there overwrites what it left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sinks.versions import read_or_none

LOG = "load string, accepted long, rejected long, loaded timestamp"
#: Reasons that a load finds by itself, after the rules of the caller.
NO_KEY, KEY_EXISTS, KEY_REPEATS = "no key", "key exists", "key repeats"
EXTRA = "reason string, copies long, load string"


def load_log(spark: SparkSession, path: str) -> DataFrame:
    """The loads that are complete, with their numbers of rows."""
    log = read_or_none(spark, f"{path}/log", LOG)
    return spark.createDataFrame([], LOG) if log is None else log


def rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of complete loads, with ``reason`` (NULL where accepted), ``copies`` and ``load``."""
    wanted = T.StructType([*schema.fields, *T.StructType.fromDDL(EXTRA).fields])
    held = read_or_none(spark, f"{path}/rows", wanted)
    if held is None:
        return spark.createDataFrame([], wanted)
    return held.join(load_log(spark, path).select("load").distinct(), "load", "left_semi").select(*wanted.names)


def accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the table."""
    return rows(spark, path, schema).filter("reason IS NULL").drop("reason", "copies", "load")


def rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rejected rows with their reason, how often the row came (``copies``), and the load."""
    return rows(spark, path, schema).filter("reason IS NOT NULL")


def with_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reason``: the first rule that a row does not satisfy; a rule that is NULL for a row is not satisfied."""
    unmet = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reason", F.coalesce(*unmet, F.lit(None).cast("string")))


def once_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with ``reason`` and ``copies``: of the rows of one key the smallest is accepted, once; the others repeat it.

    Equal rows are counted before they meet, and a repeat is kept as one row with its number of copies, so a key with very many rows costs
    no more than its different rows.
    """
    others = [c for c in df.columns if c not in keys]
    different = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    if not others:
        first, more = F.lit(True), different
    else:
        best = different.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_best"))
        more = different.join(best, list(keys))
        first = F.struct(*others) == F.col("_best")
    parts = F.when(
        first,
        F.filter(
            F.array(
                F.struct(F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("copies")),
                F.struct(F.lit(KEY_REPEATS).alias("reason"), (F.col("copies") - 1).alias("copies")),
            ),
            lambda p: p["copies"] > 0,
        ),
    ).otherwise(F.array(F.struct(F.lit(KEY_REPEATS).alias("reason"), F.col("copies").alias("copies"))))
    return more.select(*df.columns, F.inline(parts))


def load(df: DataFrame, path: str, load_id: str, rules: Mapping[str, Column] | None = None, keys: Sequence[str] = ()) -> bool:
    """Load ``df`` into the table at ``path`` under the id of its delivery; False where that load was complete before.

    Rows that do not satisfy a rule are rejected with its name. With ``keys`` the table holds each key once: rows without a key, with a key
    that an earlier load brought, or that repeat a key of the same load are rejected. One load runs at a time.
    """
    spark, plain = df.sparkSession, df.schema
    if not load_log(spark, path).filter(F.col("load") == load_id).isEmpty():
        return False
    keyed = {NO_KEY: reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])} if keys else {}
    checked = with_reason(df, {**(rules or {}), **keyed})
    bad = checked.filter("reason IS NOT NULL").withColumn("copies", F.lit(1).cast("long"))
    good = checked.filter("reason IS NULL").drop("reason")
    if keys:
        held = accepted(spark, path, plain).select(*keys).withColumn("_held", F.lit(True))
        seen = once_per_key(good, keys).join(held, list(keys), "left")
        good = seen.withColumn("reason", F.when(F.col("_held"), F.lit(KEY_EXISTS)).otherwise(F.col("reason"))).drop("_held")
    else:
        good = good.withColumns({"reason": F.lit(None).cast("string"), "copies": F.lit(1).cast("long")})
    folder = f"{path}/rows/load={load_id}"
    good.unionByName(bad).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(f"reason string, copies long").parquet(folder)
    counts = written.agg(
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("copies"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("copies"))), F.lit(0)).alias("rejected"),
    )
    entry = counts.select(F.lit(load_id).alias("load"), "accepted", "rejected", F.current_timestamp().alias("loaded"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return True
