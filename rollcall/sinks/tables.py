"""Table and file sinks. Every writer is one distributed job; none gathers rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.relational import all_duplicates


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_jdbc(df: DataFrame, table: str, options: dict[str, str], batch: int = 1000) -> None:
    """Add rows to a database table, ``batch`` rows per statement."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch).mode("append").save()


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet folder in place, for tables that nobody reads meanwhile; ``versions.publish`` replaces one under its readers.
    ``df`` must not read the table it replaces."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def refresh_jdbc(df: DataFrame, table: str, options: dict[str, str], batch: int = 1000) -> None:
    """Replace the rows of a database table and keep its definition."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table).option("truncate", "true")
    writer.option("batchsize", batch).mode("overwrite").save()


def append_with_rejects(df: DataFrame, valid: Column, path: str) -> None:
    """Add rows to a table and those that are not valid to its rejects, in one job: the folders ``valid=true`` and ``valid=false``.

    Every call adds rows; ``loads.load`` keeps a log, so that a load counts once, and a reason for each rejected row.
    """
    df.withColumn("valid", F.coalesce(valid, F.lit(False))).write.mode("append").partitionBy("valid").parquet(path)


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """Valid rows that ``append_with_rejects`` wrote."""
    return spark.read.parquet(path).filter("valid = true").drop("valid")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rows that ``append_with_rejects`` rejected."""
    return spark.read.parquet(path).filter("valid = false").drop("valid")


def export(df: DataFrame, path: str) -> None:
    """A report as a folder of CSV files with headings."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def export_by(df: DataFrame, column: str, path: str, files: int | None = None, rows_per_file: int = 1_000_000) -> None:
    """A report split by the values of a column: one folder per value, with files by rows.

    The adaptive planner gathers the rows of small values in one task and splits those of a large one over several, so the number of files
    follows the rows. With ``files``, each value has so many files at most, however many rows it has.
    """
    if files:
        part = F.pmod(F.xxhash64(*[c for c in df.columns if c != column]), F.lit(files))
        dealt = df.repartition(F.col(column), part)
    else:
        dealt = df.hint("rebalance", F.col(column))
    writer = dealt.write.mode("overwrite").option("maxRecordsPerFile", 0 if files else rows_per_file)
    writer.partitionBy(column).option("header", "true").csv(path)


def export_duplicates(df: DataFrame, keys: Sequence[str], path: str) -> None:
    """A data-quality report of all rows whose key occurs more than once."""
    export(all_duplicates(df, keys), path)


def export_gaps(catalogue: DataFrame, path: str) -> None:
    """A data-quality report of the shifts without hours."""
    export(catalogue.filter(F.col("shift_missing")), path)
