"""Where a job may write: the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or one in the warehouse where that is not set. On a cluster a warehouse on a local disk
    is not shared, which is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"the executors do not share {warehouse}: set spark.checkpoint.dir to a folder that they share")
    return warehouse + "/runs"


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run; it stays, as its tables are the result of the run."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written once to a folder of its own and read from there, whatever reads it."""
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def written_once(df: DataFrame, name: str = "batch", by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` written to a folder that is removed at the end of the block; whatever reads it there, it is worked out once.

    Who reads the rows of one value of ``by`` opens their files only.
    """
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
