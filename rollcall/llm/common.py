"""Session helpers that the operators of this package share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}
#: Arrow batches are cut into pieces of about so many text bytes, so that work arrays stay small.
PIECE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or one below the warehouse where that is unset. A warehouse on a local
    disk is shared by the tasks of one machine only, so a cluster has to name a folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"the executors do not share {warehouse}: set spark.checkpoint.dir to a folder that they share")
    return warehouse + "/checkpoints"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, its lineage cut; the folder is set where the session names none."""
    prepare(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a table and read again: later jobs start from the table. The table stays, as results
    may still read it; whoever owns the folder clears it."""
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def clean_text(column) -> F.Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and where each text begins, with the end of the last."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES):
    """Runs of rows of ``batch`` with about ``limit`` text bytes each (a longer text stands alone): ``(rows, bytes, offsets)``."""
    data, offsets = text_bytes(batch.column(text))
    first = 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
