"""Tables that are replaced as a whole without a moment in which they cannot be read.

Every refresh writes a folder of its own, ``versions/N``; the last step adds ``N`` to the manifest. Readers take the highest number of the
manifest, so they see the old rows until all new ones are there, and a refresh that fails leaves nothing that counts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.streaming.folders import remove

MANIFEST = "version long, schema string, published timestamp"


def read_or_none(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A Parquet folder, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every version ever published: its number, the schema of its rows as JSON, and when."""
    held = read_or_none(spark, f"{path}/manifest", MANIFEST)
    return spark.createDataFrame([], MANIFEST) if held is None else held


def latest(spark: SparkSession, path: str) -> T.Row | None:
    """The manifest's entry of the highest version; one row."""
    return manifest(spark, path).orderBy(F.desc("version")).limit(1).first()


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> int:
    """Replace the table at ``path`` by ``df`` and return the new version's number.

    ``df`` may read the version it replaces. Folders of all but the last ``keep`` versions are removed afterwards, so a reader has the time of
    ``keep - 1`` refreshes to finish. One refresh runs at a time; its folder is overwritten when it runs again after a failure.
    """
    spark = df.sparkSession
    held = latest(spark, path)
    version = held["version"] + 1 if held else 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/versions/{version}")
    entry = spark.range(1).select(
        F.lit(version).cast("long").alias("version"), F.lit(df.schema.json()).alias("schema"), F.current_timestamp().alias("published")
    )
    entry.write.mode("append").parquet(f"{path}/manifest")
    clear(spark, path, keep)
    return version


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the latest version, or of an older one that is still kept."""
    entries = manifest(spark, path)
    entry = latest(spark, path) if version is None else entries.filter(F.col("version") == version).first()
    if entry is None:
        raise ValueError(f"no version {version or ''} is published at {path}")
    return spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{path}/versions/{entry['version']}")


def clear(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the folders of all versions but the last ``keep`` published ones; the numbers that were removed."""
    entry = latest(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = []
    for status in files.listStatus(folder) if entry and files.exists(folder) else []:
        name = status.getPath().getName()
        if name.isdigit() and int(name) <= entry["version"] - keep:
            remove(spark, f"{path}/versions/{name}")
            removed.append(int(name))
    return sorted(removed)
