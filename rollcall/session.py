"""Session settings the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive planning with skew splitting, and UTC. Partition counts and sizes stay as the cluster sets them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
