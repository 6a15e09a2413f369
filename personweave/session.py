"""Session settings that the jobs rely on at scale."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # A join with one row per key on one side may have a third of the other side's rows on one key: split it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with these settings; shuffle partitions and memory stay with the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
