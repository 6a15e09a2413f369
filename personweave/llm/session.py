"""Session settings of the queries on texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches in bytes: ten thousand rows, the usual bound, may be a lot of text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark
