"""Readers for source files and the mapping of a source's columns to the canonical record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.schemas import ATTRIBUTES, CHANGES, STAGED_COLUMNS


def read_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read CSV or Parquet with a fixed schema; malformed CSV rows stop the job."""
    reader = spark.read.schema(schema)
    if path.rstrip("/").lower().endswith((".csv", ".csv.gz")):
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.parquet(path)


def map_attributes(df: DataFrame, source: str, primary_key: str, attributes: dict[str, str]) -> DataFrame:
    """Select canonical columns; `attributes` maps canonical name -> source column, absent ones become null."""
    def attribute(name: str) -> Column:
        return F.col(attributes[name]) if name in attributes else F.lit(None)

    return df.select(
        F.col(primary_key).cast("string").alias("external_id"),
        F.lit(source).alias("source_system"),
        *[attribute(name).cast("string").alias(name) for name in ATTRIBUTES],
    )


def unify(frames: list[DataFrame]) -> DataFrame:
    """All staged sources as one table, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*STAGED_COLUMNS)


def read_changes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Change rows as a stream; the query's checkpoint is the read offset."""
    reader = spark.readStream.schema(CHANGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
