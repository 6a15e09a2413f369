"""Intermediate tables: cut lineage by writing to the shared folder named in `spark.checkpoint.dir`."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; only a master of a single process may do without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="personweave-")
    return _local_folders[context.applicationId]


def scratch_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` once and read it back, so later steps neither recompute it nor depend on a live executor."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
