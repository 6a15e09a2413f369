"""Parquet tables dealt into buckets by key: a batch reads and rewrites only the buckets that its keys fall into."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.sources.scratch import scratch_table


@dataclass(frozen=True)
class BucketTable:
    """A table partitioned by `pmod(xxhash64(keys), buckets)`. `ids` name a row; one writer at a time.

    The number of buckets is fixed when the table is created. What the driver holds is at most one number per bucket.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    ids: tuple[str, ...]
    buckets: int

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write(self, rows: DataFrame) -> None:
        # A bucket is one file, unless a frequent key makes it larger than the advisory size.
        (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.path))

    def create(self, rows: DataFrame) -> "BucketTable":
        columns = [F.col(c) for c in self.schema.fieldNames()]
        self._write(rows.select(*columns, F.lit(True).alias("present"), self._bucket()))
        return self

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of the keys."""
        return sorted(r["bucket"] for r in keys.select(self._bucket()).distinct().collect())

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: the others' files are not read."""
        fields = [*self.schema.fields, T.StructField("present", T.BooleanType()), T.StructField("bucket", T.IntegerType())]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        return rows.where("present").drop("present", "bucket")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys. `keys` is used twice: pass a stored table."""
        return self.read(self.touched(keys)).join(keys.select(*self.keys).distinct(), list(self.keys), "left_semi")

    def merge(self, new: DataFrame, gone: DataFrame | None = None) -> list[int]:
        """Put `new` in the place of the rows with its ids and delete the ids of `gone`; rewrites the buckets touched.

        Doing it again changes nothing, so an interrupted merge is simply repeated. Both inputs are used twice.
        """
        names, ids = self.schema.fieldNames(), list(self.ids)
        replaced = new.select(*ids) if gone is None else new.select(*ids).unionByName(gone.select(*ids))
        buckets = self.touched(replaced.select(*self.keys))
        if not buckets:
            return []
        kept = self.read(buckets).join(replaced.distinct(), ids, "left_anti")
        rows = kept.select(*names).unionByName(new.select(*names)).select("*", F.lit(True).alias("present"), self._bucket())
        # A row that is not there keeps the bucket of a table that lost its last rows from being left as it was.
        marks = self.spark.createDataFrame([(b, False) for b in buckets], "bucket int, present boolean")
        self._write(scratch_table(rows.unionByName(marks, allowMissingColumns=True), "buckets"))
        return buckets
