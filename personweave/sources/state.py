"""The stored identity graph: Parquet tables, partitioned by the version of the batch that wrote a row.

A batch appends only its changed rows and then one row to the table of batches; versions that are not in it are never
read. A table is the last row per key, without those that are marked as deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.operators.upsert import last_per_key
from personweave.schemas import ATTRIBUTES, STAGED_COLUMNS

KEYS = {"members": ["rec_id"], "golden": ["entity_id"], "override": ["left_id", "right_id"], "lock": ["entity_id"]}

_TYPES = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "int": T.IntegerType(),
          "timestamp": T.TimestampType(), "string": T.StringType()}


def _schema(columns: str) -> T.StructType:
    """Schema from `name` or `name:type` words; the default type is string."""
    words = [w.split(":") for w in columns.split()]
    return T.StructType([T.StructField(w[0], _TYPES[w[1] if len(w) > 1 else "string"]) for w in words])


BATCHES = _schema("version:long batch_id")
TABLES = {
    "members": _schema(" ".join(["rec_id", *STAGED_COLUMNS, *[f"n_{a}" for a in ATTRIBUTES], "entity_id", "_deleted:boolean"])),
    "golden": _schema("entity_id entity_type first_name last_name email phone company_name confidence_score:double "
                      "source_name created_at:timestamp _deleted:boolean"),
    "entity_event": _schema("event entity_id other_entity_id source_system source_id cause weight:double"),
    "results": _schema("source_system external_id entity_id is_new:boolean matched_source confidence:double").add(
        "canonical_data", _schema(" ".join(ATTRIBUTES))),
    "errors": _schema("source_system external_id error"),
    "params": _schema("field m:double u:double match_rate:double iteration:int"),
    "override": _schema("kind left_id right_id _deleted:boolean"),
    "lock": _schema("entity_id _deleted:boolean"),
}


@dataclass(frozen=True)
class Snapshot:
    """The tables as of one version."""

    store: "GraphStore"
    version: int

    def rows(self, name: str) -> DataFrame:
        """The last row of every key with the version that wrote it, deleted ones included; all rows of a table without keys."""
        schema = T.StructType(TABLES[name].fields + [T.StructField("version", T.LongType())])
        # A constant bound on the partition column: later folders are not read.
        rows = self.store.spark.read.schema(schema).parquet(f"{self.store.path}/{name}").where(F.col("version") <= self.version)
        return last_per_key(rows, KEYS[name], "version").withColumnRenamed("version", "updated_version") if name in KEYS else rows

    def read(self, name: str) -> DataFrame:
        """A table without deleted rows; `updated_version` is the version of a row's last change."""
        return self.rows(name).where(~F.col("_deleted")).drop("_deleted") if name in KEYS else self.rows(name)


@dataclass(frozen=True)
class GraphStore:
    """Tables of one identity graph below a path that all executors can reach. One writer at a time."""

    spark: SparkSession
    path: str

    def create(self) -> "GraphStore":
        self._write(0, "create", {name: self.spark.createDataFrame([], schema) for name, schema in TABLES.items()})
        return self

    def status(self, batch_id: str | None = None) -> tuple[Snapshot, bool]:
        """The last version, and whether a batch is stored."""
        row = self.spark.read.schema(BATCHES).parquet(f"{self.path}/batches").agg(
            F.max("version").alias("version"), F.max(F.col("batch_id").eqNullSafe(F.lit(batch_id))).alias("known")).first()
        return Snapshot(self, row["version"]), row["known"]

    def snapshot(self, version: int | None = None) -> Snapshot:
        return self.status()[0] if version is None else Snapshot(self, version)

    def version(self) -> int:
        return self.snapshot().version

    def has_batch(self, batch_id: str) -> bool:
        return self.status(batch_id)[1]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.snapshot(version).read(name)

    def write(self, batch_id: str, tables: dict[str, DataFrame]) -> int:
        """Store changed rows as the next version. A repeated batch id writes nothing; an interrupted batch is written anew."""
        now, known = self.status(batch_id)
        return now.version if known else self._write(now.version + 1, batch_id, tables)

    def crosswalk(self, version: int | None = None) -> DataFrame:
        return self.read("members", version).select(
            "source_system", F.col("external_id").alias("source_id"), "entity_id", "updated_version")

    def export_since(self, name: str, version: int) -> DataFrame:
        """Rows of a keyed table that changed after a version; `removed` marks those that are gone since then."""
        rows = self.snapshot().rows(name).where(F.col("updated_version") > version)
        return rows.withColumnRenamed("_deleted", "removed")

    def replace(self, batch_id: str, tables: dict[str, DataFrame], other: dict[str, DataFrame]) -> int:
        """Make the given rows the whole content of keyed tables; `other` is added to tables without a key.

        Only what differs is written: rows that did not change keep their version, rows that are gone are marked as deleted.
        """
        now, known = self.status(batch_id)
        if known:
            return now.version
        return self.write(batch_id, {name: changed_rows(now.read(name), new, KEYS[name], TABLES[name].fieldNames())
                                     for name, new in tables.items()} | other)

    def _write(self, version: int, batch_id: str, tables: dict[str, DataFrame]) -> int:
        for name, df in tables.items():
            if name in KEYS and "_deleted" not in df.columns:
                df = df.withColumn("_deleted", F.lit(False))
            df.select(*TABLES[name].fieldNames()).write.mode("overwrite").parquet(f"{self.path}/{name}/version={version}")
        batch = self.spark.createDataFrame([(version, batch_id)], BATCHES)
        batch.coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        return version


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows of `new` that `old` has not, and the rows of keys that only `old` has, marked as deleted."""
    data = [c for c in columns if c != "_deleted"]
    both = old.select(*keys, F.struct(*data).alias("_old")).join(new.select(*keys, F.struct(*data).alias("_new")), keys, "full")
    return (both.where(~F.col("_old").eqNullSafe(F.col("_new")))
            .select(F.coalesce("_new", "_old").alias("_row"), F.col("_new").isNull().alias("_deleted")).select("_row.*", "_deleted"))
