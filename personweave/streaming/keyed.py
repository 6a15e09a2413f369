"""The identity graph in tables bucketed by key: the cost of a batch follows the batch, not the graph.

Four tables hold the graph: the entity of a record, by record id; the records of a blocking key, by key; the members of
an entity and its golden record, by entity. The keys and ids of a batch lead to entities, and one read of these entities'
buckets feeds known ids, candidates, merges and survivorship. What a batch changes rewrites the buckets touched.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.operators.blocking import block_keys
from personweave.operators.normalize import prepare_records, record_id
from personweave.operators.upsert import cdc_inserts
from personweave.sources.buckets import BucketTable
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec
from personweave.streaming.incremental import BatchResult, Graph, reject_invalid, resolve_batch

STEPS = "batch_id string, step string, number long"


@dataclass(frozen=True)
class KeyedGraph:
    """A graph below a path that all executors can reach; one writer at a time."""

    spark: SparkSession
    path: str
    spec: IdentitySpec
    members_schema: T.StructType
    golden_schema: T.StructType
    buckets: int = 256
    profile: str = "incremental"

    def _table(self, name: str, schema: T.StructType, keys: tuple[str, ...], ids: tuple[str, ...]) -> BucketTable:
        return BucketTable(self.spark, f"{self.path}/{name}", schema, keys, ids, self.buckets)

    @cached_property
    def tables(self) -> dict[str, BucketTable]:
        def text(*names: str) -> T.StructType:
            return T.StructType([T.StructField(n, T.StringType()) for n in names])

        key = ("key_type", "key_value")
        return {"records": self._table("records", text("rec_id", "entity_id"), ("rec_id",), ("rec_id",)),
                "keys": self._table("keys", text(*key, "rec_id", "entity_id"), key, (*key, "rec_id")),
                "members": self._table("members", self.members_schema, ("entity_id",), ("entity_id", "rec_id")),
                "golden": self._table("golden", self.golden_schema, ("entity_id",), ("entity_id",))}

    def _keys(self, members: DataFrame) -> DataFrame:
        fields = [f.column for f in self.spec.fields]
        return block_keys(members.select("rec_id", "entity_id", *fields), self.spec, self.profile).select(
            "key_type", "key_value", "rec_id", "entity_id")

    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: IdentitySpec, members: DataFrame, golden: DataFrame,
               buckets: int = 256, profile: str = "incremental") -> "KeyedGraph":
        """Store the members and golden records of a full run."""
        members = members.drop("updated_version")
        graph = cls(spark, path, spec, members.schema, golden.schema, buckets, profile)
        graph.tables["records"].create(members.select("rec_id", "entity_id"))
        graph.tables["keys"].create(graph._keys(members))
        graph.tables["members"].create(members)
        graph.tables["golden"].create(golden)
        graph._log("create", "applied", 0)
        return graph

    def slice_for(self, changes: DataFrame, locks: DataFrame | None = None, overrides: DataFrame | None = None) -> Graph:
        """The part of the graph that a batch can touch: the entities of its records, and of stored records that share a
        blocking key with one of them or that an override ties to one."""
        valid, _ = reject_invalid(cdc_inserts(changes), self.spec)
        records = prepare_records(valid, self.spec, self.profile)
        keys = scratch_table(block_keys(records, self.spec, self.profile).select("key_type", "key_value").distinct(), "batch-keys")
        ids = changes.select(record_id().alias("rec_id")).distinct()
        if overrides is not None:
            ends = ("left_id", "right_id")
            tied = [overrides.join(ids.withColumnRenamed("rec_id", a), a, "left_semi").select(F.col(b).alias("rec_id"))
                    for a, b in (ends, ends[::-1])]
            ids = ids.unionByName(tied[0]).unionByName(tied[1]).distinct()
        ids = scratch_table(ids, "batch-ids")
        entities = scratch_table(self.tables["keys"].lookup(keys).select("entity_id").unionByName(
            self.tables["records"].lookup(ids).select("entity_id")).distinct(), "batch-entities")
        members = scratch_table(self.tables["members"].lookup(entities), "batch-members")
        return Graph(members, self.tables["golden"].lookup(entities), locks, overrides)

    def _log(self, batch_id: str, step: str, number: int) -> None:
        row = self.spark.createDataFrame([(batch_id, step, number)], STEPS).coalesce(1)
        row.write.mode("append").parquet(f"{self.path}/steps")

    def _steps(self) -> list[tuple[str, str, int]]:
        """The steps of the last batch, and how far it is."""
        steps = self.spark.read.schema(STEPS).parquet(f"{self.path}/steps")
        last = steps.agg(F.max("number")).first()[0]
        return [tuple(r) for r in steps.where(F.col("number") == last).collect()]

    def has_batch(self, batch_id: str) -> bool:
        steps = self.spark.read.schema(STEPS).parquet(f"{self.path}/steps")
        return not steps.where((F.col("batch_id") == batch_id) & (F.col("step") == "applied")).isEmpty()

    def recover(self) -> int:
        """Finish a batch that was interrupted after its changes were written; the number of the last batch."""
        steps = self._steps()
        batch_id, _, number = steps[0]
        if not any(step == "applied" for _, step, _ in steps):
            self._apply(number)
            self._log(batch_id, "applied", number)
        return number

    def resolve(self, changes: DataFrame, batch_id: str, as_of: str, tombstone: bool = False, locks: DataFrame | None = None,
                overrides: DataFrame | None = None) -> BatchResult | None:
        """Resolve a batch and store what it changes; None if the batch is stored already.

        The changes are written beside the tables first and applied then. An interrupted batch is either not known yet,
        and resolved anew when it comes again, or finished from its written changes by `recover`, which comes first.
        """
        number = self.recover() + 1
        if self.has_batch(batch_id):
            return None
        changes = scratch_table(changes, "batch")  # read for keys, for ids, by the resolution and for its errors
        graph = self.slice_for(changes, locks, overrides)
        result = resolve_batch(changes, graph, self.spec, as_of, number, self.profile, tombstone)
        self._prepare(graph, result, number)
        self._log(batch_id, "prepared", number)
        self._apply(number)
        self._log(batch_id, "applied", number)
        return result

    def _prepare(self, graph: Graph, result: BatchResult, number: int) -> None:
        changed = result.members.select("rec_id").unionByName(result.removed.select("rec_id"))
        golden = result.golden.join(result.ended, "entity_id", "left_anti")
        for name, rows in {"old": graph.members.join(changed, "rec_id", "left_semi"), "new": result.members,
                           "removed": result.removed.select("rec_id"), "golden": golden,
                           "ended": result.ended.select("entity_id").distinct(), "events": result.events,
                           "results": result.results, "errors": result.errors}.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/changes/{name}/batch={number}")

    def changes(self, name: str, number: int, schema: T.StructType | str) -> DataFrame:
        """What a batch wrote: `events`, `results`, `errors`, or the rows it replaced, brought and deleted."""
        return self.spark.read.schema(schema).parquet(f"{self.path}/changes/{name}/batch={number}")

    def _apply(self, number: int) -> None:
        old, new = (self.changes(n, number, self.members_schema) for n in ("old", "new"))
        self.tables["records"].merge(new.select("rec_id", "entity_id"), self.changes("removed", number, "rec_id string"))
        self.tables["keys"].merge(self._keys(new), self._keys(old))
        self.tables["members"].merge(new, old)
        self.tables["golden"].merge(self.changes("golden", number, self.golden_schema), self.changes("ended", number, "entity_id string"))

    def crosswalk(self) -> DataFrame:
        return self.tables["members"].read().select("source_system", F.col("external_id").alias("source_id"), "entity_id")

    def golden(self) -> DataFrame:
        return self.tables["golden"].read()
