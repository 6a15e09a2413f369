"""Continuous resolution: a change stream resolved into the stored identity graph."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from personweave.operators.graph import entity_history, with_cause
from personweave.operators.upsert import last_per_key
from personweave.plans.batch import Resolution
from personweave.plans.report import Watch
from personweave.sources.scratch import scratch_table
from personweave.sources.state import TABLES, GraphStore, Snapshot
from personweave.spec import IdentitySpec
from personweave.streaming.incremental import BatchResult, Graph, override_entities, resolve_batch


def load_graph(store: GraphStore, now: Snapshot | None = None) -> Graph:
    now = now or store.snapshot()
    return Graph(now.read("members"), now.read("golden"), now.read("lock").select("entity_id"),
                 now.read("override").select("kind", "left_id", "right_id"))


def _links(members: DataFrame) -> DataFrame:
    return members.select("source_system", F.col("external_id").alias("source_id"), "entity_id")


def seed(store: GraphStore, resolution: Resolution, run_id: str | None = None) -> int:
    """Make a batch result the content of the graph; what it had before and the result has not is removed.

    A run id that was stored before writes nothing. The events are the difference to what was stored.
    """
    batch_id, now = f"seed-{run_id or uuid.uuid4().hex}", store.snapshot()
    events = with_cause(entity_history(_links(now.read("members")), _links(resolution.members), now.version + 1), "replace")
    parameters = store.spark.createDataFrame(
        [(f.name, f.m, f.u, None, None) for f in resolution.spec.fields], TABLES["params"])
    return store.replace(batch_id, {"members": resolution.members, "golden": resolution.golden},
                         {"entity_event": events, "params": parameters})


def revert(store: GraphStore, version: int) -> int:
    """Bring the members and golden records of an earlier version back as a new one; the step is in the history."""
    now, then = store.snapshot(), store.snapshot(version)
    members, golden = then.read("members"), then.read("golden")
    events = with_cause(entity_history(_links(now.read("members")), _links(members), now.version + 1), "revert")
    return store.replace(f"revert-{version}-{uuid.uuid4().hex}", {"members": members, "golden": golden}, {"entity_event": events})


def stored_spec(store: GraphStore, spec: IdentitySpec) -> IdentitySpec:
    """The spec with the m and u of the batch run that seeded the graph; the stream never trains again."""
    last = last_per_key(store.read("params"), ["field"], "version")
    return spec.with_parameters({r["field"]: (r["m"], r["u"]) for r in last.collect()})


def save(store: GraphStore, batch_id: str, result: BatchResult, now: Snapshot | None = None, watch: Watch | None = None) -> int:
    """Write one batch's changed rows as a new version; a `watch` counts results and errors as they are written."""
    def marked(df: DataFrame, deleted: bool) -> DataFrame:
        return df.withColumn("_deleted", F.lit(deleted))

    ended = (now or store.snapshot()).read("golden").join(result.ended, "entity_id", "left_semi").drop("updated_version")
    golden = result.golden.join(result.ended, "entity_id", "left_anti")
    results, errors = result.results, result.errors
    if watch is not None:
        results, errors = watch("results", results, new=F.count(F.when(F.col("is_new"), 1))), watch("errors", errors)
    return store.write(batch_id, {
        "members": marked(result.members, False).unionByName(marked(result.removed, True)),
        "golden": marked(golden, False).unionByName(marked(ended, True)),
        "entity_event": result.events, "results": results, "errors": errors})


def resolve_changes(store: GraphStore, changes: DataFrame, spec: IdentitySpec, batch_id: str, as_of: str,
                    tombstone: bool = False, watch: Watch | None = None) -> int:
    """Resolve one batch and store it. Nothing happens, and nothing is counted, for an empty batch or one that is already stored."""
    now, known = store.status(batch_id)
    if known or changes.isEmpty():
        return now.version
    result = resolve_batch(changes, load_graph(store, now), spec, as_of, now.version + 1, tombstone=tombstone)
    return save(store, batch_id, result, now, watch)


def set_locks(store: GraphStore, entity_ids: DataFrame, batch_id: str, locked: bool = True) -> int:
    """Lock entities, or lift their locks."""
    return store.write(batch_id, {"lock": entity_ids.select("entity_id").distinct().withColumn("_deleted", F.lit(not locked))})


def set_overrides(store: GraphStore, overrides: DataFrame, spec: IdentitySpec, batch_id: str, as_of: str) -> int:
    """Store manual decisions (`kind`, `left_id`, `right_id`) and apply them to the entities that hold their records.

    Later batches respect them. Later decisions on a pair replace earlier ones.
    """
    now, known = store.status(batch_id)
    if known:
        return now.version
    pair = (F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id"))
    decisions = scratch_table(overrides.groupBy(*pair).agg(F.max("kind").alias("kind")).select("kind", "left_id", "right_id"), "overrides")
    result = override_entities(load_graph(store, now), decisions, spec, as_of, now.version + 1)
    ended = now.read("golden").join(result.ended, "entity_id", "left_semi").drop("updated_version").withColumn("_deleted", F.lit(True))
    return store.write(batch_id, {
        "override": decisions, "members": result.members, "entity_event": result.events,
        "golden": result.golden.withColumn("_deleted", F.lit(False)).unionByName(ended)})


def resolve_stream(changes: DataFrame, store: GraphStore, spec: IdentitySpec, checkpoint: str, as_of: str,
                   interval: str | None = None, tombstone: bool = False) -> StreamingQuery:
    """Start the query. Without an interval it takes all available changes and stops.

    The offset advances only after a batch is committed to the store, and a batch that was committed just before a
    failure is recognised by its id and skipped. The id names the query, which the checkpoint keeps: several streams and
    new checkpoints don't mix.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        query = store.spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        resolve_changes(store, df, spec, f"stream-{query}-{batch_id}", as_of, tombstone)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
