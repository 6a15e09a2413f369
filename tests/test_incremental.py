"""Merges, locks, tombstones, order independence and interrupted writes of the incremental job."""

import random

from pyspark.sql import functions as F

from personweave.plans.batch import reconcile
from personweave.sources.state import TABLES, GraphStore
from personweave.spec import realtime_spec
from personweave.streaming.incremental import Graph, resolve_batch
from personweave.streaming.stream import load_graph, resolve_changes, save, seed
from tests.seed import change_rows, staged

AS_OF = "2025-01-01"
TWO = [("1", "crm_contacts", "a@x.com", None, "Ann", "Lee", None), ("2", "support_users", None, "5551112222", "Bea", "Fox", None)]
# Shares the email with one entity and the phone with the other, both far above the merge threshold.
BRIDGE = ("9", "crm_contacts", "a@x.com", "5551112222", None, None, None)


def members(store):
    return {r.rec_id: r.entity_id for r in store.read("members").collect()}


def test_merge_and_tombstone(spark, tmp_path):
    spec = realtime_spec(merge=10.0)
    store = GraphStore(spark, str(tmp_path / "graph")).create()
    seed(store, reconcile(staged(spark, TWO), spec, AS_OF, trained=False))
    before = set(members(store).values())
    assert len(before) == 2
    resolve_changes(store, change_rows(spark, [BRIDGE]), spec, "bridge", AS_OF)
    after = members(store)
    assert len(after) == 3 and set(after.values()) == {min(before)}
    assert [r.entity_id for r in store.read("golden").collect()] == [min(before)]
    merged = store.read("entity_event").where("event = 'merged'").first()
    assert (merged.entity_id, merged.other_entity_id) == (min(before), max(before))
    # A delete is skipped by default and removes the record with tombstones.
    gone = change_rows(spark, [BRIDGE], first=2, action="DELETE")
    resolve_changes(store, gone, spec, "skip", AS_OF)
    assert len(members(store)) == 3
    save(store, "tombstone", resolve_batch(gone, load_graph(store), spec, AS_OF, store.version() + 1, tombstone=True))
    assert sorted(members(store)) == ["crm_contacts:1", "support_users:2"]


def test_locked_entities_do_not_merge_or_change(spark):
    spec = realtime_spec(merge=10.0)
    first = reconcile(staged(spark, TWO), spec, AS_OF, trained=False)
    locked = first.members.where("rec_id = 'crm_contacts:1'").select("entity_id")
    graph = Graph(first.members, first.golden, locked)
    result = resolve_batch(change_rows(spark, [(*BRIDGE[:4], "Annabelle", "Lee", None)]), graph, spec, AS_OF)
    row = result.results.first()
    assert not row.is_new and row.entity_id == locked.first().entity_id
    assert result.ended.count() == 0
    kept = result.golden.where(F.col("entity_id") == row.entity_id).first()
    assert kept.first_name == "Ann"


def test_batch_equals_incremental_without_ambiguity(spark):
    """Persons that share nothing: resolving in one run or in pieces gives the same groups."""
    spec = realtime_spec()
    rng = random.Random(1)
    rows = [(f"{p}-{i}", ["crm_contacts", "support_users", "billing_accounts"][i], f"person{p}@x.com", f"55500{p:05d}",
             f"First{p}", f"Last{p}", None) for p in range(12) for i in range(3)]
    rng.shuffle(rows)
    whole = {r.rec_id: r.entity_id for r in reconcile(staged(spark, rows), spec, AS_OF, trained=False).members.collect()}
    seeded = reconcile(staged(spark, rows[:18]), spec, AS_OF, trained=False)
    result = resolve_batch(change_rows(spark, rows[18:]), Graph(seeded.members, seeded.golden), spec, AS_OF)
    pieces = {r.rec_id: r.entity_id for r in seeded.members.unionByName(result.members, allowMissingColumns=True).collect()}

    def groups(of):
        return sorted(sorted(k for k in of if of[k] == e) for e in set(of.values()))
    assert groups(whole) == groups(pieces) and len(groups(whole)) == 12


def test_interrupted_write_is_never_read(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graph")).create()
    table = spark.createDataFrame([("e1",)], "entity_id string")
    store.write("one", {"lock": table})
    # A crash after writing the folder but before the commit: the rows stay invisible, the retry replaces them.
    spark.createDataFrame([("half", False)], TABLES["lock"]).write.parquet(f"{store.path}/lock/version=2")
    assert [r.entity_id for r in store.read("lock").collect()] == ["e1"]
    store.write("two", {"lock": spark.createDataFrame([("e2",)], "entity_id string")})
    assert sorted(r.entity_id for r in store.read("lock").collect()) == ["e1", "e2"]
