"""The stored graph: nothing is lost by a second load, a second stream, deletes, overrides or a revert."""

import pytest
from pyspark.sql import functions as F

from personweave.operators.graph import absorbed, follow_merges
from personweave.plans.batch import reconcile
from personweave.sources.files import read_changes
from personweave.sources.state import GraphStore
from personweave.spec import realtime_spec
from personweave.streaming.incremental import Graph, resolve_batch
from personweave.streaming.stream import load_graph, resolve_changes, resolve_stream, revert, seed, set_locks, set_overrides
from tests.seed import change_rows, staged

AS_OF = "2025-01-01"
ANN = ("1", "crm_contacts", "a@x.com", "5550001111", "Ann", "Lee", None)
BEA = ("2", "support_users", "b@x.com", "5551112222", "Bea", "Fox", None)
CAT = ("3", "crm_contacts", "c@x.com", "5553334444", "Cat", "Orr", None)


def loaded(spark, rows, spec=None):
    return reconcile(staged(spark, rows), spec or realtime_spec(), AS_OF, trained=False)


@pytest.fixture(scope="module")
def first(spark):
    return loaded(spark, [ANN, BEA])


@pytest.fixture
def store(spark, tmp_path, first):
    found = GraphStore(spark, str(tmp_path / "graph")).create()
    seed(found, first)
    return found


def members(store, version=None):
    return {r.rec_id: r.entity_id for r in store.read("members", version).collect()}


def exported(store, name, version):
    key = "rec_id" if name == "members" else "entity_id"
    return {(r[key], r.removed) for r in store.export_since(name, version).collect()}


def test_second_load_replaces(spark, store):
    before = members(store)
    moved = (*ANN[:4], "Anna", *ANN[5:])
    assert seed(store, loaded(spark, [moved, CAT]), "monday") == 2
    assert sorted(members(store)) == ["crm_contacts:1", "crm_contacts:3"]
    assert exported(store, "members", 1) == {("crm_contacts:1", False), ("crm_contacts:3", False), ("support_users:2", True)}
    events = {(r.event, r.source_id) for r in store.read("entity_event").where("version = 2 and source_id is not null").collect()}
    assert events == {("linked", "3"), ("unlinked", "2")}
    # The same run again writes nothing; an unchanged load changes no row; the first load is still there.
    assert seed(store, loaded(spark, [BEA]), "monday") == 2
    assert seed(store, loaded(spark, [moved, CAT])) == 3 and exported(store, "members", 2) == set()
    assert members(store, 1) == before


def test_second_stream_is_not_skipped(spark, store, tmp_path):
    for name, row in (("one", CAT), ("two", ("4", "crm_contacts", "d@x.com", None, "Dan", "Poe", None))):
        change_rows(spark, [row]).coalesce(1).write.parquet(str(tmp_path / name))
        resolve_stream(read_changes(spark, str(tmp_path / name)), store, realtime_spec(), str(tmp_path / f"{name}-checkpoint"),
                       AS_OF).awaitTermination()
    assert {"crm_contacts:3", "crm_contacts:4"} <= set(members(store))


def test_only_changes_are_written(spark, store):
    """A replacement appends what differs; the rest keeps its version, an interrupted version is not read and is written anew."""
    resolve_changes(store, change_rows(spark, [CAT]), realtime_spec(), "cat", AS_OF)
    before = exported(store, "members", 1), exported(store, "golden", 1)
    assert len(before[0]) == 1
    torn = store.read("members").withColumns({"entity_id": F.lit("torn"), "_deleted": F.lit(False)}).drop("updated_version")
    torn.write.parquet(f"{store.path}/members/version=3")
    assert "torn" not in members(store).values()
    moved = store.read("members").drop("updated_version").withColumn(
        "first_name", F.when(F.col("external_id") == "1", "Anna").otherwise(F.col("first_name")))
    assert store.replace("moved", {"members": moved.where("external_id != '3'")}, {}) == 3
    assert spark.read.parquet(f"{store.path}/members/version=3").count() == 2
    assert exported(store, "members", 2) == {("crm_contacts:1", False), ("crm_contacts:3", True)}
    assert exported(store, "golden", 1) == before[1] and len(members(store, 2)) == 3
    resolve_changes(store, change_rows(spark, [("5", "crm_contacts", "e@x.com", None, "Eve", "Roy", None)], first=9), realtime_spec(), "eve", AS_OF)
    assert len(members(store)) == 3


@pytest.mark.parametrize("tombstone,left", [(True, 2), (False, 3)])
def test_last_action_of_a_record(spark, store, tombstone, left):
    changes = change_rows(spark, [CAT]).unionByName(change_rows(spark, [CAT], first=2, action="DELETE"))
    resolve_changes(store, changes, realtime_spec(), "both", AS_OF, tombstone=tombstone)
    assert len(members(store)) == left


def test_delete_then_insert_keeps_the_record(spark, store):
    changes = change_rows(spark, [ANN], action="DELETE").unionByName(change_rows(spark, [(*ANN[:4], "Anna", *ANN[5:])], first=1))
    resolve_changes(store, changes, realtime_spec(), "update", AS_OF, tombstone=True)
    assert store.read("members").where("rec_id = 'crm_contacts:1'").first().first_name == "Anna"
    gone = change_rows(spark, [ANN], first=5, action="DELETE")
    resolve_changes(store, gone, realtime_spec(), "gone", AS_OF, tombstone=True)
    assert sorted(members(store)) == ["support_users:2"]
    assert exported(store, "golden", 2) >= {(r, True) for r in {x for x, y in exported(store, "golden", 0) if y}}


def test_new_records_meet_updated_values(spark, store):
    """One batch gives a known record new contact data and brings a new record with the same."""
    entity = members(store)["crm_contacts:1"]
    changes = change_rows(spark, [("1", "crm_contacts", "new@x.com", "5559998888", "Ann", "Lee", None),
                                  ("8", "support_users", "new@x.com", "5559998888", "Ann", "Lee", None)])
    resolve_changes(store, changes, realtime_spec(), "batch", AS_OF)
    assert members(store)["support_users:8"] == entity


def test_merge_chains_are_followed(spark):
    events = spark.createDataFrame(
        [(1, "merged", "B", "A"), (2, "merged", "C", "B"), (3, "merged", "D", "C"), (3, "merged", "Y", "X"), (4, "created", "Z", None)],
        "version long, event string, entity_id string, other_entity_id string")
    ids = spark.createDataFrame([(x,) for x in "ABCDXZ"], "entity_id string")
    assert {r.asked_id: r.entity_id for r in follow_merges(ids, events).collect()} == {
        "A": "D", "B": "D", "C": "D", "D": "D", "X": "Y", "Z": "Z"}
    back = events.unionByName(spark.createDataFrame([(9, "merged", "A", "D")], events.schema))
    assert absorbed(back).count() == 5  # a circle ends


def test_revert_is_stored(spark, store):
    before = members(store)
    resolve_changes(store, change_rows(spark, [CAT]), realtime_spec(), "cat", AS_OF)
    assert revert(store, 1) == 3
    assert members(store) == before and len(members(store, 2)) == 3
    assert store.read("golden").count() == 2
    assert [r.event for r in store.read("entity_event").where("version = 3 and source_id = '3'").collect()] == ["unlinked"]


def test_locks_can_be_lifted(spark, store):
    entity = spark.createDataFrame([(members(store)["crm_contacts:1"],)], "entity_id string")
    change = lambda name, seq: change_rows(spark, [(*ANN[:4], name, *ANN[5:])], first=seq)
    set_locks(store, entity, "lock")
    resolve_changes(store, change("Annabel", 1), realtime_spec(), "one", AS_OF)
    assert "Annabel" not in {r.first_name for r in store.read("golden").collect()}
    set_locks(store, entity, "unlock", locked=False)
    resolve_changes(store, change("Annabel", 2), realtime_spec(), "two", AS_OF)
    assert "Annabel" in {r.first_name for r in store.read("golden").collect()}


def same(store, a, b):
    found = members(store)
    return found[a] == found[b]


def test_overrides_hold_in_the_store(spark, store):
    decide = lambda kind, a, b: spark.createDataFrame([(kind, a, b)], "kind string, left_id string, right_id string")
    spec = realtime_spec()
    copy = ("7", "support_users", *ANN[2:])
    resolve_changes(store, change_rows(spark, [copy]), spec, "copy", AS_OF)
    assert same(store, "crm_contacts:1", "support_users:7")
    set_overrides(store, decide("split", "support_users:7", "crm_contacts:1"), spec, "split", AS_OF)
    assert not same(store, "crm_contacts:1", "support_users:7") and store.read("golden").count() == 3
    # A later batch neither joins them again through an update nor through a third record like both.
    third = ("9", "billing_accounts", *ANN[2:])
    resolve_changes(store, change_rows(spark, [copy, third], first=5), spec, "again", AS_OF)
    assert not same(store, "crm_contacts:1", "support_users:7")
    set_overrides(store, decide("merge", "crm_contacts:1", "support_users:2"), spec, "merge", AS_OF)
    assert same(store, "crm_contacts:1", "support_users:2")
    events = {r.event for r in store.read("entity_event").collect()}
    assert {"merged", "split"} <= events or "moved" in events


def test_overrides_hold_for_new_records(spark, store):
    spec = realtime_spec()
    new, twin = ("7", "support_users", *ANN[2:]), ("8", "billing_accounts", *BEA[2:])
    overrides = spark.createDataFrame([("split", "support_users:7", "crm_contacts:1"), ("merge", "billing_accounts:8", "crm_contacts:1")],
                                      "kind string, left_id string, right_id string")
    graph = load_graph(store)
    found = {r.external_id: r for r in resolve_batch(
        change_rows(spark, [new, twin]), Graph(graph.members, graph.golden, overrides=overrides), spec, AS_OF).results.collect()}
    entity = members(store)
    assert found["7"].is_new and found["7"].entity_id not in entity.values()
    # The second record matches one entity by its data and another by decision: the two become one.
    assert found["8"].entity_id == min(entity["crm_contacts:1"], entity["support_users:2"])


def test_status(spark, store):
    now, known = store.status("nothing")
    assert (now.version, known) == (1, False) and store.has_batch("create")
    assert store.read("golden").where(F.col("updated_version") != 1).isEmpty()
