"""Cause and weight of events: scores, manual decisions, full loads and reverts."""

from personweave.operators.graph import entity_history, with_cause
from personweave.plans.batch import reconcile
from personweave.spec import batch_spec
from personweave.sources.state import GraphStore
from personweave.streaming.stream import resolve_changes, revert, seed, set_overrides
from tests.seed import change_rows, staged

AS_OF = "2025-01-01"
ROWS = [("1", "crm_contacts", "ann@x.org", "555-010-2000", "Ann", "Lee", None),
        ("2", "crm_contacts", "bob@y.org", "555-010-3000", "Bob", "Ray", None)]


def happened(store, version):
    rows = store.read("entity_event").where(f"version = {version}").collect()
    return {(r.event, r.source_id, r.cause, None if r.weight is None else round(r.weight, 3)) for r in rows}


def test_every_step_names_its_cause(spark, tmp_path):
    spec, store = batch_spec(), GraphStore(spark, str(tmp_path / "graph")).create()
    first = seed(store, reconcile(staged(spark, ROWS), spec, AS_OF, trained=False))
    assert {c for _, _, c, _ in happened(store, first)} == {"replace"}

    # One new record matches, one is alone.
    batch = change_rows(spark, [("9", "support_users", "ann@x.org", None, "Ann", "Lee", None),
                                ("8", "support_users", "eve@z.org", "555-010-4000", "Eve", "Kay", None)])
    second = resolve_changes(store, batch, spec, "b1", AS_OF)
    by_name = {f.name: f for f in spec.fields}
    weight = sum(by_name[n].agree for n in ("email", "first_name", "last_name"))
    assert happened(store, second) == {("linked", "9", "scored", round(weight, 3)), ("linked", "8", "change", None),
                                       ("created", None, "change", None)}

    pair = spark.createDataFrame([("merge", "crm_contacts:1", "crm_contacts:2")], "kind string, left_id string, right_id string")
    third = set_overrides(store, pair, spec, "o1", AS_OF)
    assert happened(store, third) and {c for _, _, c, _ in happened(store, third)} == {"override"}
    fourth = revert(store, second)
    assert {c for _, _, c, _ in happened(store, fourth)} == {"revert"}


def test_a_manual_link_of_a_later_batch_is_an_override(spark, tmp_path):
    spec, store = batch_spec(), GraphStore(spark, str(tmp_path / "graph")).create()
    seed(store, reconcile(staged(spark, ROWS), spec, AS_OF, trained=False))
    pair = spark.createDataFrame([("merge", "crm_contacts:1", "support_users:7")], "kind string, left_id string, right_id string")
    set_overrides(store, pair, spec, "o1", AS_OF)
    batch = change_rows(spark, [("7", "support_users", "zoe@q.org", None, "Zoe", "Fox", None)])
    version = resolve_changes(store, batch, spec, "b1", AS_OF)
    assert happened(store, version) == {("linked", "7", "override", None)}


def test_events_without_evidence_keep_the_cause(spark):
    schema = "source_system string, source_id string, entity_id string"
    before = spark.createDataFrame([("s", "1", "A"), ("s", "2", "B")], schema)
    after = spark.createDataFrame([("s", "1", "A"), ("s", "2", "A"), ("s", "3", "C")], schema)
    why = spark.createDataFrame([("B", "scored", 13.5)], "entity_id string, cause string, weight double")
    found = with_cause(entity_history(before, after, 2), "change", None, why).collect()
    assert {(r.event, r.cause, r.weight) for r in found} == {
        ("moved", "scored", 13.5), ("merged", "scored", 13.5), ("linked", "change", None), ("created", "change", None)}
    assert with_cause(entity_history(before, before, 2), "change", None, why).count() == 0
