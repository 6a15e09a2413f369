"""The seed records: pairs, clusters, golden records, and the six incremental cases."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from personweave.operators.normalize import collapse_profiles, prepare_records
from personweave.operators.pairs import scored_pairs
from personweave.operators.score import decide
from personweave.operators.staging import stage_all
from personweave.plans.batch import reconcile
from personweave.sources.state import GraphStore
from personweave.spec import realtime_spec
from personweave.streaming.incremental import Graph, resolve_batch, resolve_summary
from personweave.streaming.stream import load_graph, resolve_changes, resolve_stream, seed, stored_spec
from personweave.sources.files import read_changes
from tests.seed import CASES, change_rows, raw_seed

AS_OF = "2025-01-01"


def strict_spec():
    spec = realtime_spec()
    return replace(spec, fields=tuple(replace(f, threshold=0.92) for f in spec.fields))


@pytest.fixture(scope="module")
def resolution(spark):
    return reconcile(stage_all(raw_seed(spark)), strict_spec(), AS_OF, trained=False)


def test_pairs(spark):
    spec = strict_spec()
    profiles = collapse_profiles(prepare_records(stage_all(raw_seed(spark)), spec), spec)
    pairs = decide(scored_pairs(profiles.drop("profile_key"), spec, -100.0), spec)
    short = lambda c: F.substr(F.split_part(c, F.lit(":"), F.lit(2)), F.lit(1))
    found = {tuple(sorted((r.l, r.r))): (round(r.weight, 2), r.decision) for r in pairs.select(
        short("left_id").alias("l"), short("right_id").alias("r"), "weight", "decision").collect()}
    # C002 and B002 have the same values, so they are one profile, listed under its smallest id B002.
    assert found == {
        ("B001", "C001"): (6.23, "review"), ("C001", "S001"): (29.66, "match"), ("B002", "S002"): (14.87, "match"),
        ("B003", "C003"): (6.23, "review"), ("C003", "S003"): (40.44, "match"), ("B003", "S003"): (0.91, "reject"),
        ("B004", "C004"): (6.23, "review"), ("C004", "S004"): (34.65, "match"), ("B004", "S004"): (6.23, "review"),
        ("C005", "S005"): (6.23, "review"), ("B005", "C006"): (6.23, "review"), ("B006", "C007"): (34.65, "match"),
        ("C008", "S006"): (45.77, "match"),
    }


def test_clusters(resolution):
    groups = resolution.members.groupBy("entity_id").agg(F.sort_array(F.collect_list("external_id")).alias("g"))
    assert sorted(r.g for r in groups.collect()) == [
        ["B001"], ["B002", "C002", "S002"], ["B003"], ["B004"], ["B005"], ["B006", "C007"], ["C001", "S001"],
        ["C003", "S003"], ["C004", "S004"], ["C005"], ["C006"], ["C008", "S006"], ["S005"]]


def test_golden(resolution):
    rows = {r.email: r for r in resolution.golden.collect()}
    alice = rows["alice@company.com"]
    assert (alice.first_name, alice.last_name, alice.phone, alice.source_name) == ("Alice", "Johnson", "5558889999", "crm_contacts")
    assert rows["bob@work.com"].confidence_score == 1.0
    henry = rows["henry@mail.com"]
    assert henry.company_name == "Summit LLC" and 0.99 < henry.confidence_score <= 1.0


def _outcome(result):
    return {r.external_id: r for r in result.results.collect()}


def test_six_cases_in_one_batch(spark, resolution):
    graph = Graph(resolution.members, resolution.golden)
    result = resolve_batch(change_rows(spark, CASES), graph, strict_spec(), AS_OF)
    rows = _outcome(result)
    entity = {r.external_id: r.entity_id for r in resolution.members.collect()}
    assert rows["NEW_CRM_001"].entity_id == entity["C001"] and not rows["NEW_CRM_001"].is_new
    assert rows["NEW_BILL_001"].entity_id == entity["C003"] and rows["NEW_BILL_001"].matched_source == "crm_contacts"
    assert rows["NEW_CRM_002"].is_new and rows["NEW_SUP_001"].is_new and rows["NEW_BILL_002"].is_new
    assert len({r.entity_id for r in rows.values()}) == 5
    summary = resolve_summary(result.results, result.errors).first()
    assert tuple(summary) == (5, 3, 2, 0)


def test_six_cases_one_by_one_in_a_store(spark, resolution, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graph")).create()
    assert seed(store, resolution) == 1
    for i, case in enumerate(CASES):
        resolve_changes(store, change_rows(spark, [case], first=i + 1), strict_spec(), f"case-{i}", AS_OF)
    assert store.version() == 7
    results = store.read("results").orderBy("version").collect()
    assert [r.is_new for r in results] == [False, False, True, True, False, True]
    assert results[2].entity_id == results[4].entity_id != results[5].entity_id
    assert results[4].confidence == 1.0 and results[4].matched_source == "crm_contacts"
    # The same batch again changes nothing, and earlier versions stay readable.
    assert resolve_changes(store, change_rows(spark, CASES[:1]), strict_spec(), "case-0", AS_OF) == 7
    assert store.read("members").count() == 25 and store.read("members", 1).count() == 20
    assert store.export_since("members", 5).count() == 2


def test_stream_restart(spark, resolution, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graph")).create()
    seed(store, resolution)
    assert [(f.m, f.u) for f in stored_spec(store, realtime_spec()).fields] == [(f.m, f.u) for f in strict_spec().fields]
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")

    def run():
        resolve_stream(read_changes(spark, inbox), store, strict_spec(), checkpoint, AS_OF).awaitTermination()

    change_rows(spark, CASES[:3]).coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert store.read("members").count() == 23
    run()
    version = store.version()
    assert version == 2
    change_rows(spark, CASES[3:], first=4).coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert store.read("members").count() == 25 and store.version() == 3
    graph = load_graph(store)
    assert graph.golden.count() == 16
