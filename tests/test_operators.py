"""Single operators on small inputs."""

import pytest
from pyspark.sql import functions as F

from personweave import schemas
from personweave.operators import cluster, graph, quality, score, staging, survive, upsert
from personweave.operators.normalize import normalize_records
from personweave.plans import marts
from personweave.sources.files import read_source
from personweave.spec import batch_spec, realtime_spec
from personweave.streaming.incremental import reject_invalid
from tests.seed import staged


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_billing_names(spark):
    df = spark.createDataFrame([
        ("1", " A@B.com ", "smith, john", "Acme "), ("2", "a@b.com", "john van smith", None), ("3", "a@b.com", "prince", None),
        ("4", "a@b.com", None, None), ("5", None, "x, y", None)], "billing_account_id string, email string, account_name string, company_name string")
    assert [(r.external_id, r.email, r.first_name, r.last_name, r.company_name, r.phone)
            for r in staging.stage_billing(df).orderBy("external_id").collect()] == [
        ("1", "a@b.com", "John", "Smith", "Acme", None), ("2", "a@b.com", "John", "Van Smith", None, None),
        ("3", "a@b.com", "Prince", "Prince", None, None), ("4", "a@b.com", None, None, None, None)]


def test_support_phone_without_digits_and_leading_blank(spark):
    df = spark.createDataFrame([("1", None, " jane doe", "n/a", "acme corp"), ("2", None, "x", None, None)],
                               "support_user_id string, email string, display_name string, phone string, company string")
    row = staging.stage_support(df).first()
    assert (row.external_id, row.phone, row.first_name, row.last_name, row.company_name) == ("1", "", "", "Jane Doe", "Acme Corp")
    assert staging.stage_support(df).count() == 1


def test_normalisers(spark):
    spec = batch_spec()
    df = staged(spark, [("1", "s", " Bob+News@X.com", "1 (555) 123-4567", "Bob", " O'Neil-  Smith ", " Acme   Corp "),
                        ("2", "s", "", "n/a", "", "..", None)])
    assert rows(normalize_records(df, spec.fields, spec.nicknames).select(*[f.column for f in spec.fields])) == sorted([
        ("bob@x.com", "5551234567", "robert", "oneil smith", "acme corp"), (None, None, None, None, None)], key=str)


def test_csv_is_read_with_a_fixed_schema(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("crm_company_id,company_name,domain,industry,employee_count,created_at\nC1,Acme,acme.com,Media,10,2022-04-16T00:00:00\n")
    bad.write_text("crm_company_id,company_name,domain,industry,employee_count,created_at\nC1,Acme,acme.com,Media,many,2022-04-16T00:00:00\n")
    assert read_source(spark, str(good), schemas.CRM_COMPANIES).first().employee_count == 10
    with pytest.raises(Exception):
        read_source(spark, str(bad), schemas.CRM_COMPANIES).collect()


def test_classes_and_decisions(spark):
    spec = batch_spec()
    df = spark.createDataFrame([(w,) for w in (-9.0, -5.0, 3.9, 4.0, 7.99, 8.0, 40.0)], "weight double")
    out = score.decide(df.withColumn("confidence", score.confidence(F.col("weight"), spec)), spec).collect()
    assert [r["class"] for r in out] == ["non_match", "unlikely", "unlikely", "possible", "possible", "match", "match"]
    assert [r.decision for r in out] == ["reject", "reject", "reject", "review", "review", "match", "match"]
    assert [round(r.confidence, 3) for r in out] == [0, 0, 0.692, 0.7, 0.899, 0.9, 1.0]


def test_components_of_long_chains_and_hubs(spark):
    chain = [(f"a{i:04d}", f"a{i + 1:04d}") for i in range(300)]
    hub = [("b0500", f"b{i:04d}") for i in range(400)]
    edges = spark.createDataFrame(chain + hub, "left_id string, right_id string")
    nodes = spark.createDataFrame([(x,) for x in sorted({x for e in chain + hub for x in e} | {"c"})], "rec_id string")
    found = {r.rec_id: r.component for r in cluster.connected_components(nodes, edges).collect()}
    assert {found[x] for e in chain for x in e} == {"a0000"} and {found[x] for e in hub for x in e} == {"b0000"}
    assert found["c"] == "c"


def test_overrides(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "left_id string, right_id string")
    overrides = spark.createDataFrame([("split", "c", "b"), ("merge", "d", "a"), ("merge", "x", "y"), ("split", "x", "y")],
                                      "kind string, left_id string, right_id string")
    assert rows(cluster.apply_overrides(edges, overrides)) == [("a", "b"), ("a", "d")]


def test_survivorship(spark):
    spec = realtime_spec()
    df = staged(spark, [
        ("1", "billing_accounts", "long.address@x.com", "111", "Bob", "Smith", "Billing Co"),
        ("2", "crm_contacts", "a@x.com", None, "Robert", "Smith", None),
        ("3", "support_users", " ", "222", "Rob", None, "Support Co")]).withColumn("entity_id", F.lit("e"))
    row = survive.survive(df, spec).first()
    assert (row.email, row.first_name, row.last_name) == ("long.address@x.com", "Robert", "Smith")
    # Support is listed for the phone, billing is not; for the company it is the other way round.
    assert (row.phone, row.company_name, row.source_name) == ("222", "Billing Co", "crm_contacts")


def test_crosswalk_keeps_entities_without_members(spark):
    entities = spark.createDataFrame([("e1",), ("e2",)], "entity_id string")
    members = spark.createDataFrame([("e1", "crm_contacts", "1")], "entity_id string, source_system string, external_id string")
    assert rows(survive.build_crosswalk(entities, members)) == [("", "", "e2"), ("crm_contacts", "1", "e1")]


def test_upserts(spark):
    schema = "entity_id string, email string, confidence_score double, source_name string"
    old = spark.createDataFrame([("a", "old", 0.5, "crm"), ("b", None, 0.6, "crm")], schema)
    new = spark.createDataFrame([("a", None, 0.9, "app"), ("c", "new", 1.0, "app")], schema)
    assert rows(upsert.upsert_golden(old, new)) == [("a", None, 0.9, "crm"), ("b", None, 0.6, "crm"), ("c", "new", 1.0, "app")]
    locks = spark.createDataFrame([("a",)], "entity_id string")
    assert rows(graph.apply_with_locks(new, old, locks))[0] == ("a", "old", 0.5, "crm")


def test_change_capture(spark):
    schema = "k string, v string"
    before = spark.createDataFrame([("same", None), ("gone", "1"), ("changed", "1")], schema)
    after = spark.createDataFrame([("same", None), ("changed", None), ("new", "2")], schema)
    changes = upsert.cdc_diff(before, after, ["k"])
    assert rows(changes) == sorted([("gone", "1", "DELETE", False), ("changed", "1", "DELETE", True),
                                    ("changed", None, "INSERT", True), ("new", "2", "INSERT", False)], key=str)
    assert upsert.cdc_inserts(changes).count() == 2


def test_history_and_revert(spark):
    schema = "source_system string, source_id string, entity_id string"
    v1 = spark.createDataFrame([("s", "1", "A"), ("s", "2", "B"), ("s", "3", "C"), ("s", "4", "C")], schema)
    v2 = spark.createDataFrame([("s", "1", "A"), ("s", "2", "A"), ("s", "3", "C"), ("s", "4", "D"), ("s", "5", "E")], schema)
    first = graph.entity_history(v1.where("false"), v1, 1)
    second = graph.entity_history(v1, v2, 2)
    entity_events = second.where("source_id is null").select("event", "entity_id", "other_entity_id")
    assert rows(entity_events) == sorted([("merged", "A", "B"), ("split", "D", "C"), ("created", "D", None), ("created", "E", None)], key=str)
    events = first.unionByName(second)
    assert rows(graph.crosswalk_as_of(events, 1)) == rows(v1) and rows(graph.crosswalk_as_of(events, 2)) == rows(v2)
    restored, third = graph.revert(events, v2, 1, 3)
    assert rows(restored) == rows(v1)
    assert rows(graph.crosswalk_as_of(events.unionByName(third), 3)) == rows(v1)
    asked = spark.createDataFrame([("B",), ("A",)], "entity_id string")
    assert rows(graph.follow_merges(asked, events)) == [("A", "A"), ("A", "B")]


def test_quality(spark):
    df = staged(spark, [("1", "s", None, "5", "A", "B", None), ("1", "s", "x", None, "A", "B", "C")])
    assert rows(quality.dq_not_null(df, ["email", "first_name"], "t")) == [("t.email not null", 1), ("t.first_name not null", 0)]
    assert rows(quality.dq_unique(df, "external_id")) == [("1", 2)] and quality.dq_unique(df, "email").count() == 0
    problems = quality.check_schema(df.withColumn("phone", F.lit(1)).drop("company_name"), schemas.DECLARED["crm_contacts"], "crm")
    assert rows(problems.select("field", "problem", "rows")) == [("company_name", "missing", None), ("email", "null", 1), ("phone", "type int", None)]
    golden = spark.createDataFrame([("a",)], "entity_id string")
    assert tuple(quality.run_summary(df, golden).first()) == ("completed", "healthy", 2, 1, 0.5)


def test_pair_quality_counts_pairs(spark):
    members = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", "x"), ("4", "y")], "rec_id string, entity_id string")
    truth = spark.createDataFrame([("1", 1), ("2", 1), ("3", 2), ("4", 2)], "rec_id string, person int")
    row = quality.pair_quality(members, truth).first()
    assert (row.true_positives, row.predicted, row.actual, row.f1) == (1, 3, 2, 0.4)


def test_invalid_rows_are_reported(spark):
    df = staged(spark, [("1", "crm_contacts", "a@b", None, None, None, None), ("2", "crm_contacts", " ", None, None, None, None),
                        (None, "crm_contacts", "a@b", None, None, None, None), ("4", "other", "a@b", None, None, None, None)])
    valid, errors = reject_invalid(df, realtime_spec())
    assert valid.count() == 1
    assert sorted(r.error for r in errors.collect()) == ["missing external_id", "no attributes", "unknown source"]


def test_masking_follows_the_schema(spark):
    df = spark.createDataFrame([("C1", "a@b.c", "A", "B", "1", "Acme", None)], schemas.CRM_CONTACTS)
    row = marts.mask_pii(df).first()
    assert row.crm_contact_id == "C1" and row.company_name == "Acme" and len(row.email) == 64 and len(row.phone) == 64


def test_flatten_nested_results(spark):
    df = spark.sql("""select named_struct('id', 'e1', 'entity_type', 'customer', 'confidence_score', 0.9D, 'created_at', timestamp'2025-01-01',
      'canonical_data', named_struct('first_name', 'A', 'last_name', 'B', 'email', 'c', 'phone', null, 'company_name', 'D', 'source_name', 'crm')) entity""")
    row = survive.flatten_entities(df).first()
    assert (row.entity_id, row.first_name, row.source_name, row.phone) == ("e1", "A", "crm", None)


def test_company_enrichment(spark):
    c360 = spark.createDataFrame([("e1", " ACME "), ("e2", None)], "entity_id string, company_name string")
    companies = spark.createDataFrame([("2", "acme", "b.com", "X", 1, None), ("1", "Acme", "a.com", "Y", 2, None)], schemas.CRM_COMPANIES)
    found = {r.entity_id: r.domain for r in marts.with_company(c360, companies).collect()}
    assert found == {"e1": "a.com", "e2": None}
