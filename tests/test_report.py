"""Summaries of runs from counters gathered while they write."""

import pytest
from pyspark.sql import functions as F

from personweave.plans.batch import reconcile
from personweave.plans.report import Watch, batch_counters, nulls, reported
from personweave.sources.state import GraphStore
from personweave.spec import batch_spec
from personweave.streaming.stream import resolve_changes, seed
from tests.seed import change_rows, staged

AS_OF = "2025-01-01"
ROWS = [("1", "crm_contacts", "ann@x.org", "555-010-2000", "Ann", "Lee", None),
        ("2", "support_users", "ann@x.org", "555-010-2000", "Ann", "Lee", None),
        ("3", "crm_contacts", "bob@y.org", "555-010-3000", "Bob", "Ray", None)]


def test_a_run_is_counted_as_it_writes(spark, tmp_path):
    staged(spark, ROWS).write.parquet(str(tmp_path / "staged"))
    table = spark.read.parquet(str(tmp_path / "staged"))
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    read = table.mapInPandas(seen, table.schema)
    run = reported(spark, lambda watch: reconcile(read, batch_spec(), AS_OF, trained=False, watch=watch))
    row = run.summary.first()
    assert (row.status, row.health, row.input_entities, row.canonicals, row.merge_rate, row.error) == ("completed", "healthy", 3, 2, 0.333333, None)
    assert row.ended >= row.started and row.seconds > 0 and run.result.golden.count() == 2
    assert reads.value == 3  # the inputs were read once


def test_an_empty_run(spark):
    row = reported(spark, lambda watch: reconcile(staged(spark, ROWS).limit(0), batch_spec(), AS_OF, trained=False, watch=watch)).summary.first()
    assert (row.status, row.health, row.input_entities, row.canonicals, row.merge_rate) == ("completed", "healthy", 0, 0, None)


def test_a_failed_run_shows_as_failed(spark):
    broken = staged(spark, ROWS).withColumn("email", F.when(F.col("external_id") == "3", F.raise_error(F.lit("disk gone"))).otherwise(F.col("email")))
    run = reported(spark, lambda watch: reconcile(broken, batch_spec(), AS_OF, trained=False, watch=watch))
    row = run.summary.first()
    assert run.result is None and row.status == "failed" and "disk gone" in row.error
    assert row.input_entities is None and row.seconds > 0


def test_rows_without_ids_are_unhealthy(spark, tmp_path):
    def job(watch):
        for name, counts in (("input", {}), ("golden", {}), ("crosswalk", {"broken": nulls("source_id", "entity_id")})):
            rows = spark.createDataFrame([("a", "e"), (None, "e")], "source_id string, entity_id string")
            watch(name, rows, **counts).write.parquet(str(tmp_path / name))
    assert reported(spark, job).summary.first().health == "check data"


def test_counters_of_a_batch(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graph")).create()
    seed(store, reconcile(staged(spark, ROWS), batch_spec(), AS_OF, trained=False))
    watch = Watch()
    rows = [("9", "support_users", "bob@y.org", None, "Bob", "Ray", None), ("8", "support_users", "eve@z.org", "555-010-4000", "Eve", "Kay", None),
            ("7", "support_users", None, None, None, None, None)]
    resolve_changes(store, change_rows(spark, rows), batch_spec(), "b1", AS_OF, watch=watch)
    row = batch_counters(spark, watch).first()
    assert (row.total, row.new_entities, row.matched, row.errors) == (3, 1, 1, 1) and row.seconds > 0
    again = Watch()
    resolve_changes(store, change_rows(spark, rows), batch_spec(), "b1", AS_OF, watch=again)
    with pytest.raises(KeyError):
        batch_counters(spark, again)
