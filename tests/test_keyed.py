"""Bucketed tables and the graph on them: same results as whole tables, untouched files, interrupted batches."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.plans.batch import reconcile
from personweave.sources import buckets as buckets_module
from personweave.sources.buckets import BucketTable
from personweave.spec import realtime_spec
from personweave.streaming.incremental import Graph, resolve_batch
from personweave.streaming.keyed import KeyedGraph
from tests.seed import change_rows, staged

AS_OF = "2025-01-01"
PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("i", T.LongType()), T.StructField("v", T.StringType())])


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_merges_against_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    table = BucketTable(spark, str(tmp_path / "t"), PAIR, ("k",), ("k", "i"), 8).create(spark.createDataFrame([], PAIR))
    assert table.read().collect() == []
    model = {}
    for step in range(4):
        new = {(rng.randrange(12), rng.randrange(3)): f"{step}-{rng.random():.3f}" for _ in range(rng.randrange(1, 12))}
        gone = [k for k in rng.sample(sorted(model), min(len(model), 5)) if k not in new]
        rows = spark.createDataFrame([(k, i, v) for (k, i), v in new.items()], PAIR)
        table.merge(rows, spark.createDataFrame([(k, i, None) for k, i in gone], PAIR))
        model = {k: v for k, v in model.items() if k not in gone} | new
        assert {(r.k, r.i): r.v for r in table.read().collect()} == model
        wanted = spark.createDataFrame([(k, None, None) for k in (0, 5, 99)], PAIR)
        assert {(r.k, r.i) for r in table.lookup(wanted).collect()} == {x for x in model if x[0] in (0, 5, 99)}
    # Emptied buckets are empty, and doing it again changes nothing.
    rest = spark.createDataFrame([(k, i, None) for k, i in model], PAIR)
    for _ in range(2):
        table.merge(spark.createDataFrame([], PAIR), rest)
        assert table.read().collect() == []


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), PAIR, ("k",), ("k", "i"), 16).create(
        spark.range(2000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("i"), F.lit("a").alias("v")))
    before = files(table.path)
    touched = table.merge(spark.createDataFrame([(7, 0, "b"), (5000, 0, "c")], PAIR))
    after = files(table.path)
    changed = {f.split("bucket=")[1].split("/")[0] for f in before.keys() ^ after.keys()} | {
        f.split("bucket=")[1].split("/")[0] for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed == {str(b) for b in touched} and 1 <= len(touched) <= 2 and table.read().count() == 2001


@pytest.mark.parametrize("size", [500, 5000])
def test_files_read_follow_the_batch(spark, tmp_path, size):
    table = BucketTable(spark, str(tmp_path / "t"), PAIR, ("k",), ("k", "i"), 64).create(
        spark.range(size).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("i"), F.lit("a").alias("v")))
    found = table.lookup(spark.createDataFrame([(1, None, None), (2, None, None)], PAIR))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    read = table.read(table.touched(spark.createDataFrame([(1, None, None), (2, None, None)], PAIR)))
    assert read.select(F.input_file_name()).distinct().count() <= 2 < len(files(table.path))


NAMES = ["Ann", "Bea", "Cid", "Dora", "Ed", "Fay"]
SOURCES = ["crm_contacts", "billing_accounts", "support_users"]


def some_records(rng, n, first=0):
    """Records that share emails, phones and names often enough to be linked and to tie entities together."""
    out = []
    for i in range(first, first + n):
        p = rng.randrange(25)
        out.append((str(i), rng.choice(SOURCES), rng.choice([f"p{p}@x.com", None]), rng.choice([f"555{p:07d}", f"555{(p + 1) % 25:07d}", None]),
                    rng.choice([NAMES[p % 6], None]), rng.choice([f"Name{p}", None]), None))
    return out


def shown(crosswalk, golden):
    fields = ("entity_id", "first_name", "last_name", "email", "phone")
    return (sorted(tuple(r) for r in crosswalk.select("source_system", "source_id", "entity_id").collect()),
            sorted((tuple(r) for r in golden.select(*fields).collect()), key=str))


def whole_graph(spark, first, batches, spec):
    """The same batches against complete tables."""
    members, golden = first.members.drop("updated_version"), first.golden
    for n, (changes, tombstone) in enumerate(batches, 1):
        result = resolve_batch(changes, Graph(members, golden), spec, AS_OF, n, tombstone=tombstone)
        columns = members.columns
        seen = result.members.select("rec_id").unionByName(result.removed.select("rec_id"))
        members = members.join(seen, "rec_id", "left_anti").select(*columns).unionByName(result.members.select(*columns))
        ids = result.golden.select("entity_id").unionByName(result.ended.select("entity_id"))
        golden = golden.join(ids, "entity_id", "left_anti").unionByName(result.golden.join(result.ended, "entity_id", "left_anti").select(*golden.columns))
        members = spark.createDataFrame(members.collect(), members.schema)
        golden = spark.createDataFrame(golden.collect(), golden.schema)
    return shown(members.withColumn("source_id", F.col("external_id")), golden)


@pytest.fixture(scope="module")
def scenario(spark):
    rng, spec = random.Random(11), realtime_spec(merge=10.0)
    records = [r for r in some_records(rng, 60) if any(r[2:6])]
    first = reconcile(staged(spark, records), spec, AS_OF, trained=False)
    one = [r for r in some_records(rng, 20, 100) if any(r[2:6])] + [(*records[3][:2], "moved@x.com", None, "Ann", "Moved", None)]
    gone = change_rows(spark, records[5:9], first=50, action="DELETE")
    two = [r for r in some_records(rng, 10, 200) if any(r[2:6])]
    batches = [(change_rows(spark, one), False), (change_rows(spark, two).unionByName(gone), True)]
    return spec, first, batches, [whole_graph(spark, first, batches[:n], spec) for n in (1, 2)]


def test_same_as_whole_tables(spark, tmp_path, scenario):
    spec, first, batches, want = scenario
    graph = KeyedGraph.create(spark, str(tmp_path / "g"), spec, first.members, first.golden, buckets=8)
    for n, (changes, tombstone) in enumerate(batches):
        assert graph.resolve(changes, f"b{n}", AS_OF, tombstone) is not None
        assert graph.resolve(changes, f"b{n}", AS_OF, tombstone) is None  # a stored batch is skipped
    assert shown(graph.crosswalk(), graph.golden()) == want[1]
    # The derived tables say what the members say.
    members = graph.tables["members"].read()
    assert sorted(map(tuple, graph.tables["records"].read().collect())) == sorted(map(tuple, members.select("rec_id", "entity_id").collect()))
    assert sorted(map(tuple, graph.tables["keys"].read().collect())) == sorted(map(tuple, graph._keys(members).collect()))


class Killed(Exception):
    pass


@pytest.mark.parametrize("cut", [0, 3, 5])
def test_killed_and_restarted(spark, tmp_path, scenario, monkeypatch, cut):
    """Cut before the changes are complete, between two tables, and before the last log entry: ids and counts are equal."""
    spec, first, batches, want = scenario
    path = str(tmp_path / "g")
    graph = KeyedGraph.create(spark, path, spec, first.members, first.golden, buckets=8)
    args = (spark, path, spec, graph.members_schema, graph.golden_schema, 8)
    left = [cut]

    def dying(original):
        def call(*a, **k):
            left[0] -= 1
            if left[0] < 0:
                raise Killed
            return original(*a, **k)
        return call

    with monkeypatch.context() as m:
        m.setattr(buckets_module.BucketTable, "merge", dying(BucketTable.merge))
        m.setattr(KeyedGraph, "_log", dying(KeyedGraph._log))
        with pytest.raises(Killed):
            graph.resolve(batches[0][0], "b0", AS_OF)
    again = KeyedGraph(*args)
    again.resolve(batches[0][0], "b0", AS_OF)
    assert shown(again.crosswalk(), again.golden()) == want[0]


def test_a_batch_is_computed_once(spark, tmp_path, scenario):
    spec, first, batches, want = scenario
    graph = KeyedGraph.create(spark, str(tmp_path / "g"), spec, first.members, first.golden, buckets=8)
    changes = batches[0][0]
    seen = spark.sparkContext.accumulator(0)

    def counted(external_id):
        seen.add(1)
        return external_id

    external_id = F.udf(counted, "string").asNondeterministic()
    graph.resolve(changes.withColumn("external_id", external_id("external_id")), "b0", AS_OF)
    assert shown(graph.crosswalk(), graph.golden()) == want[0]
    assert seen.value == changes.count()
