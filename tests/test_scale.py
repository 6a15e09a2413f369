"""What must not depend on block sizes, on long values, or on where a dictionary comes from."""

import random
import time
from dataclasses import replace
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from personweave.functions.similarity import jaro_winkler
from personweave.operators import strongest
from personweave.operators.cluster import separated_components
from personweave.operators.normalize import collapse_profiles, normalize_records, prepare_records
from personweave.operators.train import em_iterate, random_pairs
from personweave.operators.upsert import upsert_crosswalk
from personweave.operators.values import similar_values
from personweave.plans.batch import reconcile
from personweave.spec import ScoreField, batch_spec
from personweave.streaming.incremental import (
    Graph, candidates_vs_graph, entity_candidates, link_or_new, merged_entities, resolve_batch, strongest_candidates,
)
from tests.seed import CASES, change_rows, raw_seed, staged
from tests.test_pairs import COMPANY, FIRST, LAST, records

AS_OF = "2025-01-01"


def loose(threshold):
    spec = batch_spec()
    return replace(spec, fields=tuple(replace(f, threshold=threshold) for f in spec.fields))


def test_block_limit_is_invisible(spark):
    """Members, golden records, and every column of an incremental batch are the same for both limits."""
    rows = records(70, 21)
    new = [(f"N{i}", *r[1:]) for i, r in enumerate(records(25, 22))]

    def run(limit):
        spec = replace(loose(0.65), block_limit=limit)
        first = reconcile(staged(spark, rows), spec, AS_OF, trained=False)
        result = resolve_batch(change_rows(spark, new), Graph(first.members, first.golden), spec, AS_OF, 2)
        return [sorted(map(str, df.collect())) for df in (
            first.members.select("rec_id", "entity_id"), first.golden,
            result.results.withColumn("confidence", F.round("confidence", 9)), result.events)]

    assert run(3) == run(256)


def test_agreement_never_counts_against_a_match():
    with pytest.raises(ValueError, match="u <= m"):
        ScoreField("email", "exact", 2.0, 0.02, 0.9, "email")
    with pytest.raises(ValueError, match="threshold"):
        ScoreField("last_name", "jaro_winkler", 1.0, 0.9, 0.1, "name", threshold=0.2)
    # Training that would fit m below u stops at u.
    m, _ = em_iterate([((0,), 90.0), ((1,), 10.0)], [0.9], [0.6], 0.5)
    assert m == [0.6]


def test_long_values_are_compared_fast():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(1, 15))) for _ in range(4000)]
    left, right = np.array([*words[:2000], "xy" * 2500], object), np.array([*words[2000:], "xy" * 2500 + "z"], object)
    start = time.perf_counter()
    out = jaro_winkler(left, right)
    assert time.perf_counter() - start < 2 and out[-1] > 0.99


def test_long_values_equal_duckdb():
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(4)
    pairs = [tuple("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90))) for _ in range(2)) for _ in range(600)]
    pairs += [(a, a[:20] + "z" + a[21:]) for a, _ in pairs[:100]]
    ours = jaro_winkler(np.array([a for a, _ in pairs], object), np.array([b for _, b in pairs], object))
    con = duckdb.connect()
    con.execute("create table p(i int, a varchar, b varchar)")
    con.executemany("insert into p values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    theirs = [x for (x,) in con.execute("select jaro_winkler_similarity(a, b) from p order by i").fetchall()]
    assert np.allclose(ours, theirs, atol=1e-9)


@pytest.mark.parametrize("threshold", [0.5, 0.65, 0.75])
def test_similar_values_with_low_thresholds(spark, threshold):
    words = sorted(set(FIRST + LAST + COMPANY))
    found = {(r.v, r.w) for r in similar_values(spark.createDataFrame([("x", w) for w in words], "field string, value string"), threshold).collect()}
    pairs = list(combinations(words, 2))
    scores = jaro_winkler(np.array([a for a, _ in pairs], object), np.array([b for _, b in pairs], object))
    assert found == {p for p, s in zip(pairs, scores) if s >= threshold}


def test_nicknames_from_a_table(spark):
    spec = batch_spec()
    df = staged(spark, [("1", "s", None, None, "Bob", "x", None), ("2", "s", None, None, "Zed", "x", None)])
    table = spark.createDataFrame([("zed", "zedekiah")], "alias string, formal string")
    assert sorted(r.n_first_name for r in normalize_records(df, spec.fields, table).collect()) == ["bob", "zedekiah"]


def test_random_share_is_exact(spark):
    """Shares far below a millionth still draw; what is drawn follows the bound."""
    spec = batch_spec()
    profiles = collapse_profiles(prepare_records(staged(spark, [(f"R{i}", "crm_contacts", f"p{i}@x.com", None, None, None, None)
                                                                for i in range(4000)]), spec), spec).cache()
    for most in (100, 1000, 4000):
        assert 0.5 * most < random_pairs(profiles, spec, most).count() <= 1.3 * most


def test_splits_separate_copies_and_chains(spark):
    """Copies of one profile, and two ends that hang together only through others."""
    copies = [(f"{i}", "crm_contacts", "a@x.com", "5550001111", "Ann", "Lee", None) for i in range(4)]
    chain = [("c1", "crm_contacts", "p@x.com", "5552220000", None, None, None), ("c2", "crm_contacts", "p@x.com", "5553330000", None, None, None),
             ("c3", "crm_contacts", None, "5553330000", None, None, None)]
    splits = [("crm_contacts:1", "crm_contacts:2"), ("crm_contacts:c1", "crm_contacts:c3")]
    overrides = spark.createDataFrame([("split", *s) for s in splits], "kind string, left_id string, right_id string")

    def entities(**settings):
        members = reconcile(staged(spark, copies + chain), batch_spec(match=7.5), AS_OF, trained=False, **settings).members
        return {r.rec_id: r.entity_id for r in members.collect()}

    together, divided = entities(), entities(overrides=overrides)
    assert all(together[a] == together[b] for a, b in splits)
    assert all(divided[a] != divided[b] for a, b in splits)
    # Nobody else leaves: every other record stays with one of the two ends.
    assert len(set(divided.values())) == 4 and len({divided[f"crm_contacts:{i}"] for i in range(4)}) == 2


def test_separated_components_against_brute_force(spark):
    rng = random.Random(6)
    for n in (16,):
        edges = [(a, b, float(rng.randrange(1, 9))) for a, b in combinations(range(n), 2) if rng.random() < 0.2]
        splits = [tuple(rng.sample(range(n), 2)) for _ in range(5)]
        frame = lambda rows, names: spark.createDataFrame([tuple(f"v{x:02d}" if isinstance(x, int) else x for x in r) for r in rows], names)
        vertices = spark.createDataFrame([(f"v{i:02d}",) for i in range(n)], "rec_id string")
        found = {r.rec_id: r.component for r in separated_components(
            vertices, frame(edges, "left_id string, right_id string, weight double"), frame(splits, "left_id string, right_id string")).collect()}
        assert len(found) == n and all(found[f"v{a:02d}"] != found[f"v{b:02d}"] for a, b in splits)
        # Each component is connected by edges within it, and named after its smallest vertex.
        for name in set(found.values()):
            group = {int(v[1:]) for v, c in found.items() if c == name}
            seen, queue = {min(group)}, [min(group)]
            while queue:
                x = queue.pop()
                for a, b, _ in edges:
                    if x in (a, b) and {a, b} <= group and not {a, b} <= seen and (a, b) not in splits and (b, a) not in splits:
                        queue += [y for y in (a, b) if y not in seen]
                        seen |= {a, b}
            assert seen == group and name == f"v{min(group):02d}"


def test_incoming_duplicates_of_an_upsert(spark):
    schema = "source_system string, source_id string, entity_id string"
    old = spark.createDataFrame([("s", "1", "a")], schema)
    new = spark.createDataFrame([("s", "1", "b"), ("s", "1", "c"), ("s", "2", "d"), ("s", "2", "d")], schema)
    assert sorted(map(tuple, upsert_crosswalk(old, new).collect())) == [("s", "1", "c"), ("s", "2", "d")]


def test_six_cases_with_the_default_threshold(spark):
    from personweave.operators.staging import stage_all
    from personweave.spec import realtime_spec

    first = reconcile(stage_all(raw_seed(spark)), realtime_spec(), AS_OF, trained=False)
    entity = {r.external_id: r.entity_id for r in first.members.collect()}
    rows = {r.external_id: r for r in resolve_batch(change_rows(spark, CASES), Graph(first.members, first.golden), realtime_spec(), AS_OF).results.collect()}
    assert rows["NEW_CRM_001"].entity_id == entity["C001"] and rows["NEW_BILL_001"].entity_id == entity["C003"]
    assert rows["NEW_CRM_002"].is_new and rows["NEW_SUP_001"].is_new and rows["NEW_BILL_002"].is_new


def test_hot_block_of_the_graph_stays_linear(spark):
    """Many stored entities and new records share a phone: rows grow with the records, not with their pairs."""
    spec = batch_spec(block_limit=16)
    stored = [(f"S{i}", "crm_contacts", None, "5550000000", f"name{i:03d}q", f"last{i:03d}z", None) for i in range(300)]
    new = [(f"N{i}", "crm_contacts", None, "5550000000", None, f"new{i:03d}", None) for i in range(300)]
    members = prepare_records(staged(spark, stored), spec, "incremental").withColumn("entity_id", F.col("rec_id"))
    profiles = collapse_profiles(prepare_records(staged(spark, new), spec, "incremental"), spec)
    loose_merge = replace(spec, merge=8.0)
    for settings, most in ((spec, 600), (loose_merge, 1500)):
        found = strongest_candidates(profiles, members, settings).cache()
        assert 300 <= found.count() <= most
        best = link_or_new(found, settings).collect()
        assert len(best) == 300 and {r.entity_id for r in best} == {"crm_contacts:S0"}
    ends = merged_entities(found, loose_merge, None).collect()
    assert len(ends) == 299 and {r.survivor for r in ends} == {"crm_contacts:S0"}


@pytest.mark.parametrize("limit", [3, 256])
@pytest.mark.parametrize("floor,merge", [(4.0, 12.0), (8.0, 8.0)])
def test_deciding_pairs_decide_like_all_pairs(spark, limit, floor, merge):
    spec = batch_spec(block_limit=limit, merge=merge)
    members = prepare_records(staged(spark, records(120, 51)), spec, "incremental").withColumn(
        "entity_id", F.concat(F.lit("E"), F.pmod(F.xxhash64("rec_id"), F.lit(60)).cast("string"))).cache()
    profiles = collapse_profiles(prepare_records(staged(spark, records(60, 52)), spec, "incremental"), spec).cache()

    def decided(**how):
        found = entity_candidates(candidates_vs_graph(profiles, members, spec, floor=floor, **how))
        return sorted((r.left_id, r.decision, r.entity_id, r.matched_id, round(r.weight, 6), r.matched_values) for r in link_or_new(found, spec).collect())

    every = decided()
    assert decided(deciding=True) == every
    assert "merge" in {d for _, d, *_ in every}


def test_deciding_pairs_of_a_hot_block_stay_linear(spark):
    """New records and stored entities with one name: two candidates each, although every pair reaches the floor."""
    spec = batch_spec(block_limit=16)
    stored = [(f"S{i}", "crm_contacts", f"s{i}@x.com", None, "alice", "smith", "acme") for i in range(200)]
    new = [(f"N{i}", "crm_contacts", f"n{i}@x.com", None, "alice", "smith", "acme") for i in range(200)]
    members = prepare_records(staged(spark, stored), spec, "incremental").withColumn("entity_id", F.col("rec_id"))
    profiles = collapse_profiles(prepare_records(staged(spark, new), spec, "incremental"), spec)
    found = candidates_vs_graph(profiles, members, spec, floor=4.0, deciding=True)
    assert 200 <= found.count() <= 16 * 200
    best = link_or_new(entity_candidates(found), spec).collect()
    assert len(best) == 200 and {r.decision for r in best} == {"new"}


def test_a_hot_block_keeps_only_rows_times_deciding_sets(spark, monkeypatch):
    """Rows with all five values stand in the block of their name once per set of names and company that makes a match."""
    spec = batch_spec(block_limit=16)
    stored = [(f"S{i}", "crm_contacts", f"s{i}@x.com", f"555{i:07d}", "alice", "smith", "acme") for i in range(60)]
    new = [(f"N{i}", "crm_contacts", f"s{i}@x.com" if i < 20 else None, f"555{i:07d}" if i < 40 else None, "alice", "smith", "acme") for i in range(60)]
    members = prepare_records(staged(spark, stored), spec, "incremental").withColumn("entity_id", F.col("rec_id"))
    profiles = collapse_profiles(prepare_records(staged(spark, new), spec, "incremental"), spec)
    sizes, written = {}, strongest.scratch_table

    def counted(df, name):
        table = written(df, name)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(strongest, "scratch_table", counted)
    best = {r.left_id: r.entity_id for r in link_or_new(strongest_candidates(profiles, members, spec), spec).collect()}
    # Emails and phones decide in their own blocks, names and company in this one.
    assert all(best[f"crm_contacts:N{i}"] == f"crm_contacts:S{i}" for i in range(40))
    assert len(best) == 41 and best["crm_contacts:N40"] == "crm_contacts:S0"  # the other twenty are copies of N40
    assert sizes["stored-groups"] == 4 * 60
