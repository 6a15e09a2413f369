"""Pairs and clusters against brute force, with ordinary and with oversized blocks."""

import hashlib
import random
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import catalog
from personweave.functions.similarity import jaro_winkler
from personweave.operators import pairs as joins
from personweave.operators import values as vocabulary
from personweave.operators.cluster import connected_components
from personweave.operators.normalize import collapse_profiles, prepare_records
from personweave.operators.pairs import scored_pairs
from personweave.operators.score import best_candidate
from personweave.operators.strongest import strongest_pairs
from personweave.operators.values import similar_values
from personweave.plans.batch import reconcile
from personweave.spec import batch_spec
from tests.seed import staged

FIRST = ["robert", "roberta", "alice", "alicia", "dana", "diana", "frank"]
LAST = ["smith", "smyth", "johnson", "johnston", "brown", "browne", "lee"]
COMPANY = ["acme corp", "acme corpp", "techstart", "tech start", "summit llc", "summit"]


def records(n, seed):
    """Random staged rows; a third of them share one phone, a third one email, and many are copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        def maybe(value, missing=0.25):
            return None if rng.random() < missing else value
        email = "info@shared.com" if rng.random() < 0.34 else f"p{rng.randrange(n)}@x.com"
        phone = "5550000000" if rng.random() < 0.34 else f"555{rng.randrange(n):07d}"
        rows.append((f"R{i:04d}", rng.choice(["crm_contacts", "support_users"]), maybe(email, 0.4), maybe(phone, 0.4),
                     maybe(rng.choice(FIRST)), maybe(rng.choice(LAST)), maybe(rng.choice(COMPANY), 0.4)))
        if rng.random() < 0.2:
            rows.append((f"R{i:04d}copy", *rows[-1][1:]))
    return rows


def weight_of(a, b, spec):
    total = 0.0
    for f, x, y in zip(spec.fields, a, b):
        if x is None or y is None:
            continue
        if f.comparator == "exact":
            same = x == y
        else:
            same = x == y or jaro_winkler(np.array([x], object), np.array([y], object))[0] >= f.threshold
        total += f.agree if same else f.disagree
    return total


def shares_key(a, b, spec, profile):
    index = {f.name: i for i, f in enumerate(spec.fields)}
    if profile == "incremental":
        def keys(r):
            email, phone, first, last, _ = r
            return [email, phone, first[:3] + last if first and last else None]
    else:
        def keys(r):
            return [None if any(r[index[p]] is None for p in parts) else tuple(r[index[p]] for p in parts)
                    for parts in spec.blocking]
    return any(x is not None and x == y for x, y in zip(keys(a), keys(b)))


def collected(profiles, spec):
    return {r.vid: tuple(r[f.column] for f in spec.fields) for r in profiles.collect()}


def groups_of(ids, edges):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("limit,floor,profile,seed", [
    (256, 4.0, "batch", 1), (3, 4.0, "batch", 2), (3, 8.0, "batch", 3), (4, 8.0, "incremental", 4)])
def test_pairs_equal_brute_force(spark, limit, floor, profile, seed):
    spec = batch_spec(block_limit=limit)
    profiles = collapse_profiles(prepare_records(staged(spark, records(90, seed)), spec), spec).cache()
    rows = collected(profiles, spec)
    expected = {(a, b): round(w, 6) for a, b in combinations(sorted(rows), 2)
                if shares_key(rows[a], rows[b], spec, profile) and (w := weight_of(rows[a], rows[b], spec)) >= floor}
    found = scored_pairs(profiles.drop("profile_key"), spec, floor, profile=profile).collect()
    assert len(found) == len({(r.left_id, r.right_id) for r in found})
    assert {(r.left_id, r.right_id): round(r.weight, 6) for r in found} == expected

    # Links connect the same groups, whatever the number of links.
    links = scored_pairs(profiles.drop("profile_key"), spec, floor, profile=profile, links=True)
    pairs = {(r.left_id, r.right_id) for r in links.collect()}
    assert pairs <= set(expected)
    components = connected_components(profiles.select("vid"), links.select("left_id", "right_id"), "vid")
    assert {r.vid: r.component for r in components.collect()} == groups_of(rows, expected)


def test_two_tables_equal_brute_force(spark):
    spec = batch_spec(block_limit=3)
    left = collapse_profiles(prepare_records(staged(spark, records(30, 5)), spec), spec).withColumn("vid", F.concat(F.lit("new:"), "vid")).cache()
    right = collapse_profiles(prepare_records(staged(spark, records(60, 6)), spec), spec).cache()
    a, b = collected(left, spec), collected(right, spec)
    expected = {(x, y): round(w, 6) for x, y in product(a, b)
                if shares_key(a[x], b[y], spec, "incremental") and (w := weight_of(a[x], b[y], spec)) >= 8.0}
    columns = ["vid", "mask", *[f.column for f in spec.fields]]
    found = scored_pairs(left.select(*columns), spec, 8.0, right=right.select(*columns), profile="incremental").collect()
    assert {(r.left_id, r.right_id): round(r.weight, 6) for r in found} == expected
    assert len(found) == len(expected)


def test_oversized_blocks_make_few_links(spark):
    """Everybody shares one phone: links stay far below the number of pairs, the group stays whole."""
    spec = batch_spec(block_limit=16)
    rows = [(f"R{i:04d}", "crm_contacts", None, "5550000000", f"name{i}", None, None) for i in range(400)]
    rows += [(f"Q{i:04d}", "crm_contacts", f"q{i}@x.com", "5550000000", None, None, None) for i in range(400)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    links = scored_pairs(profiles.drop("profile_key"), spec, spec.match, links=True)
    assert links.count() < 4000
    components = connected_components(profiles.select("vid"), links.select("left_id", "right_id"), "vid")
    assert components.select("component").distinct().count() == 1


def test_entities_equal_brute_force(spark):
    """Record by record, copies included: the entities of a batch run are the connected groups of matching pairs."""
    spec = batch_spec(block_limit=5)
    rows = records(110, 15)
    normal = prepare_records(staged(spark, rows), spec)
    values = {r.rec_id: tuple(r[f.column] for f in spec.fields) for r in normal.collect()}
    edges = [(a, b) for a, b in combinations(sorted(values), 2)
             if shares_key(values[a], values[b], spec, "batch") and weight_of(values[a], values[b], spec) >= spec.match]
    expected = groups_of(values, edges)
    found = {r.rec_id: r.entity_id for r in reconcile(staged(spark, rows), spec, "2025-01-01", trained=False).members.collect()}
    assert found == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in expected.items()}


def test_block_limit_does_not_change_entities(spark):
    rows = staged(spark, records(120, 7))
    def run(limit):
        result = reconcile(rows, batch_spec(block_limit=limit), "2025-01-01", trained=False)
        return (sorted(map(tuple, result.members.select("rec_id", "entity_id").collect())),
                sorted(map(str, result.golden.collect())))
    assert run(3) == run(256)


def test_similar_values_equal_brute_force(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(250)} | set(FIRST + LAST + COMPANY)
    values = spark.createDataFrame([("x", w) for w in words], "field string, value string")
    for threshold in (0.88, 0.92):
        found = {(r.v, r.w): round(r.similarity, 9) for r in similar_values(values, threshold).collect()}
        pairs = list(combinations(sorted(words), 2))
        scores = jaro_winkler(np.array([a for a, _ in pairs], object), np.array([b for _, b in pairs], object))
        assert found == {p: round(s, 9) for p, s in zip(pairs, scores) if s >= threshold}


def test_a_frequent_signature_is_cut_into_cells(spark, monkeypatch):
    """Half of all values share their rare letters: groups stay small, and no pair is lost."""
    monkeypatch.setattr(vocabulary, "CELL_ROWS", 10)
    rng = random.Random(3)
    words = {"jqx" + "".join(rng.choice("aeio") for _ in range(3)) for _ in range(150)} | {
        "".join(rng.choice("abcdef") for _ in range(5)) for _ in range(60)} | {"\U0001f600ab", "\U0001f600ac", "a" * 300, "a" * 299 + "b"}
    table = spark.createDataFrame([("x", w) for w in words] + [("x", ""), ("x", None), ("y", "jqxaaa")], "field string, value string")
    keyed = vocabulary.signatures(table.where("value != ''").distinct(), 0.88, sorted({len(w) for w in words})).cache()
    most = keyed.groupBy("field", "signature").count().agg({"count": "max"}).first()[0]
    assert most > 50
    groups = vocabulary.signature_cells(keyed).groupBy("field", "signature", "first", "second").count().agg({"count": "max"}).first()[0]
    assert groups < most and groups <= 4 * 10
    found = {(r.v, r.w) for r in vocabulary.similar_values(table, 0.88).collect()}
    pairs = list(combinations(sorted(words), 2))
    scores = jaro_winkler(np.array([a for a, _ in pairs], object), np.array([b for _, b in pairs], object))
    assert found == {p for p, s in zip(pairs, scores) if s >= 0.88}
    assert similar_values(table.limit(0), 0.88).count() == 0


def test_signatures_are_made_without_python(spark):
    table = spark.createDataFrame([("x", "abc")], "field string, value string")
    plan = vocabulary.signature_cells(vocabulary.signatures(table, 0.88, [3]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


def test_jaro_winkler_equals_duckdb():
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(9)
    alphabet = "abcdef "
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 12))) for _ in range(3000)]
    pairs = list(zip(words[:1500], words[1500:])) + [("martha", "marhta"), ("dixon", "dicksonx"), ("a", "a"), ("ab", "ba")]
    ours = jaro_winkler(np.array([a for a, _ in pairs], object), np.array([b for _, b in pairs], object))
    con = duckdb.connect()
    con.execute("create table p(i int, a varchar, b varchar)")
    con.executemany("insert into p values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    theirs = [x for (x,) in con.execute("select jaro_winkler_similarity(a, b) from p order by i").fetchall()]
    assert np.allclose(ours, theirs, atol=1e-9)


def test_ordinary_blocks_use_one_equi_join(spark):
    spec = batch_spec()
    profiles = collapse_profiles(prepare_records(staged(spark, records(40, 10)), spec), spec)
    plan = scored_pairs(profiles.drop("profile_key"), spec, 4.0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("profile", ["batch", "incremental"])
def test_listing_of_oversized_blocks_needs_no_shuffle_of_pairs(spark, profile):
    """Each pair is made once, however many keys and similar values its sides share."""
    spec = batch_spec(block_limit=4)
    # Names that are similar without being equal: a pair is met on several paths of sub-blocks.
    profiles = collapse_profiles(prepare_records(staged(spark, records(120, 21)), spec), spec).cache()
    rows = collected(profiles, spec)
    found = scored_pairs(profiles.drop("profile_key"), spec, 4.0, profile=profile)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_vid" not in plan and "Deduplicate" not in plan
    pairs = [(r.left_id, r.right_id) for r in found.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a, b in combinations(sorted(rows), 2)
                          if shares_key(rows[a], rows[b], spec, profile) and weight_of(rows[a], rows[b], spec) >= 4.0}


@pytest.mark.parametrize("limit,floor,profile,seed", [(3, 8.0, "batch", 31), (3, 4.0, "batch", 32), (4, 8.0, "incremental", 33), (8, 6.5, "batch", 34)])
def test_spanning_links_connect_the_same_groups_without_repeats(spark, limit, floor, profile, seed):
    spec = batch_spec(block_limit=limit)
    profiles = collapse_profiles(prepare_records(staged(spark, records(100, seed)), spec), spec).cache()
    rows = collected(profiles, spec)
    expected = {(a, b) for a, b in combinations(sorted(rows), 2)
                if shares_key(rows[a], rows[b], spec, profile) and weight_of(rows[a], rows[b], spec) >= floor}
    links = scored_pairs(profiles.drop("profile_key"), spec, floor, profile=profile, spanning=True)
    assert "Aggregate [l_vid" not in links._jdf.queryExecution().optimizedPlan().toString()
    pairs = {(min(r), max(r)) for r in links.select("left_id", "right_id").collect()}
    assert pairs <= expected
    assert groups_of(rows, pairs) == groups_of(rows, expected)


@pytest.mark.parametrize("limit,floor,profile,seed", [(256, 8.0, "batch", 41), (256, 4.0, "incremental", 42), (12, 8.0, "batch", 43)])
def test_hubs_of_ordinary_blocks_connect_the_same_groups(spark, monkeypatch, limit, floor, profile, seed):
    monkeypatch.setattr(joins, "HUB_ROWS", 2)
    spec = batch_spec(block_limit=limit)
    profiles = collapse_profiles(prepare_records(staged(spark, records(100, seed)), spec), spec).cache()
    rows = collected(profiles, spec)
    expected = {(a, b) for a, b in combinations(sorted(rows), 2)
                if shares_key(rows[a], rows[b], spec, profile) and weight_of(rows[a], rows[b], spec) >= floor}
    links = scored_pairs(profiles.drop("profile_key"), spec, floor, profile=profile, spanning=True)
    pairs = {(min(r), max(r)) for r in links.select("left_id", "right_id").collect()}
    assert pairs <= expected and len(pairs) < len(expected)
    assert groups_of(rows, pairs) == groups_of(rows, expected)


def test_blocks_below_the_limit_make_few_links_too(spark):
    """Records of one name match where only one has an email and only one a phone: the links are as many as the records."""
    spec = batch_spec()

    def row(i, first, last, company):
        return (f"{last}{i:03d}", "crm_contacts", f"{last}{i}@x.com" if i % 2 else None, None if i % 2 else f"555{i:07d}", first, last, company)

    # An ordinary block of 200 rows, and an oversized one with two sub-blocks of 225 rows.
    rows = [row(i, "alice", "smith", None) for i in range(200)]
    rows += [row(i, "bertram", "jones", ["acme", "techstart"][i // 225]) for i in range(450)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    links = scored_pairs(profiles.drop("profile_key"), spec, spec.match, spanning=True).cache()
    assert links.count() < 3 * profiles.count()
    components = connected_components(profiles.select("vid"), links.select("left_id", "right_id"), "vid")
    assert components.select("component").distinct().count() == 3


def test_dense_graph_is_thinned_in_the_first_round(spark):
    """Of all pairs of a group, one edge per node is left by the first round; repeated edges change nothing."""
    ids = [f"n{i:03d}" for i in range(60)]
    edges = [(a, b) for a, b in combinations(ids[:40], 2)] + [(b, a) for a, b in combinations(ids[40:], 2)] * 2
    found = connected_components(spark.createDataFrame([(i,) for i in ids], "rec_id string"),
                                 spark.createDataFrame(edges, "left_id string, right_id string"))
    assert {r.rec_id: r.component for r in found.collect()} == groups_of(ids, edges)


def customers(spark, tmp_path, n):
    """A folder with the one table that the records are derived from."""
    spark.createDataFrame([(k, f"c{k}", 0, 0.0, "X") for k in range(n)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_classes_of_all_pairs_that_share_a_key(spark, tmp_path):
    """No pair is left out for its weight, in ordinary or in oversized blocks."""
    run = catalog.run_of(spark, customers(spark, tmp_path, 900))
    rows, spec = collected(run.profiles, run.spec), run.spec
    expected = {}
    for a, b in combinations(sorted(rows), 2):
        if shares_key(rows[a], rows[b], spec, "batch"):
            w = weight_of(rows[a], rows[b], spec)
            expected[a, b] = "match" if w >= 8 else "possible" if w >= 4 else "unlikely" if w >= -5 else "non_match"
    found = catalog.QUERIES["classify_pairs"](spark, str(tmp_path)).collect()
    assert len(found) == len(expected) and {(r.left_id, r.right_id): r["class"] for r in found} == expected
    assert {"match", "unlikely"} <= set(expected.values())

    hot = batch_spec(block_limit=3)
    profiles = collapse_profiles(prepare_records(staged(spark, records(70, 61)), hot), hot).cache()
    rows = collected(profiles, hot)
    pairs = [(r.left_id, r.right_id) for r in scored_pairs(profiles.drop("profile_key"), hot, float("-inf")).collect()]
    assert sorted(pairs) == [p for p in combinations(sorted(rows), 2) if shares_key(*(rows[v] for v in p), hot, "batch")]


def test_similarities_are_computed_per_pair_of_bundles(spark):
    """Rows with equal texts share a bundle: pairs of bundles, which meet the similarity, are far fewer than pairs of rows."""
    spec = batch_spec(block_limit=100)
    rows = [(f"R{i:04d}", "crm_contacts", f"p{i // 2}@x.com" if i % 3 else None, f"555{i // 5:07d}" if i % 4 else None, "alice", "smith",
             ["acme corp", "acme corpp", "techstart"][i % 3]) for i in range(240)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    values = collected(profiles, spec)
    for limit in (100, 1000):
        spec = batch_spec(block_limit=limit)
        expected = {(a, b): round(w, 6) for a, b in combinations(sorted(values), 2)
                    if shares_key(values[a], values[b], spec, "batch") and (w := weight_of(values[a], values[b], spec)) >= 4.0}
        found = scored_pairs(profiles.drop("profile_key"), spec, 4.0)
        assert {(r.left_id, r.right_id): round(r.weight, 6) for r in found.collect()} == expected and len(expected) > 5000
    keyed = joins.block_keys(profiles.withColumn("side", F.lit("B")), spec)
    bundles = joins._bundles(keyed, ["key_type", "key_value"], spec)
    assert bundles.select(F.explode("rows")).count() == keyed.count() and bundles.agg(F.max(F.size("rows"))).first()[0] <= joins.BUNDLE_ROWS
    assert joins.block_pairs(bundles, spec, "batch", True).count() < len(expected) / 5
    hot = keyed.withColumn("block", F.lit("all"))
    assert joins._bundles(hot, ["block"], spec, bounded=False).select(F.explode("rows")).count() == keyed.count()


@pytest.mark.parametrize("limit,floor,seed", [(3, 4.0, 71), (12, 4.0, 72), (256, 6.5, 73)])
def test_texts_of_all_pairs(spark, limit, floor, seed):
    """Fewer pairs show the same texts on the same sides."""
    spec = batch_spec(block_limit=limit)
    rows = records(110, seed) + [(f"S{i:03d}", "crm_contacts", None, f"55{i // 2:08d}", "alice", ["smith", "smyth"][i % 2], "summit") for i in range(40)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    every = scored_pairs(profiles.drop("profile_key"), spec, floor)
    fewer = scored_pairs(profiles.drop("profile_key"), spec, floor, texts=True)
    columns = [p + c for p in ("l_", "r_") for c in ("n_first_name", "n_last_name", "n_company_name")]
    assert set(map(tuple, fewer.select(*columns).collect())) == set(map(tuple, every.select(*columns).collect()))
    few, all_pairs = [{(r.left_id, r.right_id) for r in df.collect()} for df in (fewer, every)]
    assert few < all_pairs


@pytest.mark.parametrize("limit,floor,profile,seed", [(3, 4.0, "batch", 81), (12, 8.0, "batch", 82), (3, 4.0, "incremental", 83)])
def test_strongest_pairs_hold_every_best_candidate(spark, limit, floor, profile, seed):
    spec = batch_spec(block_limit=limit)
    profiles = collapse_profiles(prepare_records(staged(spark, records(120, seed)), spec), spec).cache()
    rows = collected(profiles, spec)
    expected = {}
    for a, b in combinations(sorted(rows), 2):
        if shares_key(rows[a], rows[b], spec, profile) and (w := weight_of(rows[a], rows[b], spec)) >= floor:
            expected[a] = min(expected.get(a, (0, "")), (-round(w, 9), b))
    found = best_candidate(strongest_pairs(profiles, spec, floor, profile)).collect()
    assert {r.left_id: (-round(r.weight, 9), r.right_id) for r in found} == expected


def test_strongest_pairs_of_a_hot_block_are_few(spark):
    spec = batch_spec(block_limit=16)
    rows = [(f"R{i:04d}", "crm_contacts", None, "5550000000", hashlib.md5(str(i).encode()).hexdigest(), None, None) for i in range(400)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    found = strongest_pairs(profiles, spec, spec.possible)
    assert found.count() < 4000
    assert {(r.left_id, r.right_id) for r in best_candidate(found).collect()} >= {("crm_contacts:R0000", "crm_contacts:R0001")}


@pytest.mark.parametrize("limit,seed", [(3, 91), (12, 92), (256, 93)])
def test_thinned_pairs_connect_the_same_rows_at_every_weight(spark, limit, seed):
    spec = batch_spec(block_limit=limit)
    rows = records(100, seed) + [(f"S{i:03d}", "crm_contacts", f"s{i // 2}@x.com" if i % 3 else None, f"55{i // 3:08d}" if i % 4 else None,
                                  "alice", "smith", ["summit", "acme corp"][i % 2]) for i in range(80)]
    profiles = collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()
    every, thin = [{(r.left_id, r.right_id): round(r.weight, 6) for r in scored_pairs(profiles.drop("profile_key"), spec, 4.0, thinned=t).collect()}
                   for t in (False, True)]
    assert thin.items() <= every.items() and len(thin) < len(every)
    ids = {v for p in every for v in p}
    for weight in set(every.values()):
        assert groups_of(ids, [p for p in thin if thin[p] == weight]) == groups_of(ids, [p for p in every if every[p] == weight])
