"""The review band in counts and on request, against listed pairs."""

import random
from collections import Counter
from dataclasses import replace

import pytest

from personweave.operators import pairs as joins
from personweave.operators import review
from personweave.operators.normalize import collapse_profiles, prepare_records
from personweave.operators.pairs import scored_pairs
from personweave.operators.review import review_groups, review_pairs_of
from personweave.operators.score import decide
from personweave.spec import batch_spec
from tests.seed import staged
from tests.test_pairs import records

GAMMAS = [f"gamma_{f.name}" for f in batch_spec().fields]


def profiles_of(spark, spec, rows):
    return collapse_profiles(prepare_records(staged(spark, rows), spec), spec).cache()


def listed(profiles, spec):
    found = decide(scored_pairs(profiles.drop("profile_key"), spec, spec.possible), spec).where("decision = 'review'")
    return [(r.left_id, r.right_id, tuple(r[g] for g in GAMMAS)) for r in found.collect()]


@pytest.mark.parametrize("limit", [3, 256])
def test_counts_equal_the_listed_pairs(spark, limit):
    spec = batch_spec(block_limit=limit)
    profiles = profiles_of(spark, spec, records(120, 5))
    pairs = listed(profiles, replace(spec, block_limit=256))
    assert len(pairs) > 50
    expected = Counter((v, g) for a, b, g in pairs for v in (a, b))
    groups = review_groups(profiles, spec).collect()
    assert {(r.vid, tuple(r[g] for g in GAMMAS)): r.partners for r in groups} == expected
    assert all(spec.possible <= r.weight < spec.match for r in groups)


@pytest.mark.parametrize("limit", [3, 256])
def test_pairs_of_all_profiles(spark, limit):
    spec = batch_spec(block_limit=limit)
    profiles = profiles_of(spark, spec, records(120, 6))
    pairs = listed(profiles, replace(spec, block_limit=256))
    found = review_pairs_of(profiles.select("vid"), profiles, spec)
    assert sorted((r.left_id, r.right_id, tuple(r[g] for g in GAMMAS)) for r in found.collect()) == sorted(
        pairs + [(b, a, g) for a, b, g in pairs])


def test_asked_profiles_do_not_meet_whole_oversized_blocks(spark, monkeypatch):
    spec = batch_spec(block_limit=8)
    names = ["".join(random.Random(i).choice("bcdfglmnprst") for _ in range(7)) for i in range(300)]
    rows = [(str(i), "crm_contacts", f"p{i // 2}@x.org", "555-010-2000", f"q{i}", names[i], None) for i in range(300)]
    profiles = profiles_of(spark, spec, rows)
    met = []
    compared = joins.block_pairs
    monkeypatch.setattr(joins, "block_pairs", lambda *a: met.append(compared(*a).count()) or compared(*a))
    monkeypatch.setattr(review, "block_pairs", joins.block_pairs)
    review_pairs_of(profiles.select("vid"), profiles, spec).count()
    assert met and max(met) < 10 * len(rows)


def test_pairs_of_asked_profiles(spark):
    spec = batch_spec()
    profiles = profiles_of(spark, spec, records(120, 5))
    pairs = listed(profiles, spec)
    asked = sorted({a for a, _, _ in pairs})[:3] + ["unknown:1", None]
    found = review_pairs_of(spark.createDataFrame([(a,) for a in asked + asked], "vid string"), profiles, spec)
    both = {(a, b, g) for a, b, g in pairs} | {(b, a, g) for a, b, g in pairs}
    assert sorted((r.left_id, r.right_id, tuple(r[g] for g in GAMMAS)) for r in found.collect()) == sorted(p for p in both if p[0] in asked)


def test_one_phone_of_many_records_gives_linear_rows(spark):
    n, rng = 10_000, random.Random(1)
    spec = batch_spec()
    first, last = ["".join(rng.choice("bcdfglmnprst") for _ in range(6)) for _ in range(20)], ["".join(rng.choice("bcdfglmnprst") for _ in range(7)) for _ in range(25)]
    rows = [(str(i), "crm_contacts", f"p{i}@x.org", "555-010-2000", first[i % 20], last[i // 20 % 25], None) for i in range(n)]
    profiles = profiles_of(spark, spec, rows)
    groups = review_groups(profiles, spec).cache()
    assert 0 < groups.count() <= n * 3
    # The phone agrees and the email differs, so only the names vary.
    assert groups.select("gamma_email", "gamma_phone").distinct().collect() == [(0, 1)]
    one = groups.where("vid = 'crm_contacts:7'").collect()
    asked = review_pairs_of(spark.createDataFrame([("crm_contacts:7",)], "vid string"), profiles, spec)
    assert sum(r.partners for r in one) == asked.count()
    assert {tuple(r[g] for g in GAMMAS): r.partners for r in one} == Counter(tuple(r[g] for g in GAMMAS) for r in asked.collect())


def test_nothing_to_review(spark):
    spec = batch_spec()
    empty = profiles_of(spark, spec, [("1", "crm_contacts", None, None, None, None, None)])
    assert review_groups(empty, spec).count() == 0 and review_groups(empty.limit(0), spec).count() == 0
    assert review_pairs_of(empty.select("vid"), empty, spec).count() == 0
