"""Training: pattern counts against brute force, EM on known parameters, random pairs."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from personweave.operators.normalize import collapse_profiles, prepare_records
from personweave.operators.score import posterior
from personweave.operators.train import em_train, estimate_u, gamma_patterns, random_pairs
from personweave.plans.batch import reconcile
from personweave.spec import batch_spec
from tests.seed import staged
from tests.test_pairs import records, shares_key
from tests.test_pairs import jaro_winkler, np


def gamma(f, x, y):
    if x is None or y is None:
        return -1
    if x == y:
        return 1
    return int(f.comparator != "exact" and jaro_winkler(np.array([x], object), np.array([y], object))[0] >= f.threshold)


@pytest.mark.parametrize("limit", [256, 3])
def test_patterns_equal_brute_force(spark, limit):
    spec = batch_spec(block_limit=limit)
    normal = prepare_records(staged(spark, records(90, 11)), spec).cache()
    rows = {r.rec_id: tuple(r[f.column] for f in spec.fields) for r in normal.collect()}
    expected = Counter(tuple(gamma(f, x, y) for f, x, y in zip(spec.fields, rows[a], rows[b]))
                       for a, b in combinations(rows, 2) if shares_key(rows[a], rows[b], spec, "batch"))
    # Records that reach no match even with their own copies keep profiles of their own; pairs stay the same.
    found = gamma_patterns(collapse_profiles(normal, spec), spec).collect()
    assert {tuple(r[f"gamma_{f.name}"] for f in spec.fields): r.pairs for r in found} == expected


def test_em_recovers_parameters(spark):
    spec = batch_spec(max_iterations=200, convergence=1e-7)
    rng = random.Random(12)
    m, u, rate = [0.95, 0.9, 0.85, 0.9, 0.8], [0.01, 0.02, 0.05, 0.04, 0.1], 0.2
    counts = Counter()
    for _ in range(60000):
        p = m if rng.random() < rate else u
        counts[tuple(-1 if rng.random() < 0.1 else int(rng.random() < x) for x in p)] += 1
    patterns = spark.createDataFrame([(*k, float(n)) for k, n in counts.items()],
                                     ", ".join(f"gamma_{f.name} int" for f in spec.fields) + ", pairs double")
    trained = em_train(patterns, {f.name: x for f, x in zip(spec.fields, u)}, spec)
    assert abs(trained.match_rate - rate) < 0.01
    assert all(abs(trained.parameters[f.name][0] - x) < 0.02 for f, x in zip(spec.fields, m))


def test_random_pairs_are_repeatable_and_distinct_records(spark):
    spec = batch_spec()
    profiles = collapse_profiles(prepare_records(staged(spark, records(150, 13)), spec), spec).cache()
    drawn = random_pairs(profiles, spec, 10_000).select("l_vid", "r_vid")
    first = sorted(map(tuple, drawn.collect()))
    assert first == sorted(map(tuple, drawn.collect())) and all(a != b for a, b in first)
    few = random_pairs(profiles, spec, 200).count()
    assert 50 < few <= 300
    u = {r.field: r.u for r in estimate_u(profiles, spec).collect()}
    assert set(u) == {f.name for f in spec.fields} and all(0 < x < 1 for x in u.values())


def test_trained_run(spark):
    spec = batch_spec()
    result = reconcile(staged(spark, records(80, 14)), spec, "2025-01-01")
    assert result.spec.fields[0].m != spec.fields[0].m
    assert result.members.count() == len(records(80, 14))


def test_posterior(spark):
    row = spark.range(1).select(posterior(F.lit(0.0), 0.5).alias("a"), posterior(F.lit(10.0), 0.001).alias("b")).first()
    assert row.a == 0.5 and abs(row.b - 1024 * (0.001 / 0.999) / (1 + 1024 * (0.001 / 0.999))) < 1e-12
