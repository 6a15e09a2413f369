"""Top-k by inner product against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from personweave.llm.topk import top_k
from tests.llm.common import clashing

SCHEMA = "vec_id long, embedding array<float>, note string"


def brute(rows, k=10):
    import numpy as np
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % 10 == 0}):
        vector = next(v for i, v in good if i == q)
        best = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def found(spark, rows, **settings):
    df = clashing(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA))
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, **settings).collect())


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "candidate_block": 7}, {"query_block": 1, "candidate_block": 1}])
def test_against_brute_force(spark, blocks):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1), 0.5]) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(15)]  # ties
    assert found(spark, rows, k=4, **blocks) == brute(rows, 4)


def test_unusable_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.5]), (6, []),
            (None, [1.0, 1.0]), (10, [-1.0, -1.0]), (20, None), (7, [1.0, 1.0])]
    assert found(spark, rows) == brute(rows)


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])]
    assert found(spark, rows) == [(0, 1, 1, 512 * 1024), (0, 2, 1, 512 * 1024)]


def test_hot_vector_and_fewer_than_k(spark):
    rows = [(i, [0.1, 0.2]) for i in range(30)]
    assert found(spark, rows, k=40, candidate_block=4) == brute(rows, 40)
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []
