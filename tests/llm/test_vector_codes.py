import hashlib
import math

import numpy as np
import pytest

from personweave.llm.vector_codes import Gnat, compress, vector_codes
from tests.llm.common import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Codes, errors and codebooks by looking at every entry."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i, w) for i, w, _ in kept if i is not None)[:entries]
    size = len(kept[0][1]) // parts
    books = [[w[p * size:(p + 1) * size] for _, w in first] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = {}
            for _, w, _ in kept:
                x = w[p * size:(p + 1) * size]
                own.setdefault(nearest(book, x)[1], []).append(x)
            for k, xs in own.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(book, w[p * size:(p + 1) * size]) for p, book in enumerate(books)] for _, w, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest)
                   for (i, _, label), f, e in zip(kept, found, errors)), key=repr)


def collected(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("spread,fanout,leaf", [(3, 3, 2), (60, 6, 8), (1, 2, 1), (5000, 9, 4)])
def test_tree_agrees_with_all_entries(spread, fanout, leaf):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (64, 4))
    queries = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (3000, 4)), entries])
    apart = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
    tree = Gnat(entries, fanout, leaf)
    index, distance = tree.nearest(queries)
    assert (index == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_tree_rules_subtrees_out():
    rng = np.random.default_rng(5)
    centres = rng.integers(-100_000, 100_000, (8, 4))
    entries = np.concatenate([c + rng.integers(-50, 50, (8, 4)) for c in centres])
    queries = entries[rng.integers(0, 64, 5000)] + rng.integers(-20, 20, (5000, 4))
    tree = Gnat(entries)
    tree.nearest(queries)
    assert tree.measured < 0.5 * 64 * len(queries)


def test_codes_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=32) / 4, 2)], int(i) % 3 if i % 5 else None) for i in range(200)]
    rows += [(7, rows[3][1], 1), (3, rows[3][1], None), (None, rows[9][1], 2)]  # repeated rows, ids and no id
    rows += [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] + [0.0] * 31, 1), (903, [float("inf")] + [0.0] * 31, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(vector_codes(clashing(df).withColumnRenamed("w", "w2"))) == brute(rows)


def test_fewer_rows_than_entries_ties_and_hot_label(spark):
    rows = [(i, [float(i % 3)] * 16, 1) for i in range(40)]
    assert collected(vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    rows = [(i, [float(i)] * 16, i) for i in range(1500)] + [(5000 + i, [0.5] * 16, -1) for i in range(700)]
    assert collected(vector_codes(spark.createDataFrame(rows, SCHEMA), entries=5, rounds=1)) == brute(rows, entries=5, rounds=1)


def test_empty_table_and_unusable_vectors(spark):
    empty = vector_codes(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.collect() == []
    assert vector_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="multiple of 16"):
        compress(spark.createDataFrame([(1, [1.0] * 17, 1)], SCHEMA))
    with pytest.raises(Exception, match="components"):
        vector_codes(spark.createDataFrame([(1, [1.0] * 16, 1), (2, [1.0] * 32, 1)], SCHEMA)).collect()
