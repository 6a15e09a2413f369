"""Exact deduplication against brute force; the Golomb code."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from personweave.llm import exact_dedup as module
from personweave.llm import golomb
from personweave.llm.exact_dedup import exact_dedup
from tests.llm.common import clashing, documents, groups


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 1 << 59), max_size=80))
def test_golomb_round_trip(values):
    values = np.array(sorted(values), np.int64)
    assert (golomb.decode(golomb.encode(values)) == values).all()


def test_golomb_is_smaller_than_the_hashes():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 10_000))
    assert len(golomb.encode(values)) < 10_000 * 30 / 8


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    found = groups((normal(t), (-len(t or ""), i)) for i, t in rows)
    best = {k: min(v)[1] for k, v in found.items()}
    return sorted((i, best[normal(t)], len(found[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        words = " ".join(rng.choice("ab") for _ in range(rng.randrange(9)))
        rows.append((i, "the hot text" if rng.random() < 0.33 else rng.choice([words, words.replace(" ", "\t\n"), words + " é", None])))
    out = exact_dedup(documents(spark, rows).repartition(7, "doc_id")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out)


def test_equal_digests_of_different_senders(spark, monkeypatch):
    monkeypatch.setattr(module, "SENDER_ROWS", 2)
    rows = [(i, f"text {i % 5}") for i in range(23)]
    out = exact_dedup(documents(spark, rows).coalesce(1)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == brute(rows)


def test_other_white_space_counts(spark):
    rows = [(0, "a b"), (1, "a b"), (2, "ab"), (3, "a b"), (4, "a\x0bb"), (5, "a\x1cb")]
    out = {r.doc_id: r.keep_id for r in exact_dedup(documents(spark, rows)).collect()}
    assert out == {0: 0, 1: 1, 2: 0, 3: 3, 4: 0, 5: 5}


def test_nulls_repeated_rows_and_long_texts(spark):
    long = "x " * 300_000
    rows = [(7, "same"), (7, "same"), (None, "same"), (None, None), (1, ""), (2, " \n"), (3, long), (4, long + "y"), (5, long)]
    out = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(clashing(documents(spark, rows))).collect()]
    assert sorted(x for x in out if x[0] == 7) == [(7, 7, 3, False), (7, 7, 3, True)]
    assert {x for x in out if x[0] is None} == {(None, 7, 3, False), (None, 2, 3, False)}
    assert {x for x in out if x[0] in (1, 2, 3, 4, 5)} == {(1, 2, 3, False), (2, 2, 3, True), (3, 3, 2, True), (4, 4, 1, True), (5, 3, 2, False)}


def test_only_rows_without_ids(spark):
    out = exact_dedup(documents(spark, [(None, "a"), (None, "a"), (None, "b")])).collect()
    assert sorted((r.group_size, r.kept) for r in out) == [(1, True), (2, False), (2, True)]
    assert all(r.keep_id is None for r in out)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def test_carries_all_columns(spark):
    docs = clashing(documents(spark, ["a", "a ", "b"]))
    out = exact_dedup(docs, carry=True).where("kept").select("record.*")
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "a "), (2, "b")]


def test_texts_are_shuffled_for_suspects_only(spark):
    out = exact_dedup(documents(spark, ["a", "b", "a"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    text = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "normal" in x]
    assert len(text) == 1 and "bitmap" not in text[0]


@pytest.mark.parametrize("text", ["a" * 100_000, "é " * 50_000])
def test_code_points_decide(spark, text):
    out = exact_dedup(documents(spark, [text, text + "  ", " " + text])).collect()
    assert {r.keep_id for r in out} == {1}
