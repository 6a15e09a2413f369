"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from personweave.llm import simhash_dedup as module
from personweave.llm.simhash_dedup import _linked, _links_of, fingerprint, near_duplicates
from tests.llm.common import clashing, components, documents


def slow_fingerprint(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts, distance=3):
    marks = [slow_fingerprint(t) for t in texts]
    links = [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= distance]
    return [f"{m:016x}" for m in marks], components(len(marks), links)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            words = (rng.choice(texts) or "x").split()
            if words and rng.random() < 0.9:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 10, 200]))))
    return texts


def results(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("text", ["", " \t\x0b", "A", "a B", "Ä b C d", "x y z w", "one two three four " * 500])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_in_parts(monkeypatch):
    monkeypatch.setattr(module, "HASHES_AT_ONCE", 7)
    text = " ".join(corpus(30, 5))
    assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("size", [None, 1, 3, 5])
def test_against_brute_force(spark, size):
    texts = corpus(250, 3)
    marks, parts = brute(texts)
    out = results(near_duplicates(documents(spark, texts), bytes_per_key=size))
    assert out == {i: (marks[i], parts[i]) for i in range(len(texts))}


def test_long_lists_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(module, "CELL_ROWS", 8)
    monkeypatch.setattr(module, "MIN_SAMPLED", 2)
    monkeypatch.setattr(module, "SMALL_LIST", 4)
    texts = corpus(250, 4)
    marks, parts = brute(texts)
    out = results(near_duplicates(documents(spark, texts), bytes_per_key=1))
    assert out == {i: (marks[i], parts[i]) for i in range(len(texts))}


@pytest.mark.parametrize("small", [2, 24, 1000])
def test_links_connect_what_pairs_connect(monkeypatch, small):
    monkeypatch.setattr(module, "SMALL_LIST", small)
    rng = np.random.default_rng(2)
    fps = np.unique(rng.integers(0, 1 << 9, 200, dtype=np.uint64) | np.uint64(1 << 40))
    keys = np.sort(rng.integers(0, 3, len(fps)))
    found = _links_of(keys, fps, 2)
    at = {f: i for i, f in enumerate(fps.tolist())}
    pairs = [(i, j) for i in range(len(fps)) for j in range(i)
             if keys[i] == keys[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 2]
    assert components(len(fps), [(at[a], at[b]) for a, b in found.tolist()]) == components(len(fps), pairs)
    if small == 2:
        assert len(found) < len(fps) * 2


def test_nulls_repeated_rows_and_empty_texts(spark):
    rows = [(5, None), (3, ""), (3, ""), (None, " "), (9, "a b c d"), (9, "a b c d"), (None, "q r s t u")]
    out = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(clashing(documents(spark, rows))).collect()]
    assert sorted(x for x in out if x[1] == "0" * 16 and x[0]) == [(3, "0" * 16, 3), (3, "0" * 16, 3), (5, "0" * 16, 3)]
    assert [x[2] for x in out if x[0] == 9] == [9, 9]
    assert sorted(x[2] or -1 for x in out if x[0] is None) == [-1, 3]
    assert len(out) == 7


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_distance_is_checked(spark):
    with pytest.raises(ValueError):
        near_duplicates(documents(spark, ["a"]), distance=7)


def test_count_filter_and_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    b = a.copy()
    for i in range(4000):
        for bit in rng.integers(0, 64, i % 7):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    for distance in range(7):
        want = [bin(int(x ^ y)).count("1") <= distance for x, y in zip(a, b)]
        assert _linked(a, b, distance).tolist() == want
    assert _linked(a[0], a, 3).tolist() == [bin(int(a[0] ^ y)).count("1") <= 3 for y in a]
