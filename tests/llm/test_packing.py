"""Packing: plans are valid and tight, pieces have the right tokens."""

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from personweave.llm.packing import fullest, pack, pack_documents, plan
from tests.llm.common import groups, clashing, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(20))
def test_fullest_combination(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(5)}
    space = rng.randrange(1, 60)
    items = [x for x, n in counts.items() for _ in range(n)]
    best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= space)
    chosen = fullest(counts, space)
    assert sum(x * k for x, k in chosen) == best
    assert all(1 <= k <= counts[x] for x, k in chosen)


def first_fit_decreasing(counts, capacity):
    free = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        at = next((i for i, space in enumerate(free) if space >= length), None)
        if at is None:
            free.append(capacity - length)
        else:
            free[at] -= length
    return len(free)


@pytest.mark.parametrize("seed", range(10))
def test_plan_places_every_rank_once(seed):
    rng = random.Random(seed)
    counts = {x: rng.randrange(1, 30) for x in rng.sample(range(1, 65), 20)}
    rules, bins = plan(counts, 64)
    fill = {}
    for length, first, k, first_bin, times, offset in rules.tolist():
        for turn in range(times):
            for slot in range(k):
                fill.setdefault(first_bin + turn, []).append((offset + slot * length, length))
    ranks = {x: sorted(r for n, first, k, _, times, _ in rules.tolist() if n == x for r in range(first, first + k * times)) for x in counts}
    assert all(ranks[x] == list(range(n)) for x, n in counts.items())
    assert sorted(fill) == list(range(bins))
    for spans in fill.values():
        end = 0
        for start, length in sorted(spans):
            assert start == end
            end += length
        assert end <= 64
    assert bins <= 1.03 * first_fit_decreasing(counts, 64) + 1


def test_plan_of_nothing():
    rules, bins = plan({}, 1024)
    assert bins == 0 and len(rules) == 0


def checked(rows, capacity):
    """Sequences are gapless and within capacity."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for start, length in sorted(spans):
            assert start == end
            end += length
        assert end <= capacity
    return len(by)


def test_documents_against_the_library(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "Zürich", "12", "\n"]) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(60)]
    rows = [*enumerate(texts), (900, None), (None, "alpha"), (7, texts[7])]
    out = pack_documents(clashing(documents(spark, rows)), PATH, capacity=16, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) - 16 * ((len(ids) - 1) // 16)
        edges = [0, *range(first, len(ids) + 1, 16)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            row = (i, piece, a, b - a, zlib.crc32(data), data)
            want[row] = want.get(row, 0) + 1
    got = {}
    for r in out:
        row = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids))
        got[row] = got.get(row, 0) + 1
    assert got == want
    assert checked(out, 16) <= 1.05 * -(-sum(r.length for r in out) // 16) + 1


def test_one_length_has_most_pieces(spark):
    rows = [(i, 0, 0, 5 if i % 3 else 3, 0) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = pack(pieces, 13).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == 3000
    assert checked(out, 13) == 1000


def test_lengths_are_checked(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 20, 0)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError):
        pack(pieces, 16)


def test_empty_table(spark):
    assert pack_documents(documents(spark, []), PATH).collect() == []


def test_very_long_text(spark):
    out = pack_documents(documents(spark, ["word " * 100_000]), PATH).collect()
    assert sum(r.length for r in out) == out[0].length + 1024 * (len(out) - 1) or max(r.length for r in out) == 1024
    assert sorted(r.piece for r in out) == list(range(len(out)))


def test_one_length_in_nearly_all_pieces(spark, monkeypatch):
    """Parts of a frequent length are as small as those of a rare one."""
    from personweave.llm import packing
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    rows = [(i, 0, 0, 16 if i % 100 else 1 + i % 15, i * 7919) for i in range(4000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(pieces, 16).collect()
    assert len(out) == 4000
    for bin_ in groups((r.sequence_id, (r.offset, r.length)) for r in out).values():
        at = 0
        for offset, length in sorted(bin_):
            assert offset == at
            at += length
        assert at <= 16
    written = packing.scratch_table

    def parts(df, name):
        table = written(df, name)
        if name == "piece_counts":
            sizes = [r["count"] for r in table.where("length = 16").collect()]
            assert len(sizes) > 60 and max(sizes) < 120
        return table
    monkeypatch.setattr(packing, "scratch_table", parts)
    packing.pack(pieces, 16).count()
