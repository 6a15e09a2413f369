import math
import random
import zlib
from collections import Counter

import numpy as np

from personweave.llm.toxicity import Settings, calibration, evidence, toxicity_evidence, toxicity_scores, words_of
from tests.llm.common import clashing, documents

LABELS = "doc_id long, toxic int"


def corpus(n=400, seed=2):
    """Documents of invented words, a quarter of them with a few words of abuse, and labels of most."""
    rng = random.Random(seed)
    parts = ["ba", "lo", "ti", "ren", "shu", "mo", "ka", "é", "dor", "im"]
    def word():
        return "".join(rng.choices(parts, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randint(3, 60))], i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(["grumpf", "zwack", "Grumpfling", "zwacker!"]) )
        docs.append((i, " ".join(words) + "."))
        if i % 10:
            labels.append((i, int(toxic)))
    return docs, labels


def brute(docs, uses, s):
    """Evidence by the textbook: counts in dictionaries, probabilities by recursion."""
    pad = "\x02" * (s.order - 1)
    def grams(word):
        t = pad + word.decode() + "\x03"
        return [t[i - s.order + 1:i + 1] for i in range(s.order - 1, len(t))]
    top, everything = (Counter(), Counter()), set()
    for (_, text), use in zip(docs, uses):
        for w in words_of(text):
            everything.update(grams(w))
            if use in (0, 1):
                top[use].update(grams(w))
    counts = {}
    for y in (0, 1):
        counts[y, s.order] = top[y]
    counts["all", s.order] = Counter(everything)
    for k in range(s.order - 1, 0, -1):
        for y in (0, 1, "all"):
            counts[y, k] = Counter(g[1:] for g, n in counts[y, k + 1].items() if n)
    letters = len(counts["all", 1])
    totals = {}
    for key, c in counts.items():
        n1, n2 = (sum(v == i for v in c.values()) for i in (1, 2))
        total, kinds = Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        totals[key] = (n1 / (n1 + 2 * n2) if n1 else 0.5, total, kinds)

    def p(y, g):
        if not g:
            return 1 / letters
        key = ("all" if len(g) <= s.shared else y, len(g))
        below, (d, total, kinds), h = p(y, g[1:]), totals[key], g[:-1]
        return (max(counts[key][g] - d, 0) + d * kinds[h] * below) / total[h] if total[h] else below

    return [evidence(np.array([sum(math.log(p(1, g) / p(0, g)) for g in grams(w)) for w in words_of(t)]), s) for _, t in docs]


def test_models_against_brute_force(spark):
    docs, labels = corpus(120)
    docs += [(500, None), (501, ""), (502, "..."), (None, "grumpf"), (3, docs[3][1]), (503, "Grumpf " * 2000)]
    for s in (Settings(), Settings(order=3, shared=1, margin=0.5, strongest=1)):
        found = toxicity_evidence(documents(spark, docs).repartition(4), spark.createDataFrame(labels, LABELS), s).collect()
        uses = {r["doc_id"]: r["use"] for r in found}
        expected = brute(docs, [uses[i] for i, _ in docs], s)
        assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i, u in uses.items() if u == -1 and i in dict(labels))
        assert {0, 1, 2, 3} <= set(uses.values())
        got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["excess"], r["strongest"]) for r in found))
        want = sorted((i is None, i or 0, *e) for (i, _), e in zip(docs, expected))
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose(np.array([x[2:] for x in got]), np.array([x[2:] for x in want]), atol=2e-4)


def test_held_out_toxic_documents_are_found(spark):
    docs, labels = corpus(600)
    scored = {r["doc_id"]: r for r in toxicity_scores(clashing(documents(spark, docs)), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(scored) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in scored.items())
    unseen = [i for i, _ in docs if scored[i]["held_out"] or i % 10 == 0]
    assert sum(scored[i]["predicted"] != (i % 4 == 0) for i in unseen) <= len(unseen) // 50


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(80)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, other = (sorted(map(tuple, toxicity_scores(documents(spark, docs), spark.createDataFrame(x, LABELS)).collect()))
                  for x in (labels, turned))
    assert one == other


def test_no_labels_nulls_and_empty_table(spark):
    docs = documents(spark, [(1, "some words"), (2, None), (None, "x"), (1, "some words")])
    none = spark.createDataFrame([], LABELS)
    rows = toxicity_scores(docs, none).collect()
    assert len(rows) == 4 and all(r["predicted"] == 0 and r["score"] < 0.01 for r in rows)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7)], LABELS)
    assert {r["predicted"] for r in toxicity_scores(docs, odd).collect()} == {0}
    assert toxicity_scores(documents(spark, []), none).collect() == []
    assert toxicity_scores(documents(spark, []), spark.createDataFrame([(1, 1)], LABELS)).collect() == []


def test_calibration_exists_for_any_rows():
    assert calibration([], 0.0)[2] < -6
    w = calibration([(0.0, 0.0, 50, 0), (5.0, 3.0, 10, 10)], 1 / 6)
    assert 5 * w[0] + 3 * w[1] + w[2] > 1 and w[2] < -1
    assert np.isfinite(calibration([(2.0, 1.0, 5, 5)], 1.0)).all()
