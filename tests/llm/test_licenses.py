"""License scan against brute force."""

import random

import pytest

from personweave.llm import licenses as module
from personweave.llm.licenses import (NOTICES, Place, Templates, best_places, scan_licenses, shingles_of, templates as all_templates,
                                       words_of)
from tests.llm.common import clashing, documents

LONG = {"long": " ".join(f"term{i}" for i in range(300)), "half": " ".join(f"part{i}" for i in range(150))}


def brute(text, templates, least=0.8):
    have = set(shingles_of(words_of(text)))
    want = {n: set(shingles_of(words_of(t))) for n, t in templates.items()}
    return sorted(n for n, s in want.items() if s and len(s & have) / len(s) >= least)


def scanned(texts, templates):
    return [sorted(r[0] for r in rows) for rows in Templates(templates).scan(texts, 0.8)]


def corpus(templates, n, seed, edits):
    rng = random.Random(seed)
    filler = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(n):
        words = rng.choices(filler, k=rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            own = rng.choice(list(templates.values())).split()
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = "changed"
            words += own + rng.choices(filler, k=rng.randrange(0, 200))
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("templates,edits", [(NOTICES, 0), (LONG, 4), (NOTICES | LONG, 2)])
@pytest.mark.parametrize("at_once", [50, 1 << 15])
def test_against_brute_force(monkeypatch, templates, edits, at_once):
    monkeypatch.setattr(module, "SCAN_AT_ONCE", at_once)
    texts = corpus(templates, 80, 7, edits)
    # A window must hold the shingles together; the filler is distinct, so a text-wide count says the same.
    assert scanned(texts, templates) == [brute(t, templates) for t in texts]


def test_places_and_spans():
    notice = NOTICES["MIT"]
    (row,) = next(Templates(NOTICES).scan([f"one two {notice} three four five six {notice}"], 0.8))
    assert row == ("MIT", 2, 2, 7, 1.0)


def test_odd_texts():
    assert scanned([None, "", "...", "released under the", "RELEASED, under the (MIT) license"], NOTICES) == [[], [], [], [], ["MIT"]]
    assert scanned(["two words here"], {"short": "two words", "same": "Two words here!"}) == [["same"]]
    assert list(Templates({}).scan(["a", None], 0.8)) == [[], []]


def test_long_text_and_frame(spark):
    text = "word " * 200_000 + NOTICES["GPL-3.0"] + " word" * 100_000
    rows = [(1, text), (2, None), (3, ""), (4, NOTICES["MIT"]), (4, NOTICES["MIT"]), (None, NOTICES["MIT"])]
    out = scan_licenses(clashing(documents(spark, rows))).collect()
    assert sorted(((r.doc_id, r.template, r.n_places) for r in out), key=str) == [
        (1, "GPL-3.0", 1), (4, "MIT", 1), (4, "MIT", 1), (None, "MIT", 1)]
    assert next(r for r in out if r.doc_id == 1).first_word == 200_000
    assert scan_licenses(documents(spark, [])).collect() == []


def test_number_of_templates_is_checked(monkeypatch):
    monkeypatch.setattr(module, "MAX_TEMPLATES", 1)
    with pytest.raises(ValueError):
        Templates(NOTICES)


ALL = all_templates()
NAMED = Templates(ALL, phrases=True)


@pytest.mark.parametrize("name", sorted(ALL))
def test_every_template_is_reported_as_itself(name):
    text = f"one two three four {ALL[name]} five six seven eight"
    ((row,),) = NAMED.scan([text], 0.8, best=True)
    assert row == (name, 1, 4, 4 + len(words_of(ALL[name])), 1.0)


def test_changed_notices_and_versions_side_by_side():
    two, three = ALL["GPL-2.0-or-later/header"], NOTICES["GPL-3.0-header"]
    (rows,) = NAMED.scan([f"{two} and then something else entirely {three} {two.replace('redistribute', 'share')}"], 0.8, best=True)
    assert {(r[0], r[1]) for r in rows} == {("GPL-2.0-or-later/header", 2), ("GPL-3.0-header", 1)}


def test_phrases_against_brute_force():
    rng = random.Random(3)
    short = {"ab": "a b", "abc": "a b c", "d": "d", "cab": "c a b a"}
    texts = [" ".join(rng.choices("abcd", k=rng.randrange(12))) for _ in range(300)]
    for text, rows in zip(texts, Templates(short, phrases=True).scan(texts, 0.8)):
        words = text.split()
        want = {n: [i for i in range(len(words)) if words[i:i + len(t.split())] == t.split()] for n, t in short.items()}
        assert [r[0] for r in rows] == sorted(n for n, at in want.items() if at)
        assert all(r[2] == want[r[0]][0] for r in rows)


def test_best_places_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        places = sorted({Place(a, a + rng.randrange(1, 9), rng.randrange(4), rng.choice([0.8, 1.0]), rng.randrange(1, 9))
                         for a in (rng.randrange(30) for _ in range(rng.randrange(12)))})
        kept = []
        for p in sorted(places, key=lambda p: (p.end - p.start - 2 * p.covered, -p.share, p.template, p.start)):
            if not any(2 * len({*range(*p[:2])} & {*range(*q[:2])}) > min(p[1] - p[0], q[1] - q[0]) for q in kept):
                kept.append(p)
        assert best_places(places) == sorted(kept)
