import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from personweave.llm.fill_middle import UNITS, WaveletMatrix, classes, digests, fill_in_middle, restored
from tests.llm.common import clashing, documents

TEXTS = ["", None, "a", "Zwölf Boxkämpfer 😀 jagen\nViktor\n\n quer", " lead and trail \n", "<P>marked", "has <M> too", "a<", "<S",
         "é" * 50, "😀", "word " * 400, "x" * 70_000, "\n\n\n", "same", "same", "tab\tand\x0bvt", "<", "<P", "ends with <"]


def expected(doc_id, text):
    text = text or ""
    h = [int(x, 16) for x in re.findall("." * 8, hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest())[:4]]
    i, j = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", i, j - i, f"<S>{text[j:]}<P>{text[:i]}<M>{text[i:j]}"
    return len(text), "psm", i, j - i, f"<P>{text[:i]}<S>{text[j:]}<M>{text[i:j]}"


@given(st.binary(max_size=400), st.integers(0, 4))
@settings(max_examples=60, deadline=None)
def test_ranks(data, kind):
    kinds = np.frombuffer(data, np.uint8) % 5
    at = np.arange(len(kinds) + 1)
    assert WaveletMatrix(kinds).rank(kind, at).tolist() == [int((kinds[:i] == kind).sum()) for i in at]


def units_of(text, unit):
    """Places (in code points) where units begin."""
    if unit == "char":
        return list(range(len(text)))
    if unit == "word":
        return [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [0] * bool(text) + [m.end() for m in re.finditer("\n", text) if m.end() < len(text)]


@pytest.mark.parametrize("unit", list(UNITS))
@given(texts=st.lists(st.text(st.sampled_from("aé😀 \n\t"), max_size=30), min_size=1, max_size=6))
@settings(max_examples=40, deadline=None)
def test_places(unit, texts):
    data = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, data)])
    matrix = WaveletMatrix(classes(np.frombuffer(b"".join(data), np.uint8), edges[:-1]))
    base = matrix.count(UNITS[unit], edges[:-1])
    for k in range(32):
        found = matrix.find(UNITS[unit], base + k, edges[:-1], edges[1:])
        for text, a, place in zip(texts, edges, found):
            starts = units_of(text, unit)
            at = starts[k] if k < len(starts) else len(text)
            assert place - a == len(text[:at].encode())


def test_against_code_points(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "no id"), (4, "again 4"), (4, "again 4"), (-3, "negative")]
    df = documents(spark, rows).repartition(3)
    found = fill_in_middle(clashing(df))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted(((i, *expected(i, t)) for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = found.select("doc_id", restored(F.col("output"), F.col("form")).alias("t"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    sums = digests(found).select("doc_id", "output_sha256", "restored_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, sums.collect()), key=repr) == sorted(((i, sha(expected(i, t)[4]), sha(t or "")) for i, t in rows), key=repr)


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_come_back(spark, unit):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)]
    found = fill_in_middle(documents(spark, rows), unit=unit, plain_percent=0, spm_percent=50, seed="x")
    got = {r["doc_id"]: r for r in found.withColumn("t", restored(F.col("output"), F.col("form"))).collect()}
    for i, t in rows:
        text, r = t or "", got[i]
        assert r["t"] == text and r["n"] == len(units_of(text, unit))
        if r["form"] != "plain":
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= {0, len(text), *units_of(text, unit)}


def test_empty_table_and_wrong_unit(spark):
    assert fill_in_middle(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        fill_in_middle(documents(spark, []), unit="page")
