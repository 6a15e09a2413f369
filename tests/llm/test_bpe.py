"""Byte-pair encoding against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from personweave.llm import bpe
from personweave.llm.bpe import Codec, decode, encode, round_trip
from tests.llm.common import clashing, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODEC = Codec(PATH)
LIBRARY = Tokenizer.from_file(PATH)
TRICKY = ["", " ", "a", "don't won't !'s ’s ''s \"'re", "  two  spaces \n\n\té", "x  y 　z", "\u0085a", "<|endoftext|>",
          "a<|endoftext|> b<|endoftext", "12a34 5%6", "日本語テキスト é́", "🙂🙃 🙂", "a\r\n\r\nb\r", "\x00\x01\x1c\x1d a", "ﬁ‍  x",
          "'ll'lé 'tß 'sé", "....!!!???  ...", "AKIA1234 foo_bar-baz", "\n\né", "\t\té\n é", "   x "]


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(next(CODEC.encode([text])), "<u4").tolist()


@pytest.mark.parametrize("text", TRICKY)
def test_tricky_texts(text):
    assert ours(text) == ids_of(text)
    assert CODEC.decode(np.array(ids_of(text), "<u4")) == LIBRARY.decode(ids_of(text), skip_special_tokens=False) == text


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aAzé ß'\"sltdmrev\n\t\r  　 \x85.,!?<|endoftext>019日🙂\x1c_-"), max_size=40))
def test_random_texts(text):
    assert ours(text) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ours(text) == ids_of(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_any_ids_decode_alike(ids):
    assert CODEC.decode(np.array(ids, "<u4")) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_cuts_are_made():
    assert len(CODEC.fragments(b"many words, and some more; of them")) > 5


def test_forgets_fragments(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_FRAGMENTS", 3)
    monkeypatch.setattr(bpe, "ENCODE_AT_ONCE", 10)
    codec = Codec(PATH)
    texts = ["one two three four five", "six seven", "", "one two"]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [ids_of(t) for t in texts]


def test_round_trip(spark):
    rows = [*enumerate(TRICKY), (100, None), (None, "x"), (3, TRICKY[3]), (200, "very long é " * 60_000)]
    out = round_trip(clashing(documents(spark, rows)), PATH).collect()

    def row(i, text):
        ids = ids_of(text or "")
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())

    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, out), key=key) == sorted([row(*r) for r in rows], key=key)


def test_encode_then_decode(spark):
    docs = documents(spark, [*TRICKY, None])
    back = {r.doc_id: r.text for r in decode(encode(docs, PATH), PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate([*TRICKY, None])}


def test_empty_table(spark):
    assert round_trip(documents(spark, []), PATH).collect() == []
    assert decode(encode(documents(spark, []), PATH), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, TypeError, KeyError, AttributeError)):
        Codec(public_tokenizers.path("word_bpe_49k.json"))
