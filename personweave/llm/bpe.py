"""Byte-level BPE by forced-boundary splitting.

A pair of bytes that occurs inside no vocabulary token can never be merged, so a token ends between them. Cuts at such
pairs are certain, the fragments are encoded independently, once per distinct fragment of a task, and their ids are
concatenated. A cut must also leave the pre-tokenizer's matches as they are. Its pattern has no look-behind, so only
three places are unsafe and left uncut: after white space (its look-ahead and the space before a word), before an
apostrophe (contractions), and inside a character.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_FRAGMENTS = 150_000  # of each of two generations
FRAGMENTS_AT_ONCE = 1 << 19
ENCODE_AT_ONCE = 2 << 20  # bytes of text
WORDS_AT_ONCE = 500
DECODE_AT_ONCE = 1 << 18
# Unicode white space beyond ASCII, as the last (up to three) bytes in UTF-8.
WIDE_SPACE = np.array([0xC285, 0xC2A0, 0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
_LAST = np.isin(np.arange(256), WIDE_SPACE & 0xFF)
_BUT_LAST = np.isin(np.arange(256), WIDE_SPACE >> 8 & 0xFF)


def byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write: printable Latin-1 as itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec["normalizer"] or spec["pre_tokenizer"].items() < byte_level.items() or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: not a byte-level BPE vocabulary")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet, added = byte_alphabet(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in added}
        tokens |= {i: t.encode() for t, i in added.items()}
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        joined = np.zeros((256, 256), bool)
        for token in table:
            pairs = np.frombuffer(token, np.uint8)
            joined[pairs[:-1], pairs[1:]] = True
        first, second = np.arange(256)[:, None], np.arange(256)[None, :]
        unsafe = (first <= 0x20) | (second == ord("'")) | ((second >= 0x80) & (second < 0xC0))
        self.cut = ~(joined | unsafe)
        self.starts_word = np.array([t[:1] == b" " for t in table])
        # Words that may be encoded side by side: one space, no other white space, a certain cut before the next space.
        ends = "".join(re.escape(chr(i)) for i in range(256) if self.cut[i, 0x20] and not _LAST[i])
        self.is_word = re.compile(f" [^\\s\x1c-\x20]*[{ends}]".encode("latin-1"), re.DOTALL).fullmatch
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        if array("I", [1]).tobytes() != np.array([1], "<u4").tobytes():
            raise RuntimeError("ids are kept as little-endian 32-bit integers")

    def cuts(self, b: np.ndarray) -> np.ndarray:
        """The places of certain cuts in UTF-8."""
        at = np.flatnonzero(self.cut[b[:-1], b[1:]]) + 1
        wide = np.flatnonzero(_LAST[b[at - 1]] & _BUT_LAST[b[np.maximum(at - 2, 0)]])
        if len(wide):
            place = at[wide]
            two = (b[place - 2].astype(np.int64) << 8) | b[place - 1]
            three = (b[np.maximum(place - 3, 0)].astype(np.int64) << 16) | two
            at = np.delete(at, wide[np.isin(two, WIDE_SPACE) | np.isin(three, WIDE_SPACE)])
        return at

    def fragments(self, data: bytes) -> list[bytes]:
        """The pieces of `data` between certain cuts."""
        at = self.cuts(np.frombuffer(data, np.uint8)).tolist()
        return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])]

    def _ids(self, fragments: list[bytes]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([p.decode() for p in fragments], add_special_tokens=False)
        return [array("I", code.ids).tobytes() for code in coded]

    def _learn(self, fragments: list[bytes]) -> None:
        self.known.update(zip(fragments, self._ids(fragments)))

    def _learn_words(self, words: list[bytes]) -> None:
        """Words are encoded many at a time: between them are certain cuts, and only their first tokens start with a space."""
        runs = [words[i:i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        for run, code in zip(runs, self._ids([b"".join(r) for r in runs])):
            at = (4 * np.flatnonzero(self.starts_word[np.frombuffer(code, "<u4")])).tolist()
            if len(at) == len(run):
                self.known.update(zip(run, [code[a:b] for a, b in zip(at, [*at[1:], len(code)])]))
            else:  # a special token spelled out among them
                self._learn(run)

    def _of(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of distinct fragments, from the library for those not seen lately."""
        if len(self.known) > KNOWN_FRAGMENTS:  # distinct fragments grow with the data: keep what was used lately
            self.known, self.older = {}, self.known
        new = []
        for part in distinct:
            if part not in self.known:
                if part in self.older:
                    self.known[part] = self.older[part]
                else:
                    new.append(part)
        self._learn_words([p for p in new if self.is_word(p)])
        self._learn([p for p in new if p not in self.known])
        return [self.known[p] for p in distinct]

    def _encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Texts end to end: fragments are slices of one buffer, numbered by Arrow, and their ids are gathered."""
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        # A text ends in any case; what a cut next to it looks back at is a whole character of the text before.
        cut = np.zeros(len(data) + 1, bool)
        cut[self.cuts(np.frombuffer(data, np.uint8))] = cut[ends] = cut[0] = True
        edges = np.flatnonzero(cut).astype("<i8")
        parts, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for first in range(0, len(edges) - 1, FRAGMENTS_AT_ONCE):
            own = edges[first:first + FRAGMENTS_AT_ONCE + 1]
            numbered = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(own) - 1, [None, pa.py_buffer(own.tobytes()), pa.py_buffer(data)]).dictionary_encode()
            codes = self._of(numbered.dictionary.to_pylist())
            which = numbered.indices.to_numpy()
            length = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
            count = length[which]
            shift = np.repeat((np.cumsum(length) - length)[which] - (np.cumsum(count) - count), count)
            parts.append(np.frombuffer(b"".join(codes), "<u4")[shift + np.arange(len(shift))])
            sizes.append(count)
        ids = np.concatenate(parts)
        before = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        stop = before[np.searchsorted(edges, ends)].tolist()
        for a, b in zip([0, *stop], stop):
            yield ids[a:b].tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        held, size = [], 0
        for text in texts:
            held.append(text.encode())
            size += len(held[-1])
            if size >= ENCODE_AT_ONCE:
                yield from self._encode(held)
                held, size = [], 0
        if held:
            yield from self._encode(held)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        out = []
        for at in range(0, len(ids), DECODE_AT_ONCE):
            part = ids[at:at + DECODE_AT_ONCE].astype(np.int64)
            part = part[part < len(self.sizes)]
            sizes = self.sizes[part]
            shift = np.repeat(self.starts[part] - (np.cumsum(sizes) - sizes), sizes)
            out.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"),
                       F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens`, `ids` (little-endian unsigned 32-bit integers) of every row, no special tokens added.

    `tokenizer` is the path of a byte-level BPE file that every executor can read. Special tokens that a text spells out
    become their ids, as the library has it. Null counts as empty and gives no ids; repeated rows give repeated results;
    an empty table gives an empty result; other columns are ignored. Texts are encoded whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            ids = list(c.encode(t.as_py() for t in batch["text"]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])
    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id`, `text` of every row of ids as `encode` writes them; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            texts = [c.decode(np.frombuffer(x.as_py(), "<u4")) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])
    ids = F.coalesce(encoded[f"`{ids_col}`"], F.lit(b""))
    return encoded.select(encoded[f"`{id_col}`"].cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256`: digests of the ids and of the text decoded from them.

    The same cases as in `encode`; both directions happen in one pass, so that ids need not be written out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            rows = []
            for ids in c.encode(t.as_py() for t in batch["text"]):
                back = c.decode(np.frombuffer(ids, "<u4")).encode()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
            n, coded, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
