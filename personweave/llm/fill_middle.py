"""Fill-in-the-middle transformation: cuts located with a wavelet matrix over character classes.

The bytes of a batch of texts get one class each: inside a character, character, word start, line start. A wavelet matrix
over the classes answers how many bytes of a class precede a place (rank) for all texts at once. Ranks of several classes
add up to the number of units (characters, words or lines) that begin before a place, and bisection on that number finds
the place of a cut. Nothing is decoded, and a matrix takes about half a byte per byte of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSIDE, PLAIN, WORD, LINE, WORD_AND_LINE = range(5)
UNITS = {"char": (PLAIN, WORD, LINE, WORD_AND_LINE), "word": (WORD, WORD_AND_LINE), "line": (LINE, WORD_AND_LINE)}
LEVELS = 3
MARKS = ("<P>", "<S>", "<M>")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class _Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[:len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks over a sequence of classes below 2 ** LEVELS."""

    def __init__(self, classes: np.ndarray):
        self.size, self.levels, rest = len(classes), [], classes
        for level in reversed(range(LEVELS)):
            one = (rest >> level & 1).astype(bool)
            self.levels.append(_Bits(one))
            rest = np.concatenate((rest[~one], rest[one]))

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many of the first `at` places hold the class `kind`."""
        start, end = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for bits, level in zip(self.levels, reversed(range(LEVELS))):
            if kind >> level & 1:
                start, end = bits.zeros + bits.ones(start), bits.zeros + bits.ones(end)
            else:
                start, end = start - bits.ones(start), end - bits.ones(end)
        return end - start

    def count(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first `at` places hold one of the classes."""
        return sum(self.rank(kind, at) for kind in kinds)

    def find(self, kinds: tuple[int, ...], number: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of one of the classes with `number` of them before it; `high` if there is none between `low` and `high`."""
        low, high = low.copy(), high.copy()
        while np.any(low < high):  # least place such that more than `number` lie up to and with it
            middle = (low + high) >> 1
            enough = self.count(kinds, np.minimum(middle + 1, self.size)) > number
            high, low = np.where(enough & (low < high), middle, high), np.where(~enough & (low < high), middle + 1, low)
        return low


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte; `starts` are the places where texts begin."""
    lead = (data & 0xC0) != 0x80
    space = _SPACE[data]
    previous_space, previous_line = np.ones(len(data), bool), np.ones(len(data), bool)
    previous_space[1:], previous_line[1:] = space[:-1], data[:-1] == 10
    first = starts[starts < len(data)]
    previous_space[first], previous_line[first] = True, True
    word, line = lead & ~space & previous_space, lead & previous_line
    return np.where(lead, PLAIN + word * (WORD - PLAIN) + line * (LINE - PLAIN), INSIDE).astype(np.uint8)


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers of 32 bits that belong to an id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the places where its texts begin and the last one ends."""
    _, offsets, data = column.buffers()
    wide = "<i8" if pa.types.is_large_string(column.type) else "<i4"
    edges = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or edges[0] == edges[-1]:
        return np.empty(0, np.uint8), edges - edges[0]
    return np.frombuffer(data, np.uint8)[edges[0]:edges[-1]], edges - edges[0]


def _cut(unit: str, plain_percent: int, spm_percent: int, seed: str, marks: tuple[str, str, str]):
    before, after, between = (m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, edges = _texts(batch["text"])
            start, end = edges[:-1], edges[1:]
            matrix = WaveletMatrix(classes(data, start))
            kinds, chars = UNITS[unit], UNITS["char"]
            h = np.array([draws(x, seed) for x in batch["doc_id"].to_pylist()], np.int64)
            base, first_char = matrix.count(kinds, start), matrix.count(chars, start)
            n = matrix.count(kinds, end) - base
            cuts = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
            # No unit is before the first cut place, also where a text begins with white space.
            places = [np.where(k > 0, matrix.find(kinds, base + k, start, end), start) for k in cuts.T]
            counts = [matrix.count(chars, place) - first_char for place in places]
            rows = []
            for i in range(batch.num_rows):
                a, b, c, d = int(start[i]), int(places[0][i]), int(places[1][i]), int(end[i])
                text = data[a:d].tobytes()
                if not text or h[i, 2] % 100 >= 100 - plain_percent or any(m in text for m in (before, after, between)):
                    rows.append(("plain", None, None, text))
                    continue
                prefix, middle, suffix = text[:b - a], text[b - a:c - a], text[c - a:]
                if spm := h[i, 3] % 100 < spm_percent:
                    out = b"".join((after, suffix, before, prefix, between, middle))
                else:
                    out = b"".join((before, prefix, after, suffix, between, middle))
                rows.append(("spm" if spm else "psm", int(counts[0][i]), int(counts[1][i] - counts[0][i]), out))
            form, prefix_chars, middle_chars, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64()),
                 pa.array(middle_chars, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, unit: str = "char", plain_percent: int = 10, spm_percent: int = 20, seed: str = "1",
                   marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n`, `form`, `prefix_chars`, `middle_chars`, `output` for every row of `docs`.

    A text of `n` units (`char`, `word` or `line`) is cut at two places that its id and `seed` choose among `n` + 1. The
    form is `psm` (marks before prefix, suffix and middle) or `spm` (suffix first); texts that are empty, that hold a
    mark, or that the id chooses stay as they are (`plain`, no cut). Words begin after white space, lines after a line
    feed; what stands between two units belongs to the earlier one, and what stands before the first to the prefix unless
    that is empty.

    Null counts as empty. A row without an id draws as if the id were written as nothing. Repeated rows give repeated
    results, an empty table an empty one; other columns are ignored. Texts are cut whole, whatever their length.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"),
                        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(_cut(unit, plain_percent, spm_percent, seed, marks),
                            "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of `fill_in_middle` was made from."""
    before, after, between = marks
    head, middle = F.substring_index(output, between, 1), F.substring_index(output, between, -1)
    # The outer mark opens the output; the other one stands once before the middle.
    psm = F.concat(F.substr(F.substring_index(head, after, 1), F.lit(len(before) + 1)), middle, F.substring_index(head, after, -1))
    spm = F.concat(F.substring_index(head, before, -1), middle, F.substr(F.substring_index(head, before, 1), F.lit(len(after) + 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(cut: DataFrame) -> DataFrame:
    """The result of `fill_in_middle` with digests of the outputs and of the texts restored from them."""
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
