"""Packing of token sequences by minimum bin slack.

Only the lengths of the pieces matter for the plan, and there are at most `capacity` of them. The plan is therefore made
from one count per length: each bin takes the longest length left and fills its slack with the fullest combination of
available lengths, found by subset sums in a bitset; the same combination is taken again while the counts allow. This is
minimum bin slack over all pieces of the corpus, not over shards, at the cost of a table of `capacity` numbers.

The pieces themselves stay distributed: each gets its rank among those of its length from counts per shard, and the plan
says which bin and offset a rank has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from personweave.llm.bpe import codec
from personweave.sources.scratch import scratch_table

SHARD_ROWS = 1 << 18  # pieces of one length are counted and ranked in parts of about this many rows


def fullest(counts: dict[int, int], space: int) -> list[tuple[int, int]]:
    """(length, copies) with the largest sum that fits into `space`; `counts` has the lengths at hand."""
    reach, steps = 1, []
    mask = (1 << (space + 1)) - 1
    for length in sorted((x for x in counts if x <= space), reverse=True):
        copies = min(counts[length], space // length)
        before, took = reach, 1
        steps.append((length, copies, before))
        while copies:  # powers of two, then the rest: every number of copies is reached
            took = min(took, copies)
            reach |= (reach << (took * length)) & mask
            copies, took = copies - took, took * 2
        if reach >> space & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, copies, before in reversed(steps):
        for k in range(copies + 1):
            if total >= k * length and before >> (total - k * length) & 1:
                break
        if k:
            out.append((length, k))
            total -= k * length
    return out


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, copies per bin, first bin, bins, offset) sorted by length and rank; the number of bins."""
    left = {length: n for length, n in counts.items() if n > 0}
    given = dict.fromkeys(left, 0)
    rows, bins = [], 0
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = dict(fullest({k: n for k, n in rest.items() if n}, capacity - longest))
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // k for length, k in chosen.items())
        offset = 0
        for length, k in sorted(chosen.items(), reverse=True):
            rows.append((length, given[length], k, bins, times, offset))
            given[length] += k * times
            left[length] -= k * times
            if not left[length]:
                del left[length]
            offset += k * length
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6), bins


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids_crc32`, and `ids` if asked for: the ids of each text and `end_id`, cut
    into pieces of `capacity` from the end, so that only the first may be shorter."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            rows = []
            coded = c.encode(t.as_py() for t in batch["text"])
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), coded):
                ids += end
                n = len(ids) // 4
                edges = [0, *range(n - capacity * ((n - 1) // capacity), n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[4 * a:4 * b]
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(part), *([part] if with_ids else [])))
            columns = zip(*rows) if rows else [()] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)

    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"),
                        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return texts.mapInArrow(run, schema)


def _places(rules: np.ndarray, names: list[str]):
    """Bin and offset of every ranked piece. The rules of one length cover its ranks without a gap."""
    lengths, first, copies, first_bin, _, offset = rules.T if len(rules) else np.empty((6, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = int(first.max(initial=0)) + 1
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            # Rank beyond the last rule's first rank belongs to that rule: keep it within the stride.
            at = np.searchsorted(lengths * stride + first, length * stride + np.minimum(rank, stride - 1), side="right") - 1
            turn, slot = np.divmod(rank - first[at], copies[at])
            out = {"sequence_id": pa.array(first_bin[at] + turn), "offset": pa.array(offset[at] + slot * length)}
            yield pa.RecordBatch.from_arrays([out[n] if n in out else batch[n] for n in names], names)
    return run


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces with `doc_id`, `piece`, `length` (1 to `capacity`) and `ids_crc32`.

    Pieces of one length are interchangeable; they are ranked by id, piece and checksum. Repeated rows are packed as
    often as they occur. Rows without an id come first. The order of rows of one rank group never matters: they are equal.
    """
    pieces = scratch_table(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    if any(x is None or not 1 <= x <= capacity for x in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    rules, _ = plan(counts, capacity)
    # As many parts as a length needs, so that no task's rows grow with the corpus.
    parts = F.array(*[F.lit(-(-counts.get(x, 1) // SHARD_ROWS)) for x in range(1, capacity + 1)])
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(parts, F.col("length").cast("int"))))
    sizes = scratch_table(pieces.groupBy("length", "shard").count(), "piece_counts")
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    # Both sides are dealt by length and part; equal rows of one piece are the only ones that a part cannot be smaller than.
    ranked = (pieces.withColumn("rank", F.row_number().over(own) - 1).join(starts, ["length", "shard"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("shard", "before"))
    names = [*(c for c in pieces.columns if c != "shard"), "sequence_id", "offset"]
    types = dict(pieces.dtypes) | {"sequence_id": "bigint", "offset": "bigint"}
    return ranked.mapInArrow(_places(rules, names), ", ".join(f"{n} {types[n]}" for n in names))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """`token_pieces` of every row of `docs`, packed: one row per piece with its sequence and offset.

    Null counts as empty: the piece is `end_id` alone. An empty table gives an empty result; other columns are ignored.
    """
    return pack(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), capacity)
