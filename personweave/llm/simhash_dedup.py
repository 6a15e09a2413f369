"""SimHash near-duplicates: byte-position inverted index, count filter, verification, components.

Two 64-bit fingerprints that differ in at most d bits differ in at most d of their 8 bytes, so they share at least 8 - d
bytes at the same positions. That minimum is guaranteed within any d + j positions as well: at least j of the first
d + j positions agree. The index therefore lists a fingerprint under every choice of j of these positions with their
bytes; j grows with the number of fingerprints so that lists stay short, and no pair is lost whatever j is. Within a
list, pairs are tallied (equal bytes of all 8) and verified (bits).

Rows with equal fingerprints are collapsed before any of this. A list yields a spanning forest of its links, not its
pairs, so the output is linear in the lists. Lists that would be long are cut into cells, and every two cells meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.operators.cluster import connected_components
from personweave.sources.scratch import scratch_table

SEED = 42
HASHES_AT_ONCE = 1 << 16
SMALL_LIST = 24
CELL_ROWS = 4096
SAMPLE_ROWS = 200_000
MIN_SAMPLED = 64
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of the shingles of a text, 0 if it has no word."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and the six ASCII white-space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[-n:] if len(words) >= shingle else ends[-1:]
    spans = zip(starts[:n].tolist(), ends.tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = hashes[at:at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """`doc_id`, `fp` (the fingerprint as a signed long) of every row; texts are read whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(marks.view(np.int64))], ["doc_id", "fp"])
    return (docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fp long"))


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def mark(texts: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)).view(np.int64))
    return mark(text.cast("string"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bytes_per_key(rows: int, distance: int) -> int:
    """So many bytes that random fingerprints would leave a list with about one entry."""
    return min(8 - distance, max(2, (max(rows, 1).bit_length() + 7) // 8))


def _postings(fps: DataFrame, distance: int, size: int) -> DataFrame:
    """`key`, `fp`: the fingerprint under each choice of `size` of the first `distance + size` byte positions."""
    keys = []
    for number, places in enumerate(combinations(range(distance + size), size)):
        key = F.lit(number).cast("long")
        for place in places:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * place).bitwiseAND(F.lit(255)))
        keys.append(key)
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _cells(postings: DataFrame, sample: DataFrame, share: float) -> DataFrame:
    """Add `cell`. Lists that a sample shows to be long are cut; each row then goes to every pair of cells with its own.

    The cut changes who compares a pair, never whether it is compared. The broadcast holds keys seen MIN_SAMPLED times or
    more among a bounded sample, hence a bounded number of them.
    """
    limit = max(MIN_SAMPLED, CELL_ROWS * share)
    hot = (sample.groupBy("key").count().where(F.col("count") > limit)
           .select("key", F.ceil(F.col("count") / (share * CELL_ROWS)).cast("long").alias("cells")))
    own = F.pmod(F.xxhash64("fp"), F.col("cells"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return (postings.join(F.broadcast(hot), "key", "left").withColumn("cells", F.coalesce("cells", F.lit(1).cast("long")))
            .withColumns({"own": own, "other": other})
            .select("key", (low * F.col("cells") + high).alias("cell"), "fp"))


def _linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Count filter, then verification: pairs that share fewer equal bytes than linked ones must are out before their
    bits are counted."""
    differ = a ^ b
    # The high bit of each byte that differs.
    unequal = (((differ & _LOW) + _LOW) | differ) & ~_LOW
    out = np.bitwise_count(unequal) <= distance  # at least 8 - distance equal bytes
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count(differ[at]) <= distance
    return out


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the links of one long list connect: search from fingerprint to fingerprint."""
    links, rest = [], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _linked(at, rest, distance)
            if near.any():
                found = rest[near]
                links += [(at, x) for x in found]
                queue += list(found)
                rest = rest[~near]
    return links


def _links_of(keys: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Links within lists; `keys` numbers the lists and is sorted."""
    out = []
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    sizes = np.diff(starts, append=len(keys))
    small = np.repeat(sizes <= SMALL_LIST, sizes)
    k, f = keys[small], fps[small]
    for step in range(1, min(SMALL_LIST, int(sizes.max()))):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        a, b = f[same], f[same + step]
        hit = _linked(a, b, distance)
        out.append(np.stack([a[hit], b[hit]], axis=1))
    for at, n in zip(starts[sizes > SMALL_LIST], sizes[sizes > SMALL_LIST]):
        if found := _forest(np.unique(fps[at:at + n]), distance):
            out.append(np.array(found, np.uint64))
    return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.uint64)


def _link_lists(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            key, cell = (table[c].to_numpy() for c in ("key", "cell"))
            change = (np.diff(key, prepend=key[0]) != 0) | (np.diff(cell, prepend=cell[0]) != 0)
            pairs = _links_of(np.cumsum(change), table["fp"].to_numpy().view(np.uint64), distance).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)],
                                              ["left_id", "right_id"])

        for batch in batches:  # sorted: only the last list of what is held can go on in the next batch
            if not batch.num_rows:
                continue
            held.append(batch)
            last = (batch["key"][-1], batch["cell"][-1])
            if held[0]["key"][0] == last[0] and held[0]["cell"][0] == last[1]:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key, cell = table["key"].to_numpy(), table["cell"].to_numpy()
            end = int(np.flatnonzero((key != key[-1]) | (cell != cell[-1]))[-1]) + 1
            yield flush(table.slice(0, end))
            held = table.slice(end).combine_chunks().to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))
    return run


def _components(fps: DataFrame, distance: int, bytes_per_key: int | None) -> DataFrame:
    """`fp`, `component`, `component_id` of the distinct fingerprints `fp` with their smallest id `rep`."""
    if not 0 <= distance <= 6:
        raise ValueError("distance must be from 0 to 6")
    total = fps.count()
    size = bytes_per_key or _bytes_per_key(total, distance)
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else fps
    lists = _cells(_postings(fps.select("fp"), distance, size), _postings(sample.select("fp"), distance, size), share)
    links = (lists.repartition("key", "cell").sortWithinPartitions("key", "cell")
             .mapInArrow(_link_lists(distance), "left_id long, right_id long"))
    parts = scratch_table(connected_components(fps.select("fp"), links, "fp"), "components")
    least = parts.join(fps, "fp").groupBy("component").agg(F.min("rep").alias("component_id"))
    return parts.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, bytes_per_key: int | None = None) -> DataFrame:
    """`doc_id`, `fingerprint`, `component_id` for every row of `docs`.

    Fingerprints link if they differ in at most `distance` bits (0 to 6). `component_id` is the smallest id that links
    lead to, the row's own included; it is null only if no row of the component has an id.

    Null and empty texts have fingerprint zero and link like any other. Fewer words than `shingle` make one shingle.
    Repeated rows give repeated results. An empty table gives an empty result; other columns are ignored.
    """
    rows = scratch_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = scratch_table(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct_fingerprints")
    named = _components(fps, distance, bytes_per_key)
    return rows.join(named, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                          distance: int = 3, bytes_per_key: int | None = None) -> DataFrame:
    """The rows of `docs` that remain if one row of each component of `near_duplicates` stays: that with the smallest id,
    of rows with equal ids or none any one. Rows are told apart by themselves, not by their ids. All columns are kept."""
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), record,
                       fingerprint_column(docs[f"`{text_col}`"], shingle).alias("fp"))
    rows = scratch_table(rows.withColumn("row", F.monotonically_increasing_id()), "marked_rows", "zstd")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")).alias("first")
    fps = scratch_table(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), first), "distinct_fingerprints")
    named = _components(fps.select("fp", "rep"), distance, bytes_per_key)
    stays = fps.join(named, "fp").groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    # The list of dropped rows is written first: its size is then known, and a short one is sent to the texts.
    dropped = scratch_table(rows.select("row").join(stays, "row", "left_anti"), "dropped")
    return rows.join(dropped, "row", "left_anti").select("record.*")
