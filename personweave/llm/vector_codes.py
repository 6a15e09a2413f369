"""Product quantisation of vectors, entries found with a geometric near-neighbour access tree (GNAT).

Vectors become integers and are cut into parts; every part position has its own codebook. A tree over the entries of a
codebook answers which entry is nearest: each node keeps some entries as split points and, for every split point and
every child, the range of distances from the point to the child's entries. A query's distances to the split points
rule out a child if its ball cannot reach one of these ranges.

Distances that decide are squared integers, so results are exact. Square roots only rule out, strictly and with a
margin wider than their rounding; entries at equal distance are never ruled out, and the lower index wins.

Codebooks are refined by partial sums: a task emits one row per entry, whatever its rows, and the driver gets one row
per entry. Codebooks have a fixed size and travel with the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.sources.scratch import scratch_table

QUERIES_AT_ONCE = 1 << 14
LIMIT = 1 << 28  # of a component: squared distances of parts of up to 32 components then fit into 64 bits
MARGIN = 2.0 ** -40
HOT_LABELS = 1000


def _distances(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    out = np.zeros((len(queries), len(entries)), np.int64)
    for i in range(queries.shape[1]):
        out += (queries[:, i, None] - entries[None, :, i]) ** 2
    return out


@dataclass
class _Node:
    points: np.ndarray  # indexes of the split points, ascending; all entries of a leaf
    children: list["_Node | None"]
    low: np.ndarray  # by split point and child: least and greatest distance to an entry of the child
    high: np.ndarray


class Gnat:
    """Nearest entry of a codebook of integer vectors, ties to the lower index."""

    def __init__(self, entries: np.ndarray, fanout: int = 6, leaf: int = 8):
        self.entries, self.fanout, self.leaf = np.asarray(entries, np.int64), fanout, leaf
        self.measured = 0  # distances computed, for tests and reports
        self.root = self._build(np.arange(len(self.entries)))

    def _build(self, members: np.ndarray) -> _Node:
        none = np.empty((0, 0))
        if len(members) <= self.leaf:
            return _Node(members, [], none, none)
        own = self.entries[members]
        # Split points far from each other: the next one is the farthest from those so far.
        chosen, nearest = [0], _distances(own, own[:1])[:, 0]
        while len(chosen) < self.fanout and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(own, own[chosen[-1:]])[:, 0])
        if len(chosen) == 1:  # equal entries: the lowest index answers for all
            return _Node(members[:1], [], none, none)
        chosen = sorted(chosen)
        apart = _distances(own, own[chosen])
        side = apart.argmin(axis=1)
        side[chosen] = -1
        low, high = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(chosen)))
        children: list[_Node | None] = []
        for j in range(len(chosen)):
            inside = np.flatnonzero(side == j)
            children.append(self._build(members[inside]) if len(inside) else None)
            if len(inside):
                low[:, j], high[:, j] = np.sqrt(apart[inside].min(axis=0)), np.sqrt(apart[inside].max(axis=0))
        return _Node(members[chosen], children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance to it, for each row of integers."""
        index, best = np.zeros(len(queries), np.int64), np.full(len(queries), np.iinfo(np.int64).max)
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            part = slice(at, at + QUERIES_AT_ONCE)
            rows = np.ascontiguousarray(queries[part], np.int64)
            self._visit(self.root, rows, np.arange(len(rows)), index[part], best[part])
        return index, best

    def _visit(self, node: _Node, queries: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        squared = _distances(queries[rows], self.entries[node.points])
        self.measured += squared.size
        column = squared.argmin(axis=1)
        distance, found = squared[np.arange(len(rows)), column], node.points[column]
        better = (distance < best[rows]) | ((distance == best[rows]) & (found < index[rows]))
        best[rows[better]], index[rows[better]] = distance[better], found[better]
        away = np.sqrt(squared)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            radius = np.sqrt(best[rows])[:, None]
            slack = MARGIN * (1 + away + radius + node.high[:, j])
            out = (away - radius > node.high[:, j] + slack) | (away + radius < node.low[:, j] - slack)
            rest = rows[~out.any(axis=1)]
            if len(rest):
                self._visit(child, queries, rest, index, best)


def integers(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """`vec_id`, `label`, `w` (integers) of the rows whose vector is there and finite throughout."""
    v = vectors[f"`{vector_col}`"]
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.where(v.isNotNull() & finite)
            .select(vectors[f"`{id_col}`"].cast("long").alias("vec_id"), vectors[f"`{label_col}`"].alias("label"),
                    F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("w")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(column) or (len(column) and np.any(np.diff(column.offsets.to_numpy()) != width)):
        raise ValueError(f"all vectors must have {width} components")
    if len(flat) and max(int(flat.max()), -int(flat.min())) >= LIMIT:
        raise ValueError(f"components must stay below {LIMIT} once scaled")
    return flat.reshape(len(column), width)


def _sums(codebooks: list[np.ndarray], width: int):
    """Per task one row for each entry in use: part, entry, number of parts, sum of each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width // len(codebooks)
        trees = [Gnat(entries) for entries in codebooks]
        counts = [np.zeros(len(e), np.int64) for e in codebooks]
        totals = [np.zeros((len(e), size), np.int64) for e in codebooks]
        for batch in batches:
            rows = _matrix(batch["w"], width)
            for p, tree in enumerate(trees):
                part = rows[:, p * size:(p + 1) * size]
                near, _ = tree.nearest(part)
                counts[p] += np.bincount(near, minlength=len(counts[p]))
                np.add.at(totals[p], near, part)
        for p, (n, total) in enumerate(zip(counts, totals)):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]),
                 *[pa.array(total[used, i]) for i in range(size)]], ["part", "entry", "n", *[f"s{i}" for i in range(size)]])
    return run


def refined(kept: DataFrame, codebooks: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Each entry replaced by the floor of the mean of the parts assigned to it; unused entries stay."""
    size = width // len(codebooks)
    names = [f"s{i}" for i in range(size)]
    sums = (kept.select("w").mapInArrow(_sums(codebooks, width), "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names))
            .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]))
    out = [entries.copy() for entries in codebooks]
    for row in sums.collect():  # one row per entry
        out[row["part"]][row["entry"]] = [row[c] // row["n"] for c in names]
    return out


def _codes(codebooks: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width // len(codebooks)
        trees = [Gnat(entries) for entries in codebooks]
        for batch in batches:
            rows = _matrix(batch["w"], width)
            found = [tree.nearest(rows[:, p * size:(p + 1) * size]) for p, tree in enumerate(trees)]
            codes = np.stack([near for near, _ in found], axis=1).astype(np.uint8)
            error = np.sum([away for _, away in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error)], ["vec_id", "label", "code", "error"])
    return run


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add `label_error`, the errors of all rows of an equal label, nulls together.

    Labels with more than a thousandth of all rows are fewer than a thousand: these are broadcast, so no task gets the
    rows of a frequent label. The rows of the others meet their sums by label.
    """
    totals = scratch_table(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label_errors")
    rows = totals.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT_LABELS > rows

    def sums(where: Column) -> DataFrame:
        return totals.where(where).select(F.col("label").alias("of_label"), "label_error")

    met = coded.join(F.broadcast(sums(often)), F.col("label").eqNullSafe(F.col("of_label")), "left")
    columns = [*coded.columns, "label_error"]
    others = met.where(F.col("label_error").isNull()).select(*coded.columns).join(sums(~often), F.col("label").eqNullSafe(F.col("of_label")))
    return met.where(F.col("label_error").isNotNull()).select(*columns).unionByName(others.select(*columns))


def codebook_text(codebooks: list[np.ndarray]) -> str:
    """All entries' components in decimal by part, entry and position, joined by commas."""
    return ",".join(str(x) for entries in codebooks for x in entries.ravel().tolist())


def compress(vectors: DataFrame, scale: int = 256, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """`vec_id`, `label`, `code`, `error` of every usable row, and the final codebooks.

    Rows whose vector is null, or holds null or non-finite components, are dropped. Codebooks start as the parts of the
    `entries` smallest ids (of repeated ids the smaller vector first; rows without an id are coded, but start nothing)
    and are refined `rounds` times. With fewer rows they have fewer entries. Repeated rows get equal results, ties go to
    the lower index, and an empty table gives an empty result without codebooks. Other columns are ignored. Vectors of
    unlike lengths, or of one that `parts` does not divide, and components beyond LIMIT are errors.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = scratch_table(integers(vectors, scale, id_col, vector_col, label_col), "vectors")
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kept.schema["label"].dataType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    first = kept.where("vec_id is not null").orderBy("vec_id", "w").select("w").limit(entries).collect()
    if not first:
        if not kept.isEmpty():
            raise ValueError("no row has an id to start the codebooks with")
        return kept.sparkSession.createDataFrame([], schema), []
    width = len(first[0]["w"])
    if not width or width % parts:
        raise ValueError(f"vectors must have a multiple of {parts} components")
    if any(len(r["w"]) != width for r in first):
        raise ValueError(f"all vectors must have {width} components")
    start = np.array([r["w"] for r in first], np.int64)
    codebooks = np.split(start, parts, axis=1)
    for _ in range(rounds):
        codebooks = refined(kept, codebooks, width)
    return kept.mapInArrow(_codes(codebooks, width), schema), codebooks


def vector_codes(vectors: DataFrame, **settings) -> DataFrame:
    """`vec_id`, `code`, `error`, `label_error`, `codebooks_sha256` for every usable row; cases and settings as in `compress`."""
    coded, codebooks = compress(vectors, **settings)
    digest = hashlib.sha256(codebook_text(codebooks).encode()).hexdigest()
    return (with_label_error(scratch_table(coded, "vector_codes"))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
