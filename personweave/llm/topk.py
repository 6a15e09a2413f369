"""Exact top-k by inner product, exhaustively, term at a time.

Components are terms. A block of candidates is an inverted index: for each term the candidates with a non-zero weight.
A query row is sparse: its non-zero terms. Each term of a query scatters its weighted postings into the query's dense row
of scores; the best k of the block are selected and blocks are merged.

Queries and candidates are dealt into blocks of bounded size, and every block of queries meets every block of candidates
in a group of its own, so the work is spread over as many tasks as there are pairs of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _matrix(column: pa.ChunkedArray, terms: int) -> np.ndarray:
    """Rows of lists as a matrix; components that a shorter vector lacks are zero."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), terms), np.int64)
    out[np.arange(terms)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores of all queries, accumulated term by term from the postings."""
    out = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(queries.shape[1]):
        asking = np.flatnonzero(queries[:, term])
        posted = np.flatnonzero(candidates[:, term])
        if len(asking) and len(posted):
            weights = candidates[posted, term]
            for q in asking:
                out[q, posted] += queries[q, term] * weights
    return out


def _best(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            terms = max(int(np.diff(t["weights"].combine_chunks().offsets.to_numpy()).max()) for t in (left, right))
            asked, found = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            order = np.argsort(found, kind="stable")  # then ties go to the smaller id
            found = found[order]
            score = scores(_matrix(left["weights"], terms), _matrix(right["weights"], terms)[order])
            for row, query in zip(score, asked):
                own = found != query
                ids, row = found[own], row[own]
                if len(row) > k:
                    cut = np.partition(row, len(row) - k)[len(row) - k]
                    keep = np.flatnonzero(row >= cut)
                    keep = keep[np.argsort(-row[keep], kind="stable")][:k]
                else:
                    keep = np.arange(len(row))
                for to, values in zip(columns, (np.full(len(keep), query), ids[keep], row[keep])):
                    to.append(values)
        return pa.table({n: pa.array(np.concatenate(c) if c else [], pa.int64())
                         for n, c in zip(("query_id", "vec_id", "score"), columns)})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for every row with `is_query` the `k` highest inner products among all other
    rows, ties to the smaller id.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows without an id. Missing
    components of shorter vectors count as zero, an empty vector scores 0 everywhere. Repeated rows of an id are candidates
    each, but never of their own id; a repeated query is answered once. Fewer than `k` candidates are all returned.
    An empty table gives an empty result; other columns are ignored. Scores are 64-bit integers.
    """
    vector = vectors[f"`{vector_col}`"]
    rows = (vectors.select(vectors[f"`{id_col}`"].cast("long").alias("vec_id"), vector.alias("vector"), is_query.alias("asks"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
            .select("vec_id", quantised(F.col("vector"), scale).alias("weights"), "asks"))
    queries = rows.where("asks").dropDuplicates(["vec_id"]).select("vec_id", "weights")
    n_queries, n_rows = queries.count(), rows.count()
    q_blocks, c_blocks = -(-max(n_queries, 1) // query_block), -(-max(n_rows, 1) // candidate_block)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select("vec_id", "weights", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).alias("q"), each(c_blocks).alias("c"))
    # Repeated ids are spread as well: the block depends on the whole row.
    right = rows.select("vec_id", "weights", F.pmod(F.xxhash64("vec_id", "weights", F.monotonically_increasing_id()), F.lit(c_blocks)).alias("c"),
                        each(q_blocks).alias("q"))
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(
        _best(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
