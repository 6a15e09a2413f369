"""Jaro-Winkler similarity on Arrow batches."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_SCALE = 0.1
PREFIX_LENGTH = 4
BOOST_FROM = 0.7
LENGTH_CLASSES = (8, 16, 32)


def _codes(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fixed = texts.astype(str)
    width = max(fixed.dtype.itemsize // 4, 1)
    return fixed.view(np.uint32).reshape(len(fixed), width), np.char.str_len(fixed)


def _matched_in_order(codes: np.ndarray, flags: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(codes), width), dtype=np.uint32)
    rows, cols = np.nonzero(flags)
    out[rows, (np.cumsum(flags, axis=1) - 1)[rows, cols]] = codes[rows, cols]
    return out


def _jaro_parts(a: str, b: str) -> tuple[int, int]:
    """Common characters and transpositions of one pair, in one pass over each text."""
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    places: dict[str, deque[int]] = {}
    for i, c in enumerate(a):
        places.setdefault(c, deque()).append(i)
    taken, order = [], []
    for j, c in enumerate(b):
        free = places.get(c)
        while free and free[0] < j - window:
            free.popleft()
        if free and free[0] <= j + window:
            taken.append(free.popleft())
            order.append(c)
    taken.sort()
    return len(taken), sum(a[i] != c for i, c in zip(taken, order)) // 2


def _long_similarity(a: str, b: str) -> float:
    common, swaps = _jaro_parts(a, b)
    if not common:
        return 0.0
    jaro = (common / len(a) + common / len(b) + (common - swaps) / common) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:PREFIX_LENGTH], b[:PREFIX_LENGTH])) if x != y),
                  min(PREFIX_LENGTH, len(a), len(b)))
    return jaro + prefix * PREFIX_SCALE * (1 - jaro) if jaro >= BOOST_FROM else jaro


def jaro_winkler(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of aligned, non-null texts.

    Rows are taken by length class: the width of the arrays follows the class and not the longest value of the batch.
    Long texts are compared one pair at a time, in linear time.
    """
    longest = np.fromiter((max(len(a), len(b)) for a, b in zip(left, right)), np.int64, len(left))
    out = np.zeros(len(left))
    for low, high in zip((-1, *LENGTH_CLASSES), LENGTH_CLASSES):
        rows = np.flatnonzero((longest > low) & (longest <= high))
        if len(rows):
            out[rows] = _aligned(left[rows], right[rows])
    for i in np.flatnonzero(longest > LENGTH_CLASSES[-1]):
        out[i] = _long_similarity(left[i], right[i])
    return out


def _aligned(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One array operation handles one character position of all rows."""
    a, la = _codes(left)
    b, lb = _codes(right)
    n = len(a)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    reach = int(window.max(initial=0))
    flag_a = np.zeros(a.shape, dtype=bool)
    flag_b = np.zeros(b.shape, dtype=bool)
    for j in range(b.shape[1]):
        waiting = j < lb
        for i in range(max(0, j - reach), min(a.shape[1], j + reach + 1)):
            hit = waiting & ~flag_a[:, i] & (i < la) & (abs(i - j) <= window) & (a[:, i] == b[:, j])
            flag_a[:, i] |= hit
            flag_b[:, j] |= hit
            waiting &= ~hit
    common = flag_a.sum(axis=1)
    width = max(int(common.max(initial=0)), 1)
    swaps = (_matched_in_order(a, flag_a, width) != _matched_in_order(b, flag_b, width)).sum(axis=1) // 2
    some = common > 0
    m = np.where(some, common, 1)
    jaro = np.where(some, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - swaps) / m) / 3, 0.0)
    prefix = np.zeros(n, dtype=int)
    same = np.ones(n, dtype=bool)
    for i in range(min(PREFIX_LENGTH, a.shape[1], b.shape[1])):
        same &= (i < la) & (i < lb) & (a[:, i] == b[:, i])
        prefix += same
    return np.where(jaro >= BOOST_FROM, jaro + prefix * PREFIX_SCALE * (1 - jaro), jaro)


def similarity_column(left: Column, right: Column) -> Column:
    """Jaro-Winkler of two columns, null where either is null. Repeated pairs in a batch are computed once."""

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=a.index, dtype="float64")
        filled = a.notna() & b.notna()
        if filled.any():
            pairs = pd.DataFrame({"a": a[filled], "b": b[filled]})
            groups = pairs.groupby(["a", "b"], sort=False).ngroup()
            unique = pairs.drop_duplicates(["a", "b"])
            scores = jaro_winkler(unique["a"].to_numpy(), unique["b"].to_numpy())
            out[filled] = scores[groups.to_numpy()]
        return out

    # Declared nondeterministic so that the optimizer keeps filters where they are: cheap ones before the call, those
    # on its result after it, and no second evaluation.
    return similarity.asNondeterministic()(left, right)


def required_jaro(threshold: float, prefix: int) -> float:
    """Smallest Jaro value from which a common prefix of this length can still reach the threshold."""
    boosted = (threshold - PREFIX_SCALE * prefix) / (1 - PREFIX_SCALE * prefix)
    return min(threshold, max(boosted, BOOST_FROM))


def can_reach(left: Column, right: Column, threshold: float) -> Column:
    """False where lengths and first letter already rule the threshold out. Never false for a similar pair.

    Kept small: it is evaluated inside the join of candidate pairs, whose generated code must stay compilable.
    """
    def ratio(jaro: float) -> float:
        return 3 * jaro - 2 - 1e-9

    lengths = F.length(left), F.length(right)
    same_start = F.substr(left, F.lit(1), F.lit(1)) == F.substr(right, F.lit(1), F.lit(1))
    needed = F.when(same_start, F.lit(ratio(required_jaro(threshold, PREFIX_LENGTH)))).otherwise(
        F.lit(ratio(required_jaro(threshold, 0))))
    return F.least(*lengths) >= needed * F.greatest(*lengths)
