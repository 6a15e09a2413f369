"""Similar values of one vocabulary: a similarity join on shared signatures instead of all pairs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.functions.similarity import PREFIX_LENGTH, can_reach, required_jaro, similarity_column
from personweave.sources.scratch import scratch_table
from personweave.spec import LOWEST_THRESHOLD

# Letters from rare to common. Any fixed order gives the same result; a good one gives fewer candidates.
_RARE_FIRST = "jqxzwvkfybhgmpudclotnraise "

# A signature holds up to three tokens, and a text gets at most so many per length of its partner.
MAX_TOKENS = 3
MAX_KEYS = 40

# Values of one signature that meet in one group; a longer list is cut into cells, every two of which meet.
CELL_ROWS = 2_000


def _tokens(text: Column) -> Column:
    """Characters numbered by occurrence, rarest first."""
    ranked = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.struct(
        F.instr(F.lit(_RARE_FIRST), c).alias("rank"), c.alias("c"))))
    return F.transform(ranked, lambda t, i: F.concat(t["c"], (i + 2 - F.array_position(ranked, t)).cast("string")))


def _tokens_per_key(surplus: Column, overlap: Column) -> Column:
    """How many tokens one signature holds: more are more selective, as long as a text does not get too many keys.

    `surplus` is the longer length minus the overlap: of surplus + k tokens, every k make a key.
    """
    size = F.lit(1)
    for k in range(2, MAX_TOKENS + 1):
        keys = reduce(lambda x, y: x * y, [surplus + i for i in range(1, k + 1)]) / math.factorial(k)
        size = F.when((overlap >= k) & (keys <= MAX_KEYS), k).otherwise(size)
    return size


def _combinations(tokens: Column, size: int) -> Column:
    """Every choice of `size` of the tokens, in order, as one text each."""
    if size == 1:
        return tokens
    return F.flatten(F.transform(tokens, lambda t, i: F.transform(
        _combinations(F.slice(tokens, i + 2, F.size(tokens)), size - 1), lambda rest: F.concat(t, F.lit(" "), rest))))


def signatures(values: DataFrame, threshold: float, lengths: list[int]) -> DataFrame:
    """`values` (`field`, `value`) with one row per `signature`; two similar values share at least one.

    Jaro >= J needs m common characters with m/len1 + m/len2 >= 3J - 1, hence for each pair of lengths a least
    overlap. Texts with that overlap have k tokens in common among their first len - overlap + k tokens, so each
    combination of k of those is a key. `lengths` are those that occur.
    """
    length, other = F.col("_length"), F.col("_other")
    parts = []
    # Without a common first character there is no prefix boost, so a higher Jaro value is needed.
    for prefix in (PREFIX_LENGTH, 0):
        needed = 3 * required_jaro(threshold, prefix) - 1
        # m cannot exceed the shorter length, which bounds the other length from both sides if J is above 2/3.
        bounded = needed > 1 + 1e-9
        shortest, longest = (length * (needed - 1) - 1e-9, length / (needed - 1) + 1e-9) if bounded else (F.lit(1), F.lit(max(lengths, default=1)))
        partners = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: (n >= shortest) & (n <= longest))
        label = F.substr("value", F.lit(1), F.lit(1)) if prefix else F.lit("")
        parts.append(values.select("field", "value", label.alias("_label"), F.length("value").alias("_length"), F.lit(needed).alias("_needed"))
                     .withColumn("_other", F.explode(partners)))
    each = reduce(DataFrame.unionByName, parts).withColumns({
        "_overlap": F.ceil(F.col("_needed") / (1 / length + 1 / other) - 1e-9),
        "_longer": F.greatest(length, other)})
    each = each.where(F.col("_overlap") <= F.least(length, other))
    each = each.withColumn("_size", _tokens_per_key(F.col("_longer") - F.col("_overlap"), F.col("_overlap")))
    first = F.slice(_tokens(F.col("value")), F.lit(1), (length - F.col("_overlap") + F.col("_size")).cast("int"))
    each = each.withColumn("_first", first)
    chosen = F.when(F.col("_size") == 1, _combinations(F.col("_first"), 1))
    for k in range(2, MAX_TOKENS + 1):
        chosen = chosen.when(F.col("_size") == k, _combinations(F.col("_first"), k))
    # A hash is short to shuffle; a collision only gives one more candidate.
    keyed = each.select("field", "value", "_label", F.least(length, other).alias("_shorter"), "_longer", F.explode(chosen).alias("_key"))
    return keyed.select("field", "value", F.xxhash64("_label", "_shorter", "_longer", "_key").alias("signature")).distinct()


def signature_cells(keyed: DataFrame) -> DataFrame:
    """`keyed` with `first`, `second` and `cell`: a list above `CELL_ROWS` values is cut into cells, and each value goes to the
    group of its cell with every other cell. No group holds more than two cells, whatever share of the values a signature has.
    """
    long = (keyed.groupBy("field", "signature").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CELL_ROWS)
            .select("field", "signature", F.ceil(F.col("_n") / CELL_ROWS).cast("int").alias("_cells")))
    cells = F.coalesce("_cells", F.lit(1))
    placed = keyed.join(long, ["field", "signature"], "left").withColumn("cell", F.pmod(F.hash("value"), cells))
    placed = placed.withColumn("_with", F.explode(F.sequence(F.lit(0), cells - 1)))
    return placed.select("field", "signature", "value", "cell", F.least("cell", "_with").alias("first"),
                         F.greatest("cell", "_with").alias("second"))


def similar_values(values: DataFrame, threshold: float) -> DataFrame:
    """Pairs v < w of distinct values of one field with Jaro-Winkler similarity >= threshold.

    `values` has `field`, `value`; the result has `field`, `v`, `w`, `similarity`.
    """
    if threshold < LOWEST_THRESHOLD:
        raise ValueError(f"threshold must be at least {LOWEST_THRESHOLD}")
    distinct = scratch_table(values.where(F.length("value") > 0).select("field", "value").distinct(), "vocabulary")
    # Lengths that occur: at most as many as the longest value has characters.
    lengths = sorted(r[0] for r in distinct.select(F.length("value")).distinct().collect())
    placed = signature_cells(scratch_table(signatures(distinct, threshold, lengths), "signatures"))
    left = placed.withColumnsRenamed({"value": "v", "cell": "v_cell"})
    right = placed.withColumnsRenamed({"value": "w", "cell": "w_cell"})
    # In the group of two cells only values of different cells meet; a cell meets itself in a group of its own.
    across = (F.col("first") == F.col("second")) | (F.col("v_cell") != F.col("w_cell"))
    candidates = (left.join(right, ["field", "signature", "first", "second"])
                  .where(across & (F.col("v") < F.col("w")) & can_reach(F.col("v"), F.col("w"), threshold))
                  .select("field", "v", "w").distinct())
    scored = candidates.withColumn("similarity", similarity_column(F.col("v"), F.col("w")))
    return scored.where(F.col("similarity") >= threshold)


def similarity_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Jaro-Winkler similarity of every distinct pair of values in two columns of `df`."""
    pairs = df.where(F.col(left).isNotNull() & F.col(right).isNotNull()).select(left, right).distinct()
    return pairs.withColumn("similarity", similarity_column(F.col(left), F.col(right)))
