"""Strongest candidates of profiles among the rows of oversized blocks, without listing pairs.

The weight of a pair follows from the set of fields that agree. For a given set, stored rows are grouped by their values
on it; a new row meets one row per group instead of all of its rows. A row of a group agrees on the set at least, so the
weight computed for the set is never too high, and it is right for the set of fields that do agree: the highest weight
over all sets is the true one.

Sets that cannot decide anything are left out, as rows times sets are what the shuffles hold: those whose agreement does
not reach the floor, and those that make a pair share the key of an earlier type, in whose block it is met.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personweave.operators.blocking import SEPARATOR, agreed_fields, block_keys
from personweave.operators.pairs import listed_pairs, similar_in, split_by_size
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec


def deciding_sets(spec: IdentitySpec, profile: str, floor: float) -> dict[str, list[int]]:
    """Per key type the sets of further fields on which a pair may agree that reaches the floor and is met in such a block.

    A pair that agrees on all fields of an earlier key type by equality shares that key. Similar values do not.
    """
    exact = sum(1 << i for i, f in enumerate(spec.fields) if f.comparator == "exact")
    codes = list(agreed_fields(spec, profile).items())

    def wanted(agreed: int, both: int, earlier: list[int]) -> bool:
        if any(c and c & both == c and c & ~agreed & ~exact == 0 for c in earlier):
            return False
        return sum(f.agree for i, f in enumerate(spec.fields) if both >> i & 1) >= floor - 1e-9

    return {name: [s for s in range(1 << len(spec.fields))
                   if s & agreed == 0 and wanted(agreed, agreed | s, [c for _, c in codes[:k]])]
            for k, (name, agreed) in enumerate(codes)}


def _by_set(rows: DataFrame, spec: IdentitySpec, profile: str, floor: float) -> DataFrame:
    """Each row once per deciding set of further fields that it has values for; `v<i>` holds the value where the set needs it."""
    every = F.create_map(*[x for name, sets in deciding_sets(spec, profile, floor).items()
                           for x in (F.lit(name), F.array(*[F.lit(s) for s in sets]).cast("array<int>"))])[F.col("key_type")]
    spread = rows.withColumn("set", F.explode(F.filter(every, lambda s: s.bitwiseAND(F.col("mask")) == s))).drop("key_type")
    return spread.withColumns({f"v{i}": F.when(F.col("set").bitwiseAND(1 << i) != 0, F.col(f.column))
                               for i, f in enumerate(spec.fields)})


def _with_similar(rows: DataFrame, similar: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Add every row under the values that are similar to its own."""
    both_ways = similar.select("field", "v", "w").unionByName(similar.select("field", F.col("w").alias("v"), F.col("v").alias("w")))
    for i, f in enumerate(spec.fields):
        if f.comparator != "exact":
            others = both_ways.where(F.col("field") == f.name).select(F.col("v").alias(f"v{i}"), F.col("w").alias("_w"))
            moved = rows.join(others, f"v{i}").withColumn(f"v{i}", F.col("_w")).drop("_w")
            rows = rows.unionByName(moved.select(*rows.columns))
    return rows


def _weight(spec: IdentitySpec) -> Column:
    agreed, both = F.col("agreed").bitwiseOR(F.col("set")), F.col("mask").bitwiseAND(F.col("r_mask"))
    parts = [F.when(agreed.bitwiseAND(1 << i) != 0, F.lit(f.agree)).when(both.bitwiseAND(1 << i) != 0, F.lit(f.disagree)).otherwise(F.lit(0.0))
             for i, f in enumerate(spec.fields)]
    return reduce(lambda a, b: a + b, parts)


def strongest_in(large: DataFrame, spec: IdentitySpec, profile: str, floor: float, second: bool = False) -> DataFrame:
    """`left_id, entity_id, weight, matched_id, matched_values` of candidates in the given blocks.

    `large` holds new rows (side L) and stored rows (side R) with their entity, from the keys of the whole batch: pairs that
    share an ordinary block of an earlier key type are left to its listing. The result has, for every new row, its
    strongest entity (the smallest of equally strong ones) if it reaches the floor, and enough rows at or above the merge
    weight to connect all entities that some new row ties together: new rows of one group are alike, so one of them
    names all entities, the others one each. With `second` it instead has, for every new row, a second entity at or above the
    merge weight where there is one, so that each row shows by itself whether it ties entities together.
    """
    codes = F.create_map(*[F.lit(x) for kv in agreed_fields(spec, profile).items() for x in kv])
    fields = [f.column for f in spec.fields]
    rows = scratch_table(large.select(
        "key_type", F.concat_ws(SEPARATOR, "key_type", "key_value").alias("block"), codes[F.col("key_type")].alias("agreed"),
        "side", "vid", "mask", "entity_id", *fields), "large-rows")
    similar = similar_in(rows, spec)
    group = ["block", "set", *[f"v{i}" for i in range(len(fields))]]
    values = F.struct(*[F.col(c).alias(f"r_{c}") for c in fields]).alias("values")
    stored = _by_set(rows.where("side = 'R'"), spec, profile, floor).withColumnRenamed("mask", "r_mask")
    by_entity = scratch_table(stored.groupBy(*group, "r_mask", "entity_id").agg(F.min(F.struct("vid", values)).alias("best")), "stored-groups")
    new = _with_similar(_by_set(rows.where("side = 'L'"), spec, profile, floor).select(*group, "agreed", "mask", "vid"), similar, spec)
    new = scratch_table(new, "new-groups")
    first = by_entity.groupBy(*group, "r_mask").agg(F.min(F.struct("entity_id", "best")).alias("first")).select(
        *group, "r_mask", "first.entity_id", "first.best")
    alike = new.groupBy(*group, "agreed", "mask").agg(F.min("vid").alias("vid"))

    def met(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
        same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in group])
        return (left.join(right, same).select(left["vid"].alias("left_id"), "agreed", left["set"].alias("set"), "mask", "r_mask", "entity_id", "best")
                .withColumn("weight", _weight(spec)).where(F.col("weight") >= least)
                .select("left_id", "entity_id", "weight", F.col("best.vid").alias("matched_id"), F.col("best.values").alias("matched_values")))

    if second:
        # Of two entities that a row meets in one group the two smallest show that they are two; of others the first ones do.
        rank = F.row_number().over(Window.partitionBy(*group, "r_mask").orderBy("entity_id"))
        return met(new, by_entity.withColumn("rank", rank).where(F.col("rank") <= 2).drop("rank"), floor)
    return met(new, first, floor).unionByName(met(alike, by_entity, max(floor, spec.merge)))


def _next_in(large: DataFrame, spec: IdentitySpec, profile: str, floor: float) -> DataFrame:
    """`left_id`, `right_id`, `weight`: per row, group of values and presence mask the partner with the next larger id.

    Partners of one group and mask weigh the same, so of those that decide no other one has a smaller id.
    """
    codes = F.create_map(*[F.lit(x) for kv in agreed_fields(spec, profile).items() for x in kv])
    rows = scratch_table(large.where(F.col("vid").isNotNull()).select(
        "key_type", F.concat_ws(SEPARATOR, "key_type", "key_value").alias("block"), codes[F.col("key_type")].alias("agreed"),
        "vid", "mask", *[f.column for f in spec.fields]), "large-rows")
    group = ["block", "set", *[f"v{i}" for i in range(len(spec.fields))]]
    partners = _by_set(rows, spec, profile, floor).select(*group, "agreed", "mask", "vid")
    asking = _with_similar(partners, similar_in(rows, spec), spec)
    both = asking.withColumn("partner", F.lit(0)).unionByName(partners.withColumn("partner", F.lit(1)))
    # A row stands before the partner that it is itself.
    larger = Window.partitionBy(*group).orderBy(F.desc("vid"), "partner").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2^fields numbers.
    masks = sorted(r["mask"] for r in rows.select("mask").distinct().collect())
    seen = {f"_{m}": F.last(F.when((F.col("partner") == 1) & (F.col("mask") == m), F.col("vid")), ignorenulls=True).over(larger) for m in masks}
    each = F.array(*[F.struct(F.lit(m).alias("r_mask"), F.col(f"_{m}").alias("right_id")) for m in masks])
    met = both.withColumns(seen).where(F.col("partner") == 0).select(
        F.col("vid").alias("left_id"), "agreed", "set", "mask", F.explode(each).alias("_met")).select("*", "_met.*")
    return (met.where(F.col("right_id").isNotNull()).withColumn("weight", _weight(spec)).where(F.col("weight") >= floor)
            .select("left_id", "right_id", "weight"))


def strongest_pairs(profiles: DataFrame, spec: IdentitySpec, floor: float, profile: str = "batch") -> DataFrame:
    """`left_id`, `right_id`, `weight` of pairs of profiles, with the smaller id on the left: all that reach the floor in ordinary
    blocks, and of oversized ones those that `best_candidate` decides by, which grow with the rows.

    A pair may come several times, and with less than its weight where its full weight comes as well.
    """
    rows = profiles.select("vid", "mask", *[f.column for f in spec.fields]).withColumn("side", F.lit("B"))
    ordinary, large = split_by_size(block_keys(rows, spec, profile), spec)
    pairs = listed_pairs(ordinary, None, spec, profile, floor, True).select(
        F.col("l_vid").alias("left_id"), F.col("r_vid").alias("right_id"), "weight")
    return pairs if large is None else pairs.unionByName(_next_in(large, spec, profile, floor))
