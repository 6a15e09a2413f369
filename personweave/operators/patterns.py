"""Comparison vectors of oversized blocks, counted without forming pairs.

Rows of a block are grouped by the values of a set of fields, once for every set and for every way its fields may be
required: `equal`, or `agree` (equal or similar). Group sizes multiplied give the number of pairs that fulfil the
requirement, whatever the other fields do. Subtracting the stricter from the looser counts leaves the number of pairs
per exact state of every field: disagree = any - agree, similar = agree - equal.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.operators.blocking import SEPARATOR
from personweave.operators.pairs import similar_in
from personweave.operators.score import AGREE, DISAGREE, MISSING
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec

# How a count contributes to the states of one field: (case, state, sign). The case is the requirement on the field,
# `absent` where a side has no value, `key` for a field of the block's key.
_SHARED = [("absent", "missing", 1), ("key", "equal", 1), ("any", "disagree", 1), ("agree", "disagree", -1)]
_CONTRIBUTIONS = {
    "exact": [*_SHARED, ("agree", "equal", 1)],
    "jaro_winkler": [*_SHARED, ("agree", "similar", 1), ("equal", "similar", -1), ("equal", "equal", 1)],
}


def _requirements(spec: IdentitySpec, parts: tuple[str, ...]) -> list[tuple[str, ...]]:
    """Every combination of requirements on the fields; the fields of the block's key are equal anyway."""
    choices = []
    for f in spec.fields:
        if f.name in parts:
            choices.append(("equal" if f.comparator != "exact" else "agree",))
        else:
            choices.append(("any", "agree") if f.comparator == "exact" else ("any", "agree", "equal"))
    return list(product(*choices))


def _spread(rows: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Every row once per requirement that its present fields allow, with the required values only."""
    table = [(spec.key_name(parts), ",".join(required), sum(1 << i for i, r in enumerate(required) if r != "any"))
             for parts in spec.blocking for required in _requirements(spec, parts)]
    # A fixed table: at most 3^fields requirements per key type.
    requirements = rows.sparkSession.createDataFrame(table, "key_type string, required string, needed int")
    spread = rows.join(F.broadcast(requirements), "key_type").where(F.col("mask").bitwiseAND(F.col("needed")) == F.col("needed"))
    values = {f.column: F.when(F.col("needed").bitwiseAND(1 << i) != 0, F.col(f.column)) for i, f in enumerate(spec.fields)}
    return spread.withColumns(values)


def _grouped(rows: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Sizes per block, requirement, required values and presence mask."""
    return _spread(rows, spec).groupBy("key_type", "key_value", "mask", "required", *[f.column for f in spec.fields]).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("self"))


def _with_similar(groups: DataFrame, similar: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Add every group again under the values similar to its own, for fields that need only agree."""
    both_ways = (similar.select("field", "v", "w")
                 .unionByName(similar.select("field", F.col("w").alias("v"), F.col("v").alias("w"))))
    for i, f in enumerate(spec.fields):
        if f.comparator == "exact":
            continue
        agreeing = groups.where(F.split_part("required", F.lit(","), F.lit(i + 1)) == "agree")
        others = both_ways.where(F.col("field") == f.name).select(F.col("v").alias(f.column), F.col("w").alias("_w"))
        moved = agreeing.join(others, f.column).withColumn(f.column, F.col("_w")).drop("_w")
        groups = groups.unionByName(moved.select(*groups.columns))
    return groups


def _key(spec: IdentitySpec) -> Column:
    """The required values as one text; which of them are present is part of the requirement."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(f.column, F.lit("")) for f in spec.fields])


def block_patterns(large: DataFrame, spec: IdentitySpec) -> DataFrame:
    """`gamma_<field>`, `pairs`: record pairs of different profiles in the given blocks.

    As with listed pairs, a pair counts in the block of the first key type it shares only.
    """
    rows = scratch_table(large, "large-rows")
    groups = scratch_table(_grouped(rows, spec), "value-groups")
    same = ("key_type", "key_value", "required", "_key")
    left = groups.withColumn("_key", _key(spec)).select(*same, F.col("mask").alias("l_mask"), F.col("n").alias("l_n"))
    right = (_with_similar(groups, similar_in(rows, spec), spec).withColumn("_key", _key(spec))
             .select(*same, F.col("mask").alias("r_mask"), F.col("n").alias("r_n")))
    crossed = left.join(right, list(same)).groupBy(
        "key_type", "required", F.col("l_mask").bitwiseAND(F.col("r_mask")).alias("present")).agg(
        F.sum(F.col("l_n").cast("decimal(38,0)") * F.col("r_n")).alias("pairs"))
    own = groups.groupBy("key_type", "required", F.col("mask").alias("present")).agg(
        (-F.sum(F.col("self").cast("decimal(38,0)"))).alias("pairs"))
    counts = crossed.select("key_type", "required", "present", F.col("pairs").cast("decimal(38,0)")).unionByName(
        own.select("key_type", "required", "present", F.col("pairs").cast("decimal(38,0)")))
    # Each unordered pair was counted from both sides.
    counts = counts.groupBy("key_type", "required", "present").agg((F.sum("pairs") / 2).alias("pairs"))
    return _states(counts, spec)


def partner_patterns(large: DataFrame, spec: IdentitySpec) -> DataFrame:
    """`vid`, `gamma_<field>`, `partners`: how many other profiles of the given blocks a profile has per comparison vector.

    A profile meets the sizes of the groups that fulfil a requirement with it, at most one per presence mask.
    """
    rows = scratch_table(large.withColumn("n", F.lit(1).cast("long")), "large-rows")
    same = ["key_type", "key_value", "required", "_key"]
    sizes = (_with_similar(_grouped(rows, spec), similar_in(rows, spec), spec).withColumn("_key", _key(spec))
             .groupBy(*same, F.col("mask").alias("other")).agg(F.sum("n").alias("n")))
    asking = _spread(rows, spec).select("vid", "mask", "key_type", "key_value", "required", _key(spec).alias("_key"))
    met = asking.join(sizes, same).select("vid", "key_type", "required", F.col("mask").bitwiseAND(F.col("other")).alias("present"), "n")
    # A profile is in each of its own groups once.
    own = asking.select("vid", "key_type", "required", F.col("mask").alias("present"), F.lit(-1).cast("long").alias("n"))
    counts = met.unionByName(own).groupBy("vid", "key_type", "required", "present").agg(F.sum("n").alias("pairs"))
    return _states(counts, spec, ("vid",)).withColumnRenamed("pairs", "partners")


def _states(counts: DataFrame, spec: IdentitySpec, by: tuple[str, ...] = ()) -> DataFrame:
    """From counts per requirement to counts per comparison vector, and per `by` if given."""
    out = counts.withColumn("pairs", F.col("pairs").cast("decimal(38,0)"))
    for i, f in enumerate(spec.fields):
        rules = out.sparkSession.createDataFrame(_CONTRIBUTIONS[f.comparator], "_case string, state string, sign int")
        keys = [spec.key_name(parts) for parts in spec.blocking if f.name in parts]
        case = F.when(F.col("present").bitwiseAND(1 << i) == 0, "absent").otherwise(
            F.split_part("required", F.lit(","), F.lit(i + 1)))
        out = (out.withColumn("_case", F.when(F.col("key_type").isin(keys), "key").otherwise(case) if keys else case)
               .join(F.broadcast(rules), "_case")
               .withColumn("pairs", (F.col("pairs") * F.col("sign")).cast("decimal(38,0)"))
               .withColumnRenamed("state", f"s_{f.name}").drop("_case", "sign"))
    # Pairs that share an earlier key belong to its block.
    earlier = F.lit(False)
    for j, parts in enumerate(spec.blocking):
        for before in spec.blocking[:j]:
            shared = reduce(lambda a, b: a & b, [F.col(f"s_{p}") == "equal" for p in before])
            earlier = earlier | ((F.col("key_type") == spec.key_name(parts)) & shared)
    gammas = [F.when(F.col(f"s_{f.name}") == "missing", F.lit(MISSING))
              .when(F.col(f"s_{f.name}") == "disagree", F.lit(DISAGREE)).otherwise(F.lit(AGREE)).alias(f"gamma_{f.name}")
              for f in spec.fields]
    return (out.where(~earlier).groupBy(*by, *gammas).agg(F.sum("pairs").cast("double").alias("pairs"))
            .where(F.col("pairs") > 0))
