"""The review band without its pairs: how many partners each profile has per comparison vector, and the pairs of asked ones.

A hot block may hold as many pairs to review as the square of its rows. A person works on one record at a time, so what is
kept is one row per profile and comparison vector; its pairs are listed when someone asks for that profile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personweave.operators.blocking import block_keys
from personweave.operators.pairs import block_pairs, scored_pairs, split_by_size
from personweave.operators.patterns import partner_patterns
from personweave.operators.score import compare_pairs, decide, score
from personweave.spec import IdentitySpec


def _in_review(compared: DataFrame, spec: IdentitySpec) -> DataFrame:
    return decide(score(compared, spec), spec).where(F.col("decision") == "review").drop("class", "decision")


def review_groups(profiles: DataFrame, spec: IdentitySpec) -> DataFrame:
    """`vid`, `gamma_<field>`, `partners`, `weight`, `confidence`: the profiles that a profile is to be reviewed with, counted
    per comparison vector. At most 3^fields rows per profile, however many pairs they stand for.

    Pairs of ordinary blocks are listed and counted; those of oversized ones are counted from the sizes of groups of values.
    """
    names = [f"gamma_{f.name}" for f in spec.fields]
    wide = ["vid", "mask", *[f.column for f in spec.fields]]
    ordinary, large = split_by_size(block_keys(profiles.select(*wide).withColumn("side", F.lit("B")), spec), spec)
    pairs = _in_review(compare_pairs(block_pairs(ordinary, spec), spec, spec.possible), spec)
    ends = F.explode(F.array("l_vid", "r_vid")).alias("vid")
    parts = [pairs.select(ends, *names).groupBy("vid", *names).agg(F.count(F.lit(1)).alias("partners"))]
    if large is not None:
        counted = partner_patterns(large, spec)
        parts.append(_in_review(counted, spec).select("vid", *names, "partners"))
    both = reduce(DataFrame.unionByName, parts).groupBy("vid", *names).agg(F.sum("partners").cast("long").alias("partners"))
    return score(both, spec)


def review_pairs_of(asked: DataFrame, profiles: DataFrame, spec: IdentitySpec) -> DataFrame:
    """All pairs to review of the profiles `asked` (`vid`): `left_id` is the asked one, `right_id` its partner.

    Only the blocks of the asked profiles are read further. In oversized ones an asked profile meets the rows that agree with it
    on enough to reach the band, not all rows of its blocks.
    """
    wide = ["vid", "mask", *[f.column for f in spec.fields]]
    own = profiles.join(asked.select("vid").distinct(), "vid", "left_semi").select(*wide)
    pairs = scored_pairs(own, spec, spec.possible, right=profiles.select(*wide)).where(F.col("left_id") != F.col("right_id"))
    return decide(pairs, spec).where(F.col("decision") == "review").select(
        "left_id", "right_id", *[f"gamma_{f.name}" for f in spec.fields], "weight", "confidence")
