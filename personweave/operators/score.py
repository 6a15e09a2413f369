"""Comparison vectors, Fellegi-Sunter weights, classes and decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.functions.similarity import can_reach, similarity_column
from personweave.spec import IdentitySpec, ScoreField

MISSING, DISAGREE, AGREE = -1, 0, 1


def known_gamma(f: ScoreField, left: str = "l_", right: str = "r_") -> Column:
    """Comparison result as far as equality decides it; null for different texts compared by similarity."""
    l, r = F.col(left + f.column), F.col(right + f.column)
    known = F.when(l.isNull() | r.isNull(), F.lit(MISSING)).when(l == r, F.lit(AGREE))
    return known.otherwise(F.lit(DISAGREE)) if f.comparator == "exact" else known


def field_weight(f: ScoreField, gamma: Column) -> Column:
    return (F.when(gamma == AGREE, F.lit(f.agree)).when(gamma == DISAGREE, F.lit(f.disagree))
            .otherwise(F.lit(0.0)))


def _upper_bound(spec: IdentitySpec, lengths: bool, known: dict[str, Column]) -> Column:
    """Highest weight a pair can reach, from equality alone or from lengths and prefixes as well; of the fields in `known`
    what is given there.

    Every comparison appears once, so the join evaluates it once per pair.
    """
    parts = []
    for f in spec.fields:
        if f.name in known:
            parts.append(known[f.name])
            continue
        l, r = F.col("l_" + f.column), F.col("r_" + f.column)
        differing = F.lit(f.disagree)
        if f.comparator != "exact":
            differing = F.lit(max(f.agree, f.disagree))
            if lengths:
                differing = F.when(can_reach(l, r, f.threshold), differing).otherwise(F.lit(f.disagree))
        parts.append(F.when(l.isNull() | r.isNull(), F.lit(0.0)).when(l == r, F.lit(f.agree)).otherwise(differing))
    return reduce(lambda a, b: a + b, parts)


def plausible_pairs(pairs: DataFrame, spec: IdentitySpec, floor: float | None = None,
                    known: dict[str, Column] | None = None) -> DataFrame:
    """Add `gamma_<field>` as far as it is known without computing a similarity, null where one is needed.

    With a floor, pairs whose weight cannot reach it are dropped: first by equality alone, then by lengths and prefixes.
    `known` has the highest weights of fields that are not compared here.
    """
    known = known or {}
    if floor is not None:
        pairs = (pairs.where(_upper_bound(spec, False, known) >= floor - 1e-9)
                 .where(_upper_bound(spec, True, known) >= floor - 1e-9))
    return pairs.withColumns({f"gamma_{f.name}": known_gamma(f) for f in spec.fields if f.name not in known})


def compare_similar(pairs: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Compute the similarities that `plausible_pairs` left open."""
    fuzzy = [(f, F.col(f"gamma_{f.name}")) for f in spec.fields if f.comparator != "exact"]
    similar = {f.name: similarity_column(*[F.when(gamma.isNull(), F.col(side + f.column)) for side in ("l_", "r_")])
               for f, gamma in fuzzy}
    return pairs.withColumns({
        f"gamma_{f.name}": F.coalesce(gamma, (similar[f.name] >= f.threshold).cast("int")) for f, gamma in fuzzy})


def compare_pairs(pairs: DataFrame, spec: IdentitySpec, floor: float | None = None) -> DataFrame:
    """Add `gamma_<field>` in (-1 missing, 0 disagree, 1 agree) to pairs that carry `l_n_*` and `r_n_*` columns.

    With a floor, pairs that cannot reach it are dropped before any similarity is computed.
    """
    return compare_similar(plausible_pairs(pairs, spec, floor), spec)


def score(compared: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Add the summed log2 `weight` of the comparison vector and its `confidence`."""
    weight = reduce(lambda a, b: a + b, [field_weight(f, F.col(f"gamma_{f.name}")) for f in spec.fields])
    return compared.withColumn("weight", weight).withColumn("confidence", confidence(F.col("weight"), spec))


def confidence(w: Column, spec: IdentitySpec) -> Column:
    """Piecewise linear in the weight, so that weight and confidence thresholds give one decision."""
    lo, mid, hi = spec.non_match, spec.possible, spec.match
    review, match = spec.review_confidence, spec.match_confidence
    return (F.when(w >= hi, 1 - (1 - match) * F.pow(F.lit(2.0), hi - w))
            .when(w >= mid, review + (match - review) * (w - mid) / (hi - mid))
            .when(w > lo, review * (w - lo) / (mid - lo))
            .otherwise(F.lit(0.0)))


def posterior(w: Column, prior: float) -> Column:
    """Match probability from an unweighted log2 likelihood ratio and the prior match rate."""
    odds = F.pow(F.lit(2.0), w) * (prior / (1 - prior))
    return odds / (1 + odds)


def classify(scored: DataFrame, spec: IdentitySpec) -> DataFrame:
    w = F.col("weight")
    return scored.withColumn("class", F.when(w >= spec.match, "match").when(w >= spec.possible, "possible")
                             .when(w >= spec.non_match, "unlikely").otherwise("non_match"))


def decide(scored: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Add `class` from the weight thresholds and `decision` from the confidence thresholds."""
    c = F.col("confidence")
    return classify(scored, spec).withColumn(
        "decision", F.when(c >= spec.match_confidence, "match").when(c >= spec.review_confidence, "review")
        .otherwise("reject"))


def review_queue(decided: DataFrame) -> DataFrame:
    """Pairs that need a person to decide, most likely ones first."""
    return decided.where(F.col("decision") == "review").orderBy(F.desc("confidence"), "left_id", "right_id")


def best_candidate(decided: DataFrame, record: str = "left_id", candidate: str = "right_id") -> DataFrame:
    """The strongest candidate of every record; ties go to the smaller candidate id."""
    best = F.struct((-F.col("weight")).alias("order"), F.col(candidate).alias("candidate"), F.col("weight"))
    return decided.groupBy(record).agg(F.min(best).alias("best")).select(
        record, F.col("best.candidate").alias(candidate), F.col("best.weight").alias("weight"))
