"""Training of m and u: random pairs for u, expectation maximisation on pattern counts for m."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personweave.operators.blocking import block_keys
from personweave.operators.pairs import block_pairs, split_by_size
from personweave.operators.patterns import block_patterns
from personweave.operators.score import AGREE, DISAGREE, MISSING, compare_pairs
from personweave.spec import IdentitySpec

LOWEST = 1e-6
ROUNDS = 8
# Records that meet in one random bucket: few enough to sort, many enough to pair nearly all of them.
BUCKET_ROWS = 64
HASH_RANGE = 1 << 48


def _number(digest: Column) -> Column:
    """The first 48 bits of a hexadecimal digest."""
    return F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long")


def random_pairs(profiles: DataFrame, spec: IdentitySpec, max_pairs: int, rounds: int = ROUNDS) -> DataFrame:
    """Random pairs of neighbours in hash order, at most about `max_pairs`, the same for every run.

    Each round sorts the rows of small random buckets by another hash and pairs neighbours. The hash of a unique id
    decides the bucket, so buckets are even whatever the data look like. One hash per profile, moved on by an even step
    per round, decides which rounds draw it; only drawn profiles are hashed again.
    """
    total = max(profiles.count(), 1)
    share = min(1.0, max_pairs / (rounds * total))
    buckets = max(int(total * share) // BUCKET_ROWS, 1)
    columns = ["vid", *[f.column for f in spec.fields]]
    step, limit = HASH_RANGE // rounds, int(share * HASH_RANGE)
    place = _number(F.md5("vid"))
    in_rounds = F.filter(F.sequence(F.lit(0), F.lit(rounds - 1)),
                         lambda r: F.pmod(place + r * F.lit(step).cast("long"), F.lit(HASH_RANGE)) < F.lit(limit).cast("long"))
    drawn = (profiles.select(*columns, F.explode(in_rounds).alias("_round"))
             .withColumn("_hash", F.md5(F.concat(F.col("_round").cast("string"), F.lit(":"), "vid")))
             .withColumn("_bucket", F.pmod(_number(F.col("_hash")), F.lit(buckets))))
    following = F.lead(F.struct(*columns)).over(Window.partitionBy("_round", "_bucket").orderBy("_hash"))
    return (drawn.select(*[F.col(c).alias("l_" + c) for c in columns], following.alias("_r"))
            .where(F.col("_r").isNotNull())
            .select(*["l_" + c for c in columns], *[F.col(f"_r.{c}").alias("r_" + c) for c in columns]))


def estimate_u(profiles: DataFrame, spec: IdentitySpec, rounds: int = ROUNDS) -> DataFrame:
    """`field`, `u`, `compared`: share of agreeing random pairs among those with both values present."""
    compared = compare_pairs(random_pairs(profiles, spec, spec.max_random_pairs, rounds), spec)
    gammas = [F.struct(F.lit(f.name).alias("field"), F.col(f"gamma_{f.name}").alias("gamma")) for f in spec.fields]
    return (compared.select(F.explode(F.array(*gammas)).alias("g")).where(F.col("g.gamma") != MISSING)
            .groupBy(F.col("g.field").alias("field"))
            .agg(((F.sum("g.gamma") + 1) / (F.count(F.lit(1)) + 2)).alias("u"), F.count(F.lit(1)).alias("compared")))


def gamma_patterns(profiles: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Record pairs per comparison vector, over all pairs that share a blocking key; at most 3^fields rows.

    Copies count without being paired up: n_left * n_right per pair of profiles, n * (n - 1) / 2 within a profile. The
    pairs of an oversized block are counted from the sizes of its groups of equal and similar values.
    """
    names = [f"gamma_{f.name}" for f in spec.fields]
    wide = ["vid", "n", "mask", *[f.column for f in spec.fields]]
    ordinary, large = split_by_size(block_keys(profiles.select(*wide).withColumn("side", F.lit("B")), spec), spec)
    pairs = compare_pairs(block_pairs(ordinary, spec), spec).select(
        *names, (F.col("l_n") * F.col("r_n")).cast("double").alias("pairs"))
    within = [F.when(F.col(f.column).isNull(), F.lit(MISSING)).otherwise(F.lit(AGREE)).alias(f"gamma_{f.name}")
              for f in spec.fields]
    copies = profiles.where(F.col("n") > 1).select(*within, (F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    parts = [pairs, copies]
    if large is not None:
        parts.append(block_patterns(large, spec))
    return reduce(DataFrame.unionByName, parts).groupBy(*names).agg(F.sum("pairs").alias("pairs"))


@dataclass(frozen=True)
class Trained:
    parameters: dict[str, tuple[float, float]]  # field -> (m, u)
    match_rate: float
    iterations: int


def _bounded(x: float) -> float:
    return min(max(x, LOWEST), 1 - LOWEST)


def em_iterate(rows: list[tuple[tuple[int, ...], float]], m: list[float], u: list[float], rate: float
               ) -> tuple[list[float], float]:
    """One expectation and maximisation step over (comparison vector, count) rows; u stays fixed and bounds m."""
    hits, seen = [0.0] * len(m), [0.0] * len(m)
    matched = total = 0.0
    for gammas, pairs in rows:
        like_m, like_u = rate, 1 - rate
        for i, g in enumerate(gammas):
            if g == AGREE:
                like_m, like_u = like_m * m[i], like_u * u[i]
            elif g == DISAGREE:
                like_m, like_u = like_m * (1 - m[i]), like_u * (1 - u[i])
        expected = pairs * like_m / (like_m + like_u)
        matched, total = matched + expected, total + pairs
        for i, g in enumerate(gammas):
            if g != MISSING:
                seen[i] += expected
                hits[i] += expected * (g == AGREE)
    new_m = [max(_bounded(h / s), low) if s > 0 else old for h, s, old, low in zip(hits, seen, m, u)]
    return new_m, _bounded(matched / total) if total else rate


def em_train(patterns: DataFrame, u: dict[str, float], spec: IdentitySpec, start_rate: float = 0.1) -> Trained:
    """Estimate m until no value moves by the convergence bound.

    Only the pattern table reaches the driver: at most 3^fields rows whatever the data size.
    """
    names = [f"gamma_{f.name}" for f in spec.fields]
    rows = [(tuple(row[n] for n in names), float(row["pairs"])) for row in patterns.select(*names, "pairs").collect()]
    fixed = [_bounded(u.get(f.name, f.u)) for f in spec.fields]
    m = [max(f.m, low) for f, low in zip(spec.fields, fixed)]
    rate, done = start_rate, 0
    for done in range(1, spec.max_iterations + 1):
        new_m, new_rate = em_iterate(rows, m, fixed, rate)
        moved = max([abs(a - b) for a, b in zip(new_m, m)] + [abs(new_rate - rate)])
        m, rate = new_m, new_rate
        if moved < spec.convergence:
            break
    return Trained({f.name: (m[i], fixed[i]) for i, f in enumerate(spec.fields)}, rate, done)


def train(profiles: DataFrame, spec: IdentitySpec) -> dict[str, tuple[float, float]]:
    """Trained (m, u) per field."""
    u = {row["field"]: row["u"] for row in estimate_u(profiles, spec).select("field", "u").collect()}
    return em_train(gamma_patterns(profiles, spec), u, spec).parameters


def parameter_table(patterns: DataFrame, trained: Trained) -> DataFrame:
    """Trained parameters as a table, to be stored and reused by the incremental job."""
    rows = [(name, m, u, trained.match_rate, trained.iterations) for name, (m, u) in trained.parameters.items()]
    return patterns.sparkSession.createDataFrame(
        rows, "field string, m double, u double, match_rate double, iteration int")
