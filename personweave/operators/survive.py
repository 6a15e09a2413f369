"""Golden records: survivorship of attributes, confidence, crosswalk."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.operators.normalize import normalize_records
from personweave.operators.score import compare_pairs, score
from personweave.schemas import ATTRIBUTES
from personweave.spec import IdentitySpec

NO_RANK = 1_000_000


def source_rank(order: tuple[str, ...]) -> Column:
    """Position of the record's source in a priority list."""
    return F.coalesce(*[F.when(F.col("source_system") == s, F.lit(i)) for i, s in enumerate(order)], F.lit(NO_RANK))


def survivor(attribute: str, spec: IdentitySpec) -> Column:
    """Aggregate that picks the surviving value of one attribute among an entity's members."""
    rule = spec.survivor(attribute)
    value = F.nullif(F.trim(F.col(attribute)), F.lit(""))
    default = source_rank(spec.sources)
    if rule.strategy == "most_complete":
        order = F.struct(-F.length(value), default, F.col("source_system"), F.col("external_id"))
    else:
        # Sources outside an explicit list come after the listed ones, in default order.
        order = F.struct(source_rank(rule.priority) if rule.priority else F.lit(0), default,
                         F.col("source_system"), F.col("external_id"))
    return F.min_by(value, F.when(value.isNotNull(), order))


def survive(members: DataFrame, spec: IdentitySpec) -> DataFrame:
    """One row per entity with the five surviving attributes and the name of its leading source."""
    leading = F.struct(source_rank(spec.sources), F.col("source_system"), F.col("external_id"))
    return members.groupBy("entity_id").agg(
        *[survivor(a, spec).alias(a) for a in ATTRIBUTES],
        F.min_by("source_system", leading).alias("source_name"))


def member_confidence(members: DataFrame, golden: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Mean agreement of an entity's records with its golden record; 1.0 for an entity of one record.

    Every record is compared with one golden record, so the work grows with the records and not with their pairs.
    `members` carries the normalised columns and the copies of a record may be given once with their number `n`.
    """
    normal = normalize_records(golden, spec.fields, spec.nicknames)
    normal = normal.select("entity_id", *[F.col(f.column).alias("r_" + f.column) for f in spec.fields])
    lines = members.select("entity_id", "n", *[F.col(f.column).alias("l_" + f.column) for f in spec.fields])
    compared = score(compare_pairs(lines.join(normal, "entity_id"), spec), spec)
    return compared.groupBy("entity_id").agg(
        F.when(F.sum("n") == 1, F.lit(1.0))
        .otherwise(F.sum(F.col("confidence") * F.col("n")) / F.sum("n")).alias("confidence_score"))


def golden_records(members: DataFrame, spec: IdentitySpec, as_of: str) -> DataFrame:
    """Golden table from `members`: staged and normalised columns plus `entity_id`."""
    chosen = survive(members, spec)
    copies = members.groupBy("entity_id", *[f.column for f in spec.fields]).agg(F.count(F.lit(1)).alias("n"))
    certain = member_confidence(copies, chosen, spec)
    return chosen.join(certain, "entity_id").select(
        "entity_id", F.lit(spec.entity_type).alias("entity_type"), "first_name", "last_name", "email", "phone",
        "company_name", "confidence_score", "source_name", F.lit(as_of).cast("timestamp").alias("created_at"))


def flatten_entities(results: DataFrame) -> DataFrame:
    """Nested service-shaped results (`entity` struct with `canonical_data`) as flat golden rows."""
    data = "entity.canonical_data"
    return results.select(
        F.col("entity.id").alias("entity_id"), "entity.entity_type", f"{data}.first_name", f"{data}.last_name",
        f"{data}.email", f"{data}.phone", f"{data}.company_name", "entity.confidence_score", f"{data}.source_name",
        "entity.created_at")


def build_crosswalk(entities: DataFrame, members: DataFrame) -> DataFrame:
    """One row per member; an entity without members gives one row with empty source and id."""
    links = members.select("entity_id", "source_system", F.col("external_id").alias("source_id"))
    return entities.select("entity_id").join(links, "entity_id", "left").select(
        F.coalesce("source_system", F.lit("")).alias("source_system"),
        F.coalesce("source_id", F.lit("")).alias("source_id"), "entity_id")


