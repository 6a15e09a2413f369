"""Comparison-time normalisation and the collapse of records that compare alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.functions.text import normal_email, normal_generic, normal_name, normal_phone
from personweave.operators.blocking import key_columns
from personweave.spec import IdentitySpec, ScoreField

# Up to so many entries the nickname dictionary is sent to all tasks; a larger one is an ordinary join.
BROADCAST_NICKNAMES = 100_000

NORMALIZERS: dict[str, Callable[[Column], Column]] = {
    "email": normal_email, "phone": normal_phone, "nickname": normal_name, "name": normal_name,
    "generic": normal_generic,
}


def record_id(source: str = "source_system", key: str = "external_id") -> Column:
    return F.concat(F.col(source), F.lit(":"), F.col(key))


def apply_nicknames(df: DataFrame, column: str, nicknames: dict[str, str] | DataFrame) -> DataFrame:
    """Replace short given names by their full form. A table of nicknames has one row per `alias`."""
    if isinstance(nicknames, DataFrame):
        table = nicknames.select("alias", "formal")
    elif not nicknames:
        return df
    else:
        table = df.sparkSession.createDataFrame(list(nicknames.items()), "alias string, formal string")
        if len(nicknames) <= BROADCAST_NICKNAMES:
            table = F.broadcast(table)
    joined = df.join(table, F.col(column) == F.col("alias"), "left")
    return joined.withColumn(column, F.coalesce("formal", column)).drop("alias", "formal")


def normalize_records(df: DataFrame, fields: tuple[ScoreField, ...], nicknames: dict[str, str] | DataFrame) -> DataFrame:
    """Add `n_<field>` columns; null stays null and an empty text becomes null."""
    out = df.withColumns({f.column: NORMALIZERS[f.normalizer](F.col(f.name)) for f in fields})
    for f in fields:
        if f.normalizer == "nickname":
            out = apply_nicknames(out, f.column, nicknames)
    return out


def presence_mask(spec: IdentitySpec) -> Column:
    """Bit i is set where score field i has a value."""
    bits = [F.when(F.col(f.column).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(spec.fields)]
    return reduce(lambda a, b: a + b, bits)


def best_possible_weight(spec: IdentitySpec) -> Column:
    """Upper bound of the weight a record can get in any pair: all of its present fields agree."""
    parts = [F.when(F.col(f.column).isNotNull(), F.lit(max(f.agree, 0.0))).otherwise(F.lit(0.0)) for f in spec.fields]
    return reduce(lambda a, b: a + b, parts)


def prepare_records(staged: DataFrame, spec: IdentitySpec, profile: str = "batch") -> DataFrame:
    """Normalised records with `rec_id` and `profile_key`."""
    normal = normalize_records(staged, spec.fields, spec.nicknames).withColumn("rec_id", record_id())
    return with_profile_key(normal, spec, profile)


def with_profile_key(normal: DataFrame, spec: IdentitySpec, profile: str = "batch") -> DataFrame:
    """Add the profile key to normalised records.

    Records with equal normalised values compare alike, so they share a profile key and are compared once. That needs
    a copy to be linked to its own copies: they have a blocking key, and what they agree on makes a match. Where that
    does not hold, the record keeps a profile of its own.
    """
    values = F.to_json(F.array(*[F.coalesce(f.column, F.lit("")) for f in spec.fields]))
    own = [F.when(F.col(f.column).isNotNull(), F.lit(f.agree)).otherwise(F.lit(0.0)) for f in spec.fields]
    copies_match = (reduce(lambda a, b: a + b, own) >= spec.match) & has_key(spec, profile)
    key = F.when(copies_match, values).otherwise(F.concat(values, F.col("rec_id")))
    return normal.withColumn("profile_key", F.sha2(key, 256))


def apart(records: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Give every record that a split names a profile of its own, so that it can leave its copies."""
    if overrides is None:
        return records
    splits = overrides.where(F.col("kind") == "split")
    named = splits.select(F.explode(F.array("left_id", "right_id")).alias("rec_id")).distinct().withColumn("_own", F.lit(True))
    key = F.when(F.col("_own"), F.sha2(F.concat("profile_key", "rec_id"), 256)).otherwise(F.col("profile_key"))
    return records.join(named, "rec_id", "left").withColumn("profile_key", key).drop("_own")


def has_key(spec: IdentitySpec, profile: str = "batch") -> Column:
    """True for records with at least one blocking key."""
    return reduce(lambda a, b: a | b, [key.isNotNull() for _, key in key_columns(spec, profile)])


def collapse_profiles(records: DataFrame, spec: IdentitySpec) -> DataFrame:
    """One row per profile: `vid` is the smallest record id, `n` the number of copies."""
    return records.groupBy("profile_key").agg(
        F.min("rec_id").alias("vid"), F.count(F.lit(1)).alias("n"),
        *[F.first(f.column).alias(f.column) for f in spec.fields],
    ).withColumn("mask", presence_mask(spec))
