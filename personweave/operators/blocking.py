"""Blocking keys and block statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.spec import IdentitySpec

SEPARATOR = "\u001f"


def _joined(parts: list[Column]) -> Column:
    """Parts joined to one key; null if any part is null."""
    return reduce(lambda a, b: F.concat(a, F.lit(SEPARATOR), b), parts)


def key_columns(spec: IdentitySpec, profile: str = "batch", prefix: str = "") -> list[tuple[str, Column]]:
    """(key type, key expression) in order. Profile `incremental`: email, phone, first three letters + last name."""
    def col(name: str) -> Column:
        return F.col(f"{prefix}n_{name}")

    if profile == "incremental":
        composite = F.concat(F.substr(col("first_name"), F.lit(1), F.lit(3)), col("last_name"))
        return [("email", col("email")), ("phone", col("phone")), ("name3", composite)]
    return [(spec.key_name(parts), _joined([col(p) for p in parts])) for parts in spec.blocking]


def agreed_fields(spec: IdentitySpec, profile: str = "batch") -> dict[str, int]:
    """Per key type the bit set of score fields that are equal for any two rows of one block."""
    index = {f.name: i for i, f in enumerate(spec.fields)}
    if profile == "incremental":
        return {"email": 1 << index["email"], "phone": 1 << index["phone"], "name3": 0}
    return {spec.key_name(parts): sum(1 << index[p] for p in parts) for parts in spec.blocking}


def block_keys(df: DataFrame, spec: IdentitySpec, profile: str = "batch") -> DataFrame:
    """One row per record and present key: all columns of `df` plus `key_type`, `key_value`."""
    keys = [F.struct(F.lit(name).alias("key_type"), key.alias("key_value"))
            for name, key in key_columns(spec, profile)]
    present = F.filter(F.array(*keys), lambda k: k.key_value.isNotNull())
    return df.withColumn("_key", F.explode(present)).select("*", "_key.key_type", "_key.key_value").drop("_key")


def block_stats(keys: DataFrame) -> DataFrame:
    """Size of every block and the number of pairs it stands for."""
    n = F.count(F.lit(1))
    return keys.groupBy("key_type", "key_value").agg(
        n.alias("n"), F.expr("count(1) * (count(1) - 1) div 2").alias("n_pairs"))


def rule_exact_match(records: DataFrame, field: str, key: str = "rec_id") -> DataFrame:
    """Deterministic rule: records with one value of the field belong together.

    Every record is linked to the smallest record id that has the value, which connects the whole group with one
    link per record instead of all pairs.
    """
    first = records.where(F.col(field).isNotNull()).groupBy(field).agg(F.min(key).alias("left_id"))
    return (records.join(first, field).where(F.col(key) > F.col("left_id"))
            .select("left_id", F.col(key).alias("right_id")))
