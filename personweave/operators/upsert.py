"""Upserts and change capture on plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPDATED_ON_MATCH = ("email", "phone", "first_name", "last_name", "company_name", "confidence_score")


def last_per_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The row with the largest `order` for every key."""
    rest = [c for c in df.columns if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """All rows of both tables; for keys in both, the `update` columns come from `new`, the others from `old`.

    `new` has the columns of `old`; of several rows of one key the largest one (column by column) counts.
    """
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("_old"))
    n = new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_new"))
    joined = o.join(n, keys, "full")

    def value(c: str):
        keep = F.col("_new").isNull() | (F.lit(c not in update) & F.col("_old").isNotNull())
        return F.when(keep, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)

    return joined.select(*[F.col(c) if c in keys else value(c) for c in old.columns])


def upsert_crosswalk(old: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the entity of known records, add unknown records."""
    keys = ["source_system", "source_id"]
    return upsert(old, new, keys, [c for c in old.columns if c not in keys])


def upsert_golden(old: DataFrame, new: DataFrame) -> DataFrame:
    """Refresh attributes and confidence of known entities (type, source and creation time stay), add new ones."""
    update = [c for c in old.columns if c in UPDATED_ON_MATCH or c == "updated_version"]
    return upsert(old, new, ["entity_id"], update)


def cdc_diff(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Changes between two states: INSERT, DELETE, and for an update both with `_is_update` set."""
    rest = [c for c in before.columns if c not in key]
    joined = (before.select(*key, F.struct(*rest).alias("_b"))
              .join(after.select(*key, F.struct(*rest).alias("_a")), key, "full"))
    same = F.col("_b").isNotNull() & F.col("_a").isNotNull() & reduce(
        lambda x, y: x & y, [F.col(f"_b.{c}").eqNullSafe(F.col(f"_a.{c}")) for c in rest])
    update = F.col("_b").isNotNull() & F.col("_a").isNotNull()
    images = F.array(F.when(F.col("_b").isNotNull(), F.struct(F.lit("DELETE").alias("action"), F.col("_b").alias("row"))),
                     F.when(F.col("_a").isNotNull(), F.struct(F.lit("INSERT").alias("action"), F.col("_a").alias("row"))))
    return (joined.where(~same).select(*key, F.explode(F.filter(images, lambda i: i.isNotNull())).alias("_i"),
                                       update.alias("_is_update"))
            .select(*[F.col(c) if c in key else F.col(f"_i.row.{c}").alias(c) for c in before.columns],
                    F.col("_i.action").alias("_action"), "_is_update"))


def cdc_inserts(changes: DataFrame) -> DataFrame:
    """New rows and the new images of updates; deletes are skipped."""
    return changes.where(F.col("_action") == "INSERT")


def export_since(table: DataFrame, version: int) -> DataFrame:
    """Rows written after a version."""
    return table.where(F.col("updated_version") > version)


def export_between(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What a receiver of the state `before` needs to get to `after`: rows of `after` that are new or changed, and the last
    rows of keys that are gone, marked `removed`. Rows that stayed the same are left out."""
    rest = [c for c in before.columns if c not in keys]
    both = (before.select(*keys, F.struct(*rest).alias("_b")).join(after.select(*keys, F.struct(*rest).alias("_a")), keys, "full"))
    gone = F.col("_a").isNull()
    return (both.where(gone | F.col("_b").isNull() | ~F.col("_a").eqNullSafe(F.col("_b")))
            .select(*[F.col(c) if c in keys else F.coalesce("_a", "_b").getField(c).alias(c) for c in before.columns], gone.alias("removed")))
