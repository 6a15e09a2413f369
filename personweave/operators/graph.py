"""Lookups in the identity graph, its history, and manual locks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from personweave.operators.upsert import upsert_golden
from personweave.sources.scratch import scratch_table

RECORD = ("source_system", "source_id")


def resolve_ids(ids: DataFrame, crosswalk: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Entity of every (source_system, source_id); null for unknown ones.

    With `events` an older crosswalk may be asked: entities absorbed since then lead to the one that absorbed them.
    """
    found = ids.join(crosswalk.select(*RECORD, "entity_id"), list(RECORD), "left")
    if events is None:
        return found
    moved = absorbed(events).withColumnRenamed("now", "_now")
    return found.join(moved, "entity_id", "left").withColumn("entity_id", F.coalesce("_now", "entity_id")).select(*found.columns)


def linked_records(entity_ids: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Member records of the given entities."""
    return crosswalk.join(entity_ids.select("entity_id").distinct(), "entity_id", "left_semi").select(
        "entity_id", *RECORD)


def search_entities(golden: DataFrame, q: str) -> DataFrame:
    """Golden records with this email, or with the text in any attribute."""
    text = F.lower(F.concat_ws(" ", "first_name", "last_name", "email", "phone", "company_name"))
    wanted = F.lit(q.strip().lower())
    return golden.where((F.col("email") == wanted) | F.contains(text, wanted))


def entity_history(before: DataFrame, after: DataFrame, version: int) -> DataFrame:
    """What happened between two crosswalks.

    Records: `linked` (new), `moved`, `unlinked` (gone). Entities: `created`; `merged` when all records of an entity
    went to one other entity; `split` when only a part of them did, or to several.
    """
    old = before.select(*RECORD, F.col("entity_id").alias("old_id"))
    new = after.select(*RECORD, F.col("entity_id").alias("new_id"))
    both = old.join(new, list(RECORD), "full")
    record_event = (F.when(F.col("old_id").isNull(), "linked").when(F.col("new_id").isNull(), "unlinked")
                    .otherwise("moved"))
    changed = ~F.col("old_id").eqNullSafe(F.col("new_id"))
    records = both.where(changed).select(
        record_event.alias("event"), F.coalesce("new_id", "old_id").alias("entity_id"),
        F.when(F.col("new_id").isNotNull(), F.col("old_id")).alias("other_entity_id"), *RECORD)

    no_record = [F.lit(None).cast("string").alias(c) for c in RECORD]
    created = (after.select("entity_id").distinct().join(before.select("entity_id").distinct(), "entity_id", "left_anti")
               .select(F.lit("created").alias("event"), "entity_id", F.lit(None).cast("string").alias("other_entity_id"),
                       *no_record))
    flows = both.where(F.col("old_id").isNotNull() & F.col("new_id").isNotNull()).select("old_id", "new_id").distinct()
    targets = flows.groupBy("old_id").agg(F.count(F.lit(1)).alias("targets"))
    entities = flows.where(F.col("old_id") != F.col("new_id")).join(targets, "old_id").select(
        F.when(F.col("targets") == 1, "merged").otherwise("split").alias("event"),
        F.col("new_id").alias("entity_id"), F.col("old_id").alias("other_entity_id"), *no_record)
    events = records.unionByName(created).unionByName(entities)
    return events.select(F.lit(version).cast("long").alias("version"), "event", "entity_id", "other_entity_id", *RECORD)


def with_cause(events: DataFrame, cause: str, records: DataFrame | None = None, absorbed_by: DataFrame | None = None) -> DataFrame:
    """Events with `cause` and `weight`: why something happened, and how strong the evidence was.

    `records` (`source_system`, `source_id`, `cause`, `weight`) explains records that were linked, `absorbed_by` (`entity_id`,
    `cause`, `weight`) the entities that went into others, for their own event and for the records that moved with them.
    Whatever neither explains has the given cause and no weight.
    """
    unexplained = [F.lit(None).cast("string").alias("_c"), F.lit(None).cast("double").alias("_w")]
    linked, absorption = F.col("event") == "linked", F.col("event").isin("moved", "merged")
    rest = events.where(~(linked | absorption)).select("*", *unexplained)
    parts = [rest]
    for condition, keys, evidence in ((linked, list(RECORD), records), (absorption, ["other_entity_id"], absorbed_by)):
        some = events.where(condition)
        if evidence is None:
            parts.append(some.select("*", *unexplained))
            continue
        named = evidence.withColumnRenamed("entity_id", "other_entity_id").select(*keys, F.col("cause").alias("_c"), F.col("weight").alias("_w"))
        parts.append(some.join(named, keys, "left").select(*events.columns, "_c", "_w"))
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.select(*events.columns, F.coalesce("_c", F.lit(cause)).alias("cause"), F.col("_w").alias("weight"))


def crosswalk_as_of(events: DataFrame, version: int) -> DataFrame:
    """Crosswalk after the given version, rebuilt from the record events."""
    latest = (events.where((F.col("version") <= version) & F.col("event").isin("linked", "moved", "unlinked"))
              .groupBy(*RECORD).agg(F.max_by(F.struct("event", "entity_id"), "version").alias("last")))
    return latest.where(F.col("last.event") != "unlinked").select(*RECORD, F.col("last.entity_id").alias("entity_id"))


def validity(events: DataFrame) -> DataFrame:
    """`source_system`, `source_id`, `entity_id`, `first`, `last`: the versions during which a record was in an entity; `last`
    is null where it still is. Of several events of a record in one version the largest entity counts."""
    states = (events.where(F.col("event").isin("linked", "moved", "unlinked"))
              .groupBy(*RECORD, "version").agg(F.max(F.struct(F.when(F.col("event") != "unlinked", F.col("entity_id")).alias("entity_id"))).alias("s")))
    following = F.lead("version").over(Window.partitionBy(*RECORD).orderBy("version"))  # the events of one record
    return (states.select(*RECORD, F.col("s.entity_id").alias("entity_id"), F.col("version").alias("first"), (following - 1).alias("last"))
            .where(F.col("entity_id").isNotNull()))


def entities_at(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """The rows of `asked` (with `source_system`, `source_id`, `version`) and the `entity_id` of the record as of that
    version; null where it was in none. Any number of versions at once, from the intervals of `validity`."""
    valid = intervals.withColumnsRenamed({c: f"_{c}" for c in (*RECORD, "entity_id", "first", "last")})
    same = (F.col("source_system") == F.col("_source_system")) & (F.col("source_id") == F.col("_source_id"))
    within = (F.col("version") >= F.col("_first")) & (F.col("_last").isNull() | (F.col("version") <= F.col("_last")))
    return asked.join(valid, same & within, "left").select(*[asked[c] for c in asked.columns], F.col("_entity_id").alias("entity_id"))


def revert(events: DataFrame, current: DataFrame, version: int, new_version: int) -> tuple[DataFrame, DataFrame]:
    """Go back to an earlier version: the restored crosswalk and the events that record the step."""
    restored = crosswalk_as_of(events, version)
    return restored, entity_history(current, restored, new_version)


def absorbed(events: DataFrame) -> DataFrame:
    """`entity_id`, `now`: every absorbed entity and the one that holds its records now, through chains of merges.

    Each round doubles the length of the chains that are followed, so their number is the logarithm of the longest chain.
    """
    now = scratch_table(events.where(F.col("event") == "merged").groupBy(F.col("other_entity_id").alias("entity_id")).agg(
        F.max_by("entity_id", "version").alias("now")), "absorbed")
    while True:
        ahead = now.select(F.col("entity_id").alias("now"), F.col("now").alias("_next"))
        longer = now.join(ahead, "now", "left")
        if longer.where(F.col("_next").isNotNull() & (F.col("_next") != F.col("entity_id"))).isEmpty():
            return now
        # An entity that came back to life after it was absorbed ends its own chain.
        onward = F.when(F.col("_next") != F.col("entity_id"), F.col("_next"))
        now = scratch_table(longer.select("entity_id", F.coalesce(onward, "now").alias("now")), "absorbed")


def follow_merges(ids: DataFrame, events: DataFrame) -> DataFrame:
    """Redirect absorbed entity ids to the entity that holds their records now."""
    return ids.join(absorbed(events), "entity_id", "left").select(
        F.coalesce("now", "entity_id").alias("entity_id"), F.col("entity_id").alias("asked_id"))


def apply_with_locks(new: DataFrame, old: DataFrame, locks: DataFrame) -> DataFrame:
    """Golden upsert in which locked entities keep their stored attributes."""
    return upsert_golden(old, new.join(locks.select("entity_id").distinct(), "entity_id", "left_anti"))
