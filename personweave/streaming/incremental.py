"""Resolution of a batch of change records against the identity graph, as joins over the whole batch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.operators.blocking import block_keys
from personweave.operators.cluster import MANUAL, connected_components, entity_id, separated_components
from personweave.operators.graph import entity_history, with_cause
from personweave.operators.normalize import (
    apart, best_possible_weight, collapse_profiles, prepare_records, presence_mask, record_id, with_profile_key,
)
from personweave.operators.pairs import block_pairs, scored_pairs, split_by_size
from personweave.operators.score import compare_pairs, confidence, score
from personweave.operators.strongest import strongest_in
from personweave.operators.survive import golden_records
from personweave.operators.upsert import cdc_inserts, last_per_key, upsert_golden
from personweave.schemas import ATTRIBUTES, STAGED_COLUMNS
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec


@dataclass(frozen=True)
class Graph:
    """Current tables of the identity graph."""

    members: DataFrame  # rec_id, staged and normalised columns, entity_id
    golden: DataFrame
    locks: DataFrame | None = None
    overrides: DataFrame | None = None  # kind (merge or split), left_id, right_id: record ids

    def crosswalk(self) -> DataFrame:
        return self.members.select("source_system", F.col("external_id").alias("source_id"), "entity_id")


@dataclass(frozen=True)
class BatchResult:
    """What one batch of changes did; the tables hold changed rows only."""

    results: DataFrame
    errors: DataFrame
    members: DataFrame
    golden: DataFrame
    removed: DataFrame  # member rows deleted by tombstones
    ended: DataFrame  # entity ids merged into another one or left without members
    events: DataFrame  # what happened to records and entities, with cause and weight


def problem(spec: IdentitySpec | None = None) -> Column:
    """Why a change record cannot be resolved; null if it can."""
    empty = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(a)), F.lit("")) == "" for a in ATTRIBUTES])
    found = (F.when(F.coalesce("source_system", F.lit("")) == "", "missing source_system")
             .when(F.coalesce("external_id", F.lit("")) == "", "missing external_id")
             .when(empty, "no attributes"))
    if spec is not None:
        found = found.when(~F.col("source_system").isin(*spec.sources), "unknown source")
    return found


def reject_invalid(changes: DataFrame, spec: IdentitySpec | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and `errors` (source_system, external_id, error); one bad row does not stop the batch."""
    checked = changes.withColumn("error", problem(spec))
    return (checked.where(F.col("error").isNull()).drop("error"),
            checked.where(F.col("error").isNotNull()).select("source_system", "external_id", "error"))


def resolve_known(changes: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Records whose source and id are already linked: they keep their entity, without any scoring."""
    links = crosswalk.select("source_system", F.col("source_id").alias("external_id"), "entity_id")
    return changes.join(links, ["source_system", "external_id"]).withColumns({
        "is_new": F.lit(False), "matched_source": F.col("source_system"), "confidence": F.lit(1.0)})


def _stored_profiles(members: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Stored records by entity and values: copies within an entity count once."""
    fields = [f.column for f in spec.fields]
    return (members.groupBy("entity_id", *fields).agg(F.min("rec_id").alias("vid"))
            .withColumn("mask", presence_mask(spec)))


def _touched(profiles: DataFrame, members: DataFrame, spec: IdentitySpec, profile: str) -> DataFrame:
    """Stored records that share a block with a new profile."""
    fields = [f.column for f in spec.fields]
    wanted = block_keys(profiles.select(*fields), spec, profile).select("key_type", "key_value").distinct()
    return block_keys(members.select("rec_id", "entity_id", *fields), spec, profile).join(
        wanted, ["key_type", "key_value"], "left_semi")


def candidates_vs_graph(profiles: DataFrame, members: DataFrame, spec: IdentitySpec, profile: str = "incremental",
                        floor: float | None = None, deciding: bool = False) -> DataFrame:
    """Scored pairs of new profiles (left) and stored records (right) that share a blocking key, all of them.

    Stored records outside the blocks of the batch are dropped by the first join; copies within an entity count once. With
    `deciding` oversized blocks give only the pairs that `link_or_new` decides by: all pairs grow with the square of a block.
    """
    if deciding:
        floor = spec.match if floor is None else floor
        pairs, large = _met_in_blocks(profiles, members, spec, profile, floor)
        values = [f"r_{f.column}" for f in spec.fields]
        pairs = pairs.select("left_id", "right_id", "r_entity_id", "weight", *values)
        if large is None:
            return pairs
        hot = strongest_in(large, spec, profile, floor, second=True)
        return pairs.unionByName(hot.select("left_id", F.col("matched_id").alias("right_id"), F.col("entity_id").alias("r_entity_id"),
                                            "weight", *[f"matched_values.{c}" for c in values]))
    stored = _stored_profiles(_touched(profiles, members, spec, profile), spec)
    floor = spec.match if floor is None else floor
    return scored_pairs(profiles.select("vid", "mask", *[f.column for f in spec.fields]), spec, floor, right=stored, profile=profile)


def _met_in_blocks(profiles: DataFrame, members: DataFrame, spec: IdentitySpec, profile: str, floor: float
                   ) -> tuple[DataFrame, DataFrame | None]:
    """Scored pairs of new profiles and stored records in ordinary blocks, and the rows of oversized ones."""
    fields = [f.column for f in spec.fields]
    touched = _touched(profiles, members, spec, profile).select("key_type", "key_value", "rec_id", "entity_id", *fields)
    # In a block a stored profile stands for all copies of its entity.
    stored = (touched.groupBy("key_type", "key_value", "entity_id", *fields).agg(F.min("rec_id").alias("vid"))
              .withColumn("mask", presence_mask(spec)))
    new = block_keys(profiles.select("vid", "mask", *fields), spec, profile)
    keyed = scratch_table(new.withColumn("side", F.lit("L")).unionByName(stored.withColumn("side", F.lit("R")), allowMissingColumns=True), "blocks")
    ordinary, large = split_by_size(keyed, spec)
    pairs = score(compare_pairs(block_pairs(ordinary, spec, profile), spec, floor), spec).where(F.col("weight") >= floor)
    return pairs.withColumnsRenamed({"l_vid": "left_id", "r_vid": "right_id"}), large


def strongest_candidates(profiles: DataFrame, members: DataFrame, spec: IdentitySpec, profile: str = "incremental") -> DataFrame:
    """`left_id, entity_id, weight, matched_id, matched_values`: what `link_or_new` and `merged_entities` need to know.

    Pairs are listed in ordinary blocks only; in oversized ones new rows meet groups of stored rows.
    """
    pairs, large = _met_in_blocks(profiles, members, spec, profile, spec.match)
    found = entity_candidates(pairs)
    if large is None:
        return found
    hot = strongest_in(large, spec, profile, spec.match).select(*found.columns)
    best = F.min(F.struct((-F.col("weight")).alias("o"), "matched_id", "matched_values"))
    return found.unionByName(hot).groupBy("left_id", "entity_id").agg(F.max("weight").alias("weight"), best.alias("b")).select(
        "left_id", "entity_id", "weight", "b.matched_id", "b.matched_values")


def entity_candidates(pairs: DataFrame) -> DataFrame:
    """Strongest pair per new record and entity: `left_id, entity_id, weight, matched_id`, and the matched values."""
    values = F.struct(*[c for c in pairs.columns if c.startswith("r_n_")]).alias("values")
    best = F.min(F.struct((-F.col("weight")).alias("o"), "right_id", values))
    return pairs.groupBy("left_id", F.col("r_entity_id").alias("entity_id")).agg(
        F.max("weight").alias("weight"), best.alias("b")).select(
        "left_id", "entity_id", "weight", F.col("b.right_id").alias("matched_id"), F.col("b.values").alias("matched_values"))


def link_or_new(candidates: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Two-threshold decision per record with candidates.

    At or above `match` the record is linked to its strongest entity (`link`); if it reaches `merge` with several
    entities, those are merged as well (`merge`); below, it becomes a new entity (`new`).
    """
    best = F.min(F.struct((-F.col("weight")).alias("o"), "entity_id", "matched_id", "weight", "matched_values"))
    decided = candidates.groupBy("left_id").agg(
        best.alias("b"), F.count(F.when(F.col("weight") >= spec.merge, 1)).alias("strong"))
    weight = F.col("b.weight")
    linked = weight >= spec.match
    return decided.select(
        "left_id",
        F.when(linked & (F.col("strong") > 1), "merge").when(linked, "link").otherwise("new").alias("decision"),
        F.when(linked, F.col("b.entity_id")).alias("entity_id"),
        F.when(linked, F.col("b.matched_id")).alias("matched_id"),
        F.when(linked, confidence(weight, spec)).otherwise(F.lit(1.0)).alias("confidence"),
        weight.alias("weight"), F.col("b.matched_values").alias("matched_values"))


def merged_entities(candidates: DataFrame, spec: IdentitySpec, locks: DataFrame | None, splits: DataFrame | None = None
                    ) -> DataFrame:
    """`entity_id, survivor, weight` of entities that one record ties together above the merge threshold; `weight` is the
    strongest with which such a record matches the entity that goes.

    Locked entities take no part in merges, and `splits` (pairs of entities) are never merged. The smallest id survives.
    """
    strong = candidates.where(F.col("weight") >= spec.merge).select("left_id", "entity_id", "weight")
    if locks is not None:
        strong = strong.join(locks.select("entity_id"), "entity_id", "left_anti")
    first = strong.groupBy("left_id").agg(F.min("entity_id").alias("first"), F.max("entity_id").alias("last"))
    tied = scratch_table(strong.join(first.where(F.col("first") != F.col("last")).drop("last"), "left_id"), "tied")
    edges = (tied.where(F.col("entity_id") != F.col("first"))
             .groupBy(F.col("first").alias("left_id"), F.col("entity_id").alias("right_id")).agg(F.max("weight").alias("weight")))
    edges = scratch_table(edges, "merges")
    if edges.isEmpty():
        return edges.select(F.col("left_id").alias("entity_id"), F.col("right_id").alias("survivor"), "weight")
    nodes = edges.select(F.col("left_id").alias("entity_id")).unionByName(
        edges.select(F.col("right_id").alias("entity_id"))).distinct()
    found = (connected_components(nodes, edges, "entity_id") if splits is None
             else separated_components(nodes, edges, splits, "entity_id")).withColumnRenamed("component", "survivor")
    evidence = tied.groupBy("entity_id").agg(F.max("weight").alias("weight"))
    return found.where(F.col("entity_id") != F.col("survivor")).join(evidence, "entity_id").select("entity_id", "survivor", "weight")


def _caused(weight: Column) -> list[Column]:
    """`cause` and `weight` of what happened by a weight: that of a manual decision is no evidence."""
    manual = weight >= MANUAL
    return [F.when(manual, "override").otherwise("scored").alias("cause"), F.when(~manual, weight).alias("weight")]


def _manual(overrides: DataFrame, kind: str) -> DataFrame:
    """`a`, `b`: the record pairs of one kind of override, both ways."""
    pairs = overrides.where(F.col("kind") == kind)
    return pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")).unionByName(
        pairs.select(F.col("right_id").alias("a"), F.col("left_id").alias("b")))


@dataclass(frozen=True)
class _Decisions:
    """What overrides say about a batch."""

    linked: DataFrame  # candidates that a person has set: new profile and entity
    barred: DataFrame  # left_id, entity_id: a new profile that must stay out of an entity
    entities: DataFrame  # left_id, right_id: entities that must not merge
    merged: DataFrame  # left_id, right_id, weight: new profiles that belong together
    split: DataFrame  # left_id, right_id: new profiles that don't


def _decisions(overrides: DataFrame, records: DataFrame, profiles: DataFrame, members: DataFrame, fields: list[str]) -> _Decisions:
    vids = records.select("rec_id", "profile_key").join(profiles.select("profile_key", "vid"), "profile_key")
    new = {c: vids.select(F.col("rec_id").alias(c), F.col("vid").alias(f"{c}_vid")) for c in "ab"}
    old = {c: members.select(F.col("rec_id").alias(c), F.col("entity_id").alias(f"{c}_entity"), *(fields if c == "b" else []))
           for c in "ab"}
    merge, split = _manual(overrides, "merge"), _manual(overrides, "split")
    values = F.struct(*[F.col(c).alias(f"r_{c}") for c in fields])
    linked = merge.join(new["a"], "a").join(old["b"], "b").select(
        F.col("a_vid").alias("left_id"), F.col("b_entity").alias("entity_id"), F.lit(MANUAL).alias("weight"),
        F.col("b").alias("matched_id"), values.alias("matched_values"))
    barred = split.join(new["a"], "a").join(old["b"], "b").select(F.col("a_vid").alias("left_id"), F.col("b_entity").alias("entity_id"))
    entities = split.join(old["a"], "a").join(old["b"], "b").select(F.col("a_entity").alias("left_id"), F.col("b_entity").alias("right_id"))
    both = [x.join(new["a"], "a").join(new["b"], "b").select(F.col("a_vid").alias("left_id"), F.col("b_vid").alias("right_id"))
            for x in (merge, split)]
    return _Decisions(linked, scratch_table(barred.distinct(), "barred"), entities.distinct(),
                      both[0].distinct().withColumn("weight", F.lit(MANUAL)), both[1].distinct())


def _assign_new(records: DataFrame, profiles: DataFrame, members: DataFrame, graph: Graph, spec: IdentitySpec, profile: str
                ) -> tuple[DataFrame, DataFrame]:
    """Entity of every record not seen before, and the merges its evidence causes.

    A record is linked by its own evidence against `members`, else through the batch records it is connected with: to the
    entity that the strongest of them is linked to, or to the first of them. Its confidence is that of its comparison
    with the record it is said to match.
    """
    fields = [f.column for f in spec.fields]
    candidates = strongest_candidates(profiles, members, spec, profile)
    edges = scored_pairs(profiles.select("vid", "n", "mask", *fields), spec, spec.match, profile=profile, links=True,
                         spanning=graph.overrides is None).select("left_id", "right_id", "weight")
    manual = None
    if graph.overrides is not None:
        manual = _decisions(graph.overrides, records, profiles, members, fields)
        best = F.min(F.struct((-F.col("weight")).alias("o"), "matched_id", "matched_values"))
        candidates = (candidates.unionByName(manual.linked).join(manual.barred, ["left_id", "entity_id"], "left_anti")
                      .groupBy("left_id", "entity_id").agg(F.max("weight").alias("weight"), best.alias("b"))
                      .select("left_id", "entity_id", "weight", "b.matched_id", "b.matched_values"))
        edges = edges.unionByName(manual.merged)
    candidates = scratch_table(candidates, "candidates")
    merges = scratch_table(merged_entities(candidates, spec, graph.locks, manual and manual.entities), "merges")
    direct = link_or_new(candidates, spec).where(F.col("decision") != "new").select(
        F.col("left_id").alias("vid"), F.col("entity_id").alias("own_entity"), F.col("matched_id").alias("own_matched"),
        F.col("confidence").alias("own_confidence"), F.col("weight").alias("own_weight"), F.col("matched_values").alias("own_values"))
    groups = (connected_components(profiles.select("vid"), edges, "vid") if manual is None
              else separated_components(profiles.select("vid"), edges, manual.split, "vid"))

    rows = (records.select("rec_id", "source_system", "external_id", "profile_key", "_seq", *fields)
            .join(profiles.select("profile_key", "vid"), "profile_key").join(groups, "vid").join(direct, "vid", "left"))
    head = F.struct("_seq", "rec_id", "source_system", F.struct(*fields).alias("values"))
    own = F.col("own_entity").isNotNull()
    link = F.when(own, F.struct((-F.col("own_weight")).alias("o"), F.col("own_entity").alias("entity_id"),
                                F.col("own_matched").alias("matched_id"), F.col("own_values").alias("values")))
    of_group = rows.groupBy("component").agg(F.min(head).alias("head"), F.min(link).alias("link"))
    rows = rows.join(of_group, "component")
    through = F.col("link").isNotNull()
    partner = [F.when(through, F.col(f"link.values.r_{c}")).otherwise(F.col(f"head.values.{c}")).alias(f"r_{c}") for c in fields]
    rows = score(compare_pairs(rows.select("*", *[F.col(c).alias(f"l_{c}") for c in fields], *partner), spec), spec)
    is_new = ~through & (F.col("rec_id") == F.col("head.rec_id"))
    assigned = rows.select(
        "rec_id", "vid", "source_system", "external_id",
        F.coalesce("own_entity", "link.entity_id", entity_id(F.col("component"))).alias("entity_id"),
        is_new.alias("is_new"),
        F.when(own, F.split_part("own_matched", F.lit(":"), F.lit(1)))
        .when(through, F.split_part("link.matched_id", F.lit(":"), F.lit(1)))
        .when(~is_new, F.col("head.source_system")).alias("matched_source"),
        F.when(own, F.col("own_confidence")).when(is_new, F.lit(1.0)).otherwise(F.col("confidence")).alias("confidence"),
        F.when(own, F.col("own_weight")).when(~is_new, F.col("weight")).alias("weight"))
    survivor = merges.select("entity_id", "survivor")

    def moved(df: DataFrame) -> DataFrame:
        return (df.join(survivor, "entity_id", "left")
                .withColumn("entity_id", F.coalesce("survivor", "entity_id")).drop("survivor"))

    assigned = moved(assigned)
    if manual is not None:
        # What other records lead to may be an entity that this record must stay out of: it then is one of its own.
        barred = moved(manual.barred).select(F.col("left_id").alias("vid"), "entity_id", F.lit(True).alias("_barred")).distinct()
        out = F.col("_barred").isNotNull()
        assigned = assigned.join(barred, ["vid", "entity_id"], "left").withColumns({
            "entity_id": F.when(out, entity_id(F.col("vid"))).otherwise(F.col("entity_id")),
            "is_new": F.when(out, F.col("rec_id") == F.col("vid")).otherwise(F.col("is_new")),
            "matched_source": F.when(~out, F.col("matched_source")),
            "confidence": F.when(out, F.lit(1.0)).otherwise(F.col("confidence")),
            "weight": F.when(out & ~F.col("is_new"), F.lit(MANUAL)).when(~out, F.col("weight"))}).drop("_barred")
    return assigned.drop("vid"), merges


def _last_actions(changes: DataFrame) -> DataFrame:
    """Per record its last change; of the two images of an update with one number the new one counts."""
    order = F.struct("_seq", (F.col("_action") == "INSERT").alias("new"))
    return last_per_key(changes.select(*STAGED_COLUMNS, "_action", "_seq"), ["source_system", "external_id"], order)


def resolve_batch(changes: DataFrame, graph: Graph, spec: IdentitySpec, as_of: str, version: int = 0,
                  profile: str = "incremental", tombstone: bool = False) -> BatchResult:
    """Resolve a batch of change rows (staged columns, `_action`, `_seq`) against the graph.

    Known records keep their entity and refresh their attributes. New records are compared with the stored records as
    they are after the batch, linked by score, grouped among themselves, or become new entities. Golden records of all
    touched entities are recomputed. Events name their cause: `scored` with the weight of the comparison that linked a
    record or of the record that ties two entities together, `override`, or `change` where the change itself is the cause
    (a first record, a deletion). Deletes are skipped unless `tombstone` is set; then the last action of a record
    counts. Overrides of the graph hold for the records of the batch.
    """
    valid, errors = reject_invalid(cdc_inserts(changes), spec)
    gone = None
    if tombstone:
        deletes = changes.where(F.col("_action") == "DELETE")
        last = _last_actions(valid.unionByName(deletes, allowMissingColumns=True))
        latest = last.where(F.col("_action") == "INSERT").drop("_action")
        gone = last.where(F.col("_action") == "DELETE").select(record_id().alias("rec_id"))
    else:
        latest = last_per_key(valid.select(*STAGED_COLUMNS, "_seq"), ["source_system", "external_id"], "_seq")
    records = scratch_table(apart(prepare_records(latest, spec, profile), graph.overrides), "changes")
    columns = [c for c in graph.members.columns if c != "updated_version"]

    # One scan of the stored members finds the known records; what follows uses this small table.
    stored = scratch_table(graph.members.select("rec_id", "source_system", F.col("external_id").alias("source_id"), "entity_id")
                           .join(records.select("rec_id"), "rec_id", "left_semi"), "known")
    known = resolve_known(records, stored).select(
        "rec_id", "source_system", "external_id", "entity_id", "is_new", "matched_source", "confidence",
        F.lit(None).cast("double").alias("weight"))
    unknown = records.join(stored.select("rec_id"), "rec_id", "left_anti")
    profiles = scratch_table(collapse_profiles(unknown, spec), "new-profiles")
    # New records meet the known ones with the values that this batch brings.
    refreshed = records.join(stored.select("rec_id", "entity_id"), "rec_id").select(*columns)
    replaced = records.select("rec_id") if gone is None else records.select("rec_id").unionByName(gone)
    present = graph.members.select(*columns).join(replaced, "rec_id", "left_anti").unionByName(refreshed)
    assigned, merges = _assign_new(unknown, profiles, present, graph, spec, profile)
    known = (known.join(merges.drop("weight"), "entity_id", "left").withColumn("entity_id", F.coalesce("survivor", "entity_id"))
             .drop("survivor"))
    resolved = scratch_table(known.unionByName(assigned), "resolved")

    # Changed member rows: the batch itself, and all members of absorbed entities.
    changed = records.join(resolved.select("rec_id", "entity_id"), "rec_id").select(*columns)
    before = stored.select("source_system", "source_id", "entity_id")
    if not merges.isEmpty():
        moved = scratch_table(graph.members.select(*columns).join(merges, "entity_id")
                              .join(replaced, "rec_id", "left_anti"), "moved")
        changed = changed.unionByName(moved.withColumn("entity_id", F.col("survivor")).select(*columns))
        before = before.unionByName(_links(moved))
    changed = scratch_table(changed, "changed-members")
    touched, seen = changed.select("entity_id"), changed.select("rec_id")
    removed = changed.where(F.lit(False))
    if gone is not None:
        removed = scratch_table(graph.members.select(*columns).join(gone, "rec_id", "left_semi"), "removed-members")
        touched, seen = touched.unionByName(removed.select("entity_id")), seen.unionByName(removed.select("rec_id"))
        before = before.unionByName(_links(removed))

    # Golden records of touched entities, from all of their members.
    touched = scratch_table(touched.distinct(), "touched")
    kept = (graph.members.select(*columns).join(touched, "entity_id", "left_semi").join(seen, "rec_id", "left_anti"))
    current = scratch_table(kept.unionByName(changed), "touched-members")
    golden, previous = _refreshed_golden(current, touched, graph, spec, as_of)

    canonical = golden.select("entity_id", F.struct(*ATTRIBUTES).alias("canonical_data"))
    results = resolved.join(canonical, "entity_id", "left").select(
        "source_system", "external_id", "entity_id", "is_new", "matched_source", "confidence", "canonical_data")
    # Compared on the changed records only, an entity looks new when none of them was in it: keep the truly new ones.
    existing = previous.select("entity_id", F.lit("created").alias("event"))
    events = entity_history(before, _links(changed), version).join(existing, ["entity_id", "event"], "left_anti")
    evidence = resolved.where(F.col("weight").isNotNull()).select(
        "source_system", F.col("external_id").alias("source_id"), *_caused(F.col("weight")))
    events = with_cause(events, "change", evidence, merges.select("entity_id", *_caused(F.col("weight"))))
    emptied = removed.select("entity_id").distinct().join(current, "entity_id", "left_anti")
    ended = merges.select("entity_id").unionByName(emptied)
    return BatchResult(results, errors, changed, golden, removed, ended, events)


def _refreshed_golden(current: DataFrame, touched: DataFrame, graph: Graph, spec: IdentitySpec, as_of: str
                      ) -> tuple[DataFrame, DataFrame]:
    """Golden records of touched entities from their current members, locked ones as they were; and the stored ones."""
    refreshed = golden_records(current, spec, as_of)
    previous = scratch_table(graph.golden.select(*refreshed.columns).join(touched, "entity_id", "left_semi"), "old-golden")
    if graph.locks is not None:
        locked = previous.select("entity_id").join(graph.locks.select("entity_id"), "entity_id", "left_semi")
        refreshed = refreshed.join(locked, "entity_id", "left_anti")
    return scratch_table(upsert_golden(previous, refreshed), "changed-golden"), previous


def override_entities(graph: Graph, decisions: DataFrame, spec: IdentitySpec, as_of: str, version: int,
                      profile: str = "incremental") -> BatchResult:
    """Apply new manual decisions to the entities that hold the named records; locked entities stay as they are.

    The members of an entity stay together, weakly, whatever once joined them, so that only the splits divide it. The
    part with the smallest record keeps the entity's id; of merged entities the smallest id survives.
    """
    pairs = ["left_id", "right_id"]
    overrides = decisions if graph.overrides is None else decisions.unionByName(graph.overrides.join(
        decisions, pairs, "left_anti").select("kind", *pairs))
    overrides = scratch_table(overrides, "all-overrides")
    named = decisions.select(F.explode(F.array(*pairs)).alias("rec_id")).distinct()
    touched = graph.members.join(named, "rec_id", "left_semi").select("entity_id").distinct()
    if graph.locks is not None:
        touched = touched.join(graph.locks.select("entity_id"), "entity_id", "left_anti")
    touched = scratch_table(touched, "touched")
    columns = [c for c in graph.members.columns if c != "updated_version"]
    members = scratch_table(graph.members.select(*columns).join(touched, "entity_id", "left_semi"), "touched-members")

    records = scratch_table(apart(with_profile_key(members, spec, profile), overrides), "records")
    profiles = scratch_table(collapse_profiles(records, spec), "profiles")
    links = scored_pairs(profiles.drop("profile_key"), spec, spec.match, profile=profile, links=True).select(*pairs, "weight")
    own = profiles.select("profile_key", F.col("vid").alias("left_id"), best_possible_weight(spec).alias("weight"))
    copies = records.select("profile_key", F.col("rec_id").alias("right_id")).join(own, "profile_key").select(*pairs, "weight")
    first = members.groupBy("entity_id").agg(F.min("rec_id").alias("left_id"))
    held = members.join(first, "entity_id").select("left_id", F.col("rec_id").alias("right_id"), F.lit(-MANUAL).alias("weight"))
    here = {c: members.select(F.col("rec_id").alias(c)) for c in pairs}
    merges = (overrides.where("kind = 'merge'").join(here["left_id"], "left_id", "left_semi")
              .join(here["right_id"], "right_id", "left_semi").select(*pairs, F.lit(MANUAL).alias("weight")))
    edges = links.unionByName(copies).unionByName(held).unionByName(merges).where(F.col("left_id") != F.col("right_id"))
    parts = separated_components(members.select("rec_id"), edges, overrides.where("kind = 'split'").select(*pairs))

    keeps = (first.withColumnRenamed("left_id", "rec_id").join(parts, "rec_id")
             .groupBy("component").agg(F.min("entity_id").alias("kept_id")))
    after = scratch_table(members.withColumnRenamed("entity_id", "old_id").join(parts, "rec_id").join(keeps, "component", "left")
                          .withColumn("entity_id", F.coalesce("kept_id", entity_id(F.col("component"))))
                          .select(*columns, "old_id"), "decided-members")
    changed = after.where(F.col("entity_id") != F.col("old_id")).select(*columns)
    current = after.select(*columns)
    golden, _ = _refreshed_golden(current, touched.unionByName(current.select("entity_id")).distinct(), graph, spec, as_of)
    golden = golden.join(current.select("entity_id").distinct(), "entity_id", "left_semi")
    ended = touched.join(current, "entity_id", "left_anti")
    events = with_cause(entity_history(_links(members), _links(current), version), "override")
    nothing = changed.where(F.lit(False))
    return BatchResult(nothing, nothing, changed, golden, nothing, ended, events)


def _links(members: DataFrame) -> DataFrame:
    return members.select("source_system", F.col("external_id").alias("source_id"), "entity_id")


def resolve_summary(results: DataFrame, errors: DataFrame) -> DataFrame:
    """Counters of a batch: total, new, matched, errors."""
    outcome = results.select(F.when(F.col("is_new"), "new").otherwise("matched").alias("outcome")).unionByName(
        errors.select(F.lit("error").alias("outcome")))

    def rows(*names: str) -> Column:
        return F.count(F.when(F.col("outcome").isin(*names), 1))

    return outcome.agg(rows("new", "matched", "error").alias("total"), rows("new").alias("new_entities"),
                       rows("matched").alias("matched"), rows("error").alias("errors"))
