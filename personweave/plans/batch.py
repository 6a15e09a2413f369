"""Full batch resolution: staged records in, members, golden records and crosswalk out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personweave.operators.cluster import MANUAL, connected_components, entity_ids, separated_components
from personweave.operators.normalize import apart, best_possible_weight, collapse_profiles, prepare_records, with_profile_key
from personweave.operators.pairs import scored_pairs
from personweave.operators.survive import build_crosswalk, golden_records
from personweave.operators.train import train
from personweave.plans.report import Watch, nulls
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec


@dataclass(frozen=True)
class Resolution:
    """Tables of one batch run, all written out."""

    members: DataFrame  # staged + normalised columns, rec_id, entity_id
    golden: DataFrame
    crosswalk: DataFrame
    spec: IdentitySpec


def prepared(staged: DataFrame, spec: IdentitySpec) -> tuple[DataFrame, DataFrame]:
    """Normalised records and their distinct profiles, both written once."""
    records = scratch_table(prepare_records(staged, spec), "records")
    return records, scratch_table(collapse_profiles(records, spec), "profiles")


def assign_entities(records: DataFrame, profiles: DataFrame, links: DataFrame) -> DataFrame:
    """Records with the entity of their profile."""
    components = connected_components(profiles.select("vid"), links, "vid")
    entities = profiles.select("profile_key", "vid").join(entity_ids(components), "vid")
    return records.join(entities.select("profile_key", "entity_id"), "profile_key").drop("profile_key")


def resolve_links(records: DataFrame, profiles: DataFrame, spec: IdentitySpec,
                  overrides: DataFrame | None = None) -> DataFrame:
    """Entity of every record from profile links, with manual decisions on record pairs if given.

    Overrides hold whatever else links the records: both ends of a merge share an entity, both ends of a split don't.
    """
    links = scored_pairs(profiles.drop("profile_key"), spec, spec.match, links=True, spanning=overrides is None
                         ).select("left_id", "right_id", "weight")
    if overrides is None:
        return assign_entities(records, profiles, links)
    # Overrides name records, so copies must be separable: work on records, linked to the first of their copies.
    own = profiles.select("profile_key", "vid", best_possible_weight(spec).alias("weight"))
    copies = (records.select("profile_key", "rec_id").join(own, "profile_key").where(F.col("rec_id") != F.col("vid"))
              .select(F.col("vid").alias("left_id"), F.col("rec_id").alias("right_id"), "weight"))
    merges = overrides.where("kind = 'merge'").select("left_id", "right_id", F.lit(MANUAL).alias("weight"))
    known = records.select(F.col("rec_id").alias("left_id"))
    merges = merges.join(known, "left_id", "left_semi").join(known.select(F.col("left_id").alias("right_id")), "right_id", "left_semi")
    edges = links.unionByName(copies).unionByName(merges)
    components = entity_ids(separated_components(records.select("rec_id"), edges, overrides.where("kind = 'split'")))
    return records.join(components.select("rec_id", "entity_id"), "rec_id").drop("profile_key")


def reconcile(staged: DataFrame, spec: IdentitySpec, as_of: str, trained: bool = True,
              overrides: DataFrame | None = None, watch: Watch | None = None) -> Resolution:
    """Resolve all staged records. Unless `trained` is off, m and u are first estimated from the data.

    `overrides` has `kind` (`merge` or `split`) and two record ids; records named by a split are compared on their own.
    A `watch` counts staged records, golden records and the crosswalk while they are written.
    """
    records, profiles = prepared(staged if watch is None else watch("input", staged), spec)
    if trained:
        spec = spec.with_parameters(train(profiles, spec))
    if trained or overrides is not None:
        # Which copies belong together depends on the parameters and the splits; the normalised values do not.
        records = scratch_table(apart(with_profile_key(records, spec), overrides), "records")
        profiles = scratch_table(collapse_profiles(records, spec), "profiles")
    members = scratch_table(resolve_links(records, profiles, spec, overrides), "members")
    golden = golden_records(members, spec, as_of)
    golden = scratch_table(golden if watch is None else watch("golden", golden), "golden")
    crosswalk = build_crosswalk(golden, members)
    if watch is not None:
        crosswalk = watch("crosswalk", crosswalk, broken=nulls("source_id", "entity_id"))
    return Resolution(members, golden, scratch_table(crosswalk, "crosswalk"), spec)
