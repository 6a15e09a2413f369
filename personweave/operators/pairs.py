"""Pairs of profiles that share a blocking key and reach a weight.

Ordinary blocks are paired up by one equi-join. A pair is kept only in the block of the first key type its two sides
share, so no shuffle is needed to remove repeats.

A block above `spec.block_limit` is never paired up whole. Its rows already agree on the fields of the key, so for a
given set of present fields the lowest weight of any of its pairs is known:

* where that lowest weight already reaches the floor, all those pairs qualify. Linking every row to one hub row
  connects them just as well (`links=True`), with one link per row and hub instead of all pairs;
* any other qualifying pair agrees on at least one further field. The block is split into sub-blocks by the value of
  that field (equal values, or two values found similar), and a sub-block is again small, or split the same way.

After at most as many steps as there are fields no evidence is left, so the result is complete without a cap.

A listing (`links=False`) makes every pair once, so no shuffle over pairs removes repeats: a pair belongs to the first
key type that its sides share, and within its block to the path of its agreeing fields in order. It is made where that
path first comes to a small sub-block or to certainty; other paths drop it. Links of which only the groups count
(`spanning=True`) are dropped the same way: what such a link connects is connected where the pair belongs, by the pair
itself or by hub links that belong there or still earlier. Blocks and sub-blocks below the limit take hub links for what
is certain as well, so that links grow with the rows; only their other pairs are listed.

A listing does not compare rows but bundles: rows of one block whose texts compared by similarity are equal, up to
`BUNDLE_ROWS` of them. Similarities are computed once per pair of bundles, and pairs of bundles that cannot reach the floor go
before their rows meet. What is left to do per pair of rows is to compare the exact fields, in compiled code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.operators.blocking import SEPARATOR, agreed_fields, block_keys, key_columns
from personweave.operators.score import compare_pairs, compare_similar, field_weight, known_gamma, plausible_pairs, score
from personweave.operators.values import similar_values
from personweave.sources.scratch import scratch_table
from personweave.spec import IdentitySpec, ScoreField

# Rows of one block that a single task joins with the block's hub rows.
ROWS_PER_SLICE = 100_000

# Blocks above this many rows use hubs for links of which only the groups count, whatever the block limit is.
HUB_ROWS = 16

# Rows of one bundle: what a pair of bundles holds in memory, next to the pairs that it stands for.
BUNDLE_ROWS = 32

# The same where links to a hub stand for the pairs of two bundles.
HUB_BUNDLE_ROWS = 128

# Rows of one block that a single task lists with all rows of the block.
LISTED_PER_SLICE = 4_096


def _renamed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def _ordered() -> Column:
    """Each unordered pair once, and only pairs across the two sides of a two-table join."""
    same = (F.col("l_side") == "B") & (F.col("r_side") == "B") & (F.col("l_vid") < F.col("r_vid"))
    return same | ((F.col("l_side") == "L") & (F.col("r_side") == "R"))


def _oriented(joined: DataFrame, self_join: bool, others: list[str] | None = None) -> DataFrame:
    """Swap the two sides where needed: smaller id first in a self join, the left table first otherwise."""
    flip = F.col("l_vid") > F.col("r_vid") if self_join else F.col("l_side") == "R"
    names = [c[2:] for c in joined.columns if c.startswith("l_")]
    return joined.select(*[F.when(flip, F.col(b + n)).otherwise(F.col(a + n)).alias(a + n)
                           for a, b in (("l_", "r_"), ("r_", "l_")) for n in names],
                         *([c for c in joined.columns if c.startswith("gamma_")] if others is None else others))


def _shares(spec: IdentitySpec, profile: str) -> list[tuple[str, Column]]:
    """(key type, condition that both sides of a pair share the key)."""
    if profile == "incremental":
        keys = zip(key_columns(spec, profile, "l_"), key_columns(spec, profile, "r_"))
        return [(name, l == r) for (name, l), (_, r) in keys]
    return [(spec.key_name(parts), reduce(lambda a, b: a & b, [F.col(f"l_n_{p}") == F.col(f"r_n_{p}") for p in parts]))
            for parts in spec.blocking]


def _first_shared_key(spec: IdentitySpec, profile: str) -> Column:
    return F.coalesce(*[F.when(shared, F.lit(name)) for name, shared in _shares(spec, profile)])


def shared_keys(spec: IdentitySpec, profile: str = "batch") -> Column:
    """All key types that the two sides of a pair share."""
    # Compiled, unlike a filter by a lambda function, which cost more per pair than the comparison.
    return F.array_except(F.array(*[F.when(shared, F.lit(name)) for name, shared in _shares(spec, profile)]),
                          F.array(F.lit(None).cast("string")))


def _bundled_fields(spec: IdentitySpec) -> list[str]:
    return [f.column for f in spec.fields if f.comparator != "exact"]


def _bundles(rows: DataFrame, by: list[str], spec: IdentitySpec, bounded: bool = True, size: int = BUNDLE_ROWS) -> DataFrame:
    """`rows` packed by block (`by`), side, present fields and the texts compared by similarity; `rows` holds the other columns.

    Blocks that are not `bounded` are cut by a hash before they are packed, so that no task holds a whole block.
    """
    key = [*by, "side", "mask", *_bundled_fields(spec)]
    members = F.struct("vid", *[c for c in rows.columns if c not in (*key, "vid")])
    if bounded:
        packed = rows.groupBy(*key).agg(F.sort_array(F.collect_list(members)).alias("rows"))
        packed = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.size("rows") - 1) / size).cast("int"))))
        return packed.withColumn("rows", F.slice("rows", F.col("part") * size + 1, size))
    rows = rows.withColumn("_group", F.xxhash64(*key))
    sizes = rows.groupBy("_group").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_parts")).where(F.col("_parts") > 1)
    part = F.coalesce(F.pmod(F.xxhash64("vid"), F.col("_parts")), F.lit(0)).cast("int")
    return (rows.join(sizes, "_group", "left").withColumn("part", part)
            .groupBy(*key, "part").agg(F.sort_array(F.collect_list(members)).alias("rows")))


def _dealt(bundles: DataFrame, *keys: str) -> DataFrame:
    """Bundles dealt to many tasks: few bundles make many pairs, so the size of what is shuffled says little about the work."""
    spark = bundles.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return bundles.repartition(tasks, *keys)


def _ordered_bundles(spec: IdentitySpec) -> Column:
    """Each unordered pair of bundles once, and each of several rows with itself; only pairs across the two sides of a two-table join."""
    l, r = [F.struct(*[p + c for c in ("mask", *_bundled_fields(spec), "part")]) for p in ("l_", "r_")]
    itself = (l == r) & (F.size("l_rows") > 1)
    return ((F.col("l_side") == "B") & (F.col("r_side") == "B") & ((l < r) | itself)) | ((F.col("l_side") == "L") & (F.col("r_side") == "R"))


def _key_parts(spec: IdentitySpec, profile: str) -> list[tuple[str, Column, Column | None]]:
    """(key type, condition on two bundles, further condition on two of their rows) to share the key."""
    exact = [f.name for f in spec.fields if f.comparator == "exact"]

    def equal(names: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.coalesce(F.col(f"l_n_{p}") == F.col(f"r_n_{p}"), F.lit(False)) for p in names], F.lit(True))

    def split(parts: tuple[str, ...]) -> tuple[Column, Column | None]:
        of_rows = [p for p in parts if p in exact]
        return equal([p for p in parts if p not in exact]), equal(of_rows) if of_rows else None

    if profile == "incremental":
        name3 = F.coalesce(dict(_shares(spec, profile))["name3"], F.lit(False))
        in_rows = {"first_name", "last_name"} & set(exact)
        return [("email", *split(("email",))), ("phone", *split(("phone",))),
                ("name3", F.lit(True), name3) if in_rows else ("name3", name3, None)]
    return [(spec.key_name(parts), *split(parts)) for parts in spec.blocking]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _highest_exact(spec: IdentitySpec, profile: str) -> dict[str, Column]:
    """The highest weight of each exact field in a pair of bundles. Rows that are equal on a field which by itself is an earlier
    key belong to the block of that key."""
    names = [name for name, _ in _shares(spec, profile)]
    alone = {parts[0]: spec.key_name(parts) for parts in spec.blocking if len(parts) == 1}
    if profile == "incremental":
        alone = {"email": "email", "phone": "phone"}
    out = {}
    for i, f in enumerate(spec.fields):
        if f.comparator == "exact":
            later = names[names.index(alone[f.name]) + 1:] if f.name in alone else []
            highest = F.when(F.col("l_key_type").isin(later), F.lit(f.disagree)).otherwise(F.lit(f.agree)) if later else F.lit(f.agree)
            out[f.name] = F.when(F.col("l_mask").bitwiseAND(F.col("r_mask")).bitwiseAND(1 << i) != 0, highest).otherwise(F.lit(0.0))
    return out


def _outermost(compared: DataFrame, spec: IdentitySpec, floor: float, self_join: bool) -> DataFrame:
    """Leave the rows of the smallest and of the largest id in pairs of bundles that reach the floor whatever their rows hold.

    If some pair of their rows has its smaller id on one side, so has a pair of these. One that belongs to an earlier place has
    the same texts there.
    """
    parts = [field_weight(f, F.col(f"gamma_{f.name}")) if f.comparator != "exact" else
             F.when(F.col("l_mask").bitwiseAND(F.col("r_mask")).bitwiseAND(1 << i) != 0, F.lit(f.disagree)).otherwise(F.lit(0.0))
             for i, f in enumerate(spec.fields)]
    sure = reduce(lambda a, b: a + b, parts) >= floor

    def ends(rows: Column) -> Column:
        # A row without an id is in no pair of a self join.
        named = F.filter(rows, lambda x: x["vid"].isNotNull()) if self_join else rows
        return F.when(sure, F.when(F.size(named) > 1, F.array(F.get(named, F.lit(0)), F.get(named, F.size(named) - 1))).otherwise(named)).otherwise(rows)

    return compared.withColumns({c: ends(F.col(c)) for c in ("l_rows", "r_rows")})


def _thinned(compared: DataFrame, spec: IdentitySpec) -> tuple[DataFrame, Column]:
    """Add a hub per side of two bundles, a row that shares no exact value with any row of the other one, and the condition on
    pairs of rows that are needed: those with a hub and those that are equal on an exact field.

    All pairs without an equal exact field have one comparison vector, and every row has such a pair with the hub of the other
    side. Without a hub on both sides, and within a bundle, all pairs are needed.
    """
    exact = [f.column for f in spec.fields if f.comparator == "exact"]

    def hub(rows: str, others: str) -> Column:
        def shares(x: Column) -> Column:
            return _any([F.coalesce(F.array_contains(F.transform(others, lambda y: y[c]), x[c]), F.lit(False)) for c in exact])
        return F.get(F.filter(rows, lambda x: x["vid"].isNotNull() & ~shares(x)), F.lit(0))["vid"]

    compared = compared.withColumns({"_l_hub": hub("l_rows", "r_rows"), "_r_hub": hub("r_rows", "l_rows")})
    whole = F.col("_itself") | F.col("_l_hub").isNull() | F.col("_r_hub").isNull()
    equal = _any([F.coalesce(F.col(f"l_{c}") == F.col(f"r_{c}"), F.lit(False)) for c in exact])
    return compared, whole | (F.col("l_vid") == F.col("_l_hub")) | (F.col("r_vid") == F.col("_r_hub")) | equal


def _pairs_of_bundles(met: DataFrame, columns: list[str], spec: IdentitySpec, floor: float, profile: str, self_join: bool,
                      texts: bool, thinned: bool) -> DataFrame:
    """Scored pairs of the rows of plausible pairs of bundles: `l_` and `r_` with each of `columns`, gammas, weight, confidence."""
    compared = compare_similar(met, spec)
    fuzzy = [f for f in spec.fields if f.comparator != "exact"]
    # Not before the similarities: the generated method of the join would be too large to be compiled.
    parts = _key_parts(spec, profile)
    before = {name: F.col("l_key_type").isin([later for later, _, _ in parts[k + 1:]]) for k, (name, _, _) in enumerate(parts[:-1])}
    exact = _highest_exact(spec, profile)
    highest = reduce(lambda a, b: a + b, [exact[f.name] if f.name in exact else field_weight(f, F.col(f"gamma_{f.name}")) for f in spec.fields])
    compared = compared.where((highest >= floor - 1e-9) & _on_first_path(spec, fuzzy) & ~_any(
        [before[name] & both for name, both, rows in parts if rows is None and name in before]))
    compared = compared.withColumns({
        # Earlier keys that two rows share if they are equal on the exact fields as well.
        **{f"_earlier_{k}": before[name] & both for k, (name, both, rows) in enumerate(parts) if rows is not None and name in before},
        "_itself": (F.col("l_side") == "B") & (F.col("l_mask") == F.col("r_mask")) & (F.col("l_part") == F.col("r_part"))
        & reduce(lambda a, b: a & b, [F.col("l_" + f.column).eqNullSafe(F.col("r_" + f.column)) for f in fuzzy], F.lit(True))})
    if texts:
        compared = _outermost(compared, spec, floor, self_join)
    needed = F.lit(True)
    if thinned:
        compared, needed = _thinned(compared, spec)
    spread = compared.withColumn("_l", F.explode("l_rows")).withColumn("_r", F.explode("r_rows"))
    packed = [c for c in columns if c not in ("side", "mask", *_bundled_fields(spec))]
    spread = spread.select(
        *[c for c in spread.columns if c not in ("_l", "_r", "l_rows", "r_rows")],
        *[F.col(f"_{p}")[c].alias(f"{p}_{c}") for p in "lr" for c in packed])
    rows = F.when(F.col("_itself"), F.col("l_vid") < F.col("r_vid")).otherwise((F.col("l_side") != "B") | (F.col("l_vid") != F.col("r_vid")))
    spread = spread.where(rows & needed).withColumns({f"gamma_{f.name}": known_gamma(f) for f in spec.fields if f.comparator == "exact"})
    others = [f for f in spec.fields if f.comparator == "exact"]
    spread = spread.where(_on_first_path(spec, others) & ~_any(
        [F.col(f"_earlier_{k}") & rows for k, (name, _, rows) in enumerate(parts) if rows is not None and name in before]))
    gammas = [f"gamma_{f.name}" for f in spec.fields]
    scored = score(spread.select(*[p + c for p in ("l_", "r_") for c in columns], *gammas), spec).where(F.col("weight") >= floor)
    return _oriented(scored, self_join, [*gammas, "weight", "confidence"])


def block_pairs(keyed: DataFrame, spec: IdentitySpec, profile: str = "batch", bundled: bool = False) -> DataFrame:
    """All pairs of the given blocks, each once: `l_*` and `r_*` columns. Of bundles all pairs, wherever their rows belong."""
    keys = ("key_type", "key_value")
    if bundled:
        met = _renamed(keyed, "l_", keys).hint("merge").join(_renamed(keyed, "r_", keys), list(keys))
        return met.where(_ordered_bundles(spec)).withColumnRenamed("key_type", "l_key_type").drop("key_value")
    # A shuffled join even on small input: the pairs are many more than the rows, and both sides reuse one exchange.
    joined = _renamed(keyed, "l_", keys).hint("merge").join(_renamed(keyed, "r_", keys), list(keys))
    return joined.where(_ordered() & (_first_shared_key(spec, profile) == F.col("key_type"))).drop(*keys)


def split_by_size(keyed: DataFrame, spec: IdentitySpec) -> tuple[DataFrame, DataFrame | None]:
    """Ordinary blocks, and the oversized ones if there are any."""
    keys = ["key_type", "key_value"]
    large = scratch_table(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("block_rows"))
                          .where(F.col("block_rows") > spec.block_limit), "large-blocks")
    if large.isEmpty():
        return keyed, None
    return keyed.join(large, keys, "left_anti"), keyed.join(large, keys)


def _lowest_weight(spec: IdentitySpec, agreed: int, present: int) -> float:
    return sum(f.agree if agreed >> i & 1 else min(f.agree, f.disagree)
               for i, f in enumerate(spec.fields) if present >> i & 1)


def _is_certain(spec: IdentitySpec, floor: float, agreed: Column, present: Column) -> Column:
    """True where pairs that agree on the fields `agreed`, with the fields `present` on both sides, reach the floor."""
    size = 1 << len(spec.fields)
    codes = [a * size + p for a, p in product(range(size), range(size))
             if a & p == a and _lowest_weight(spec, a, p) >= floor]
    return (agreed * size + present).isin(codes) if codes else F.lit(False)


def _certain_masks(spec: IdentitySpec, floor: float) -> Column:
    """The presence masks that a partner in the block of a row may have so that the pair is certain to reach the floor."""
    agreed, mask = F.col("agreed"), F.col("mask")
    return F.filter(F.sequence(F.lit(0), F.lit((1 << len(spec.fields)) - 1)), lambda other: (
        (other.bitwiseAND(agreed) == agreed) & _is_certain(spec, floor, agreed, mask.bitwiseAND(other))))


def _not_by_hubs() -> Column:
    """False for pairs that links to hubs replace: `l_by_hubs` lists masks. Long conditions per pair would not be compiled."""
    return ~F.coalesce(F.array_contains("l_by_hubs", F.col("r_mask")), F.lit(False))


def _elsewhere(spec: IdentitySpec, profile: str) -> Column:
    """True for sub-blocks whose rows are equal on all fields of an earlier key type: a listing makes their pairs there."""
    codes = list(agreed_fields(spec, profile).items())
    earlier = [(F.col("key_type") == name) & (F.col("equal").bitwiseAND(code) == code)
               for k, (name, _) in enumerate(codes) for _, code in codes[:k] if code]
    return reduce(lambda a, b: a | b, earlier, F.lit(False))


def _agreed(spec: IdentitySpec, profile: str) -> Column:
    """Fields that the rows of a block agree on, by its key type."""
    return F.create_map(*[F.lit(x) for kv in agreed_fields(spec, profile).items() for x in kv])[F.col("key_type")]


def _on_first_path(spec: IdentitySpec, fields: Sequence[ScoreField] | None = None) -> Column:
    """False for pairs that agree on a field (of `fields`) which their path of sub-blocks has passed over, as far as gammas are known."""
    skipped = [(F.col("l_last") > i) & (F.col("l_agreed").bitwiseAND(1 << i) == 0) & F.coalesce(F.col(f"gamma_{f.name}") == 1, F.lit(False))
               for i, f in enumerate(spec.fields) if fields is None or f in fields]
    return ~reduce(lambda a, b: a | b, skipped, F.lit(False))


def _certain(level: DataFrame, spec: IdentitySpec, floor: float, links: bool, masks: Sequence[int] | None = None) -> DataFrame:
    """Pairs of oversized blocks that reach the floor whatever else they hold: of hubs with rows, or without `links` of bundles.

    `masks` are the presence masks that occur, if known."""
    partners, per_slice = level, ROWS_PER_SLICE if links else LISTED_PER_SLICE
    if links:
        row = F.struct(*[c for c in level.columns if c not in ("block", "side", "mask")])
        hub = level.groupBy("block", "side", "mask").agg(F.min_by(row, F.col("vid")).alias("hub"))
        partners = hub.select("block", "side", "mask", "hub.*")
    slices = F.greatest(F.ceil(F.col("block_rows") / per_slice), F.lit(1)).cast("int")
    wanted = _certain_masks(spec, floor)
    if masks is not None:
        wanted = F.array_intersect(wanted, F.array(*[F.lit(m) for m in masks]).cast("array<int>"))
    partners = (partners.withColumn("partner_mask", F.explode(wanted))
                .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))))
    of = F.xxhash64("vid") if links else F.xxhash64("part", *_bundled_fields(spec))
    rows = (level.withColumn("partner_mask", F.col("mask"))
            .withColumn("slice", F.pmod(of, slices).cast("int")))
    keys = ("block", "slice", "partner_mask")
    if not links:
        return _met(_dealt(rows, *keys), _dealt(partners, *keys), keys, spec)
    across = _renamed(rows, "l_", keys).join(_renamed(partners, "r_", keys), list(keys)).drop(*keys)
    # A hub may stand on either side of a pair.
    return across.where((F.col("l_vid") != F.col("r_vid")) &
                        ((F.col("l_side") == "B") | (F.col("l_side") != F.col("r_side"))))


def _met(left: DataFrame, right: DataFrame, keys: tuple[str, ...], spec: IdentitySpec) -> DataFrame:
    """Pairs of bundles with equal `keys`."""
    return _renamed(left, "l_", keys).hint("merge").join(_renamed(right, "r_", keys), list(keys)).drop(*keys).where(_ordered_bundles(spec))


def _hub_links(keyed: DataFrame, spec: IdentitySpec, profile: str, floor: float, self_join: bool) -> tuple[DataFrame, DataFrame]:
    """Links to hubs in ordinary blocks above `HUB_ROWS`, and all rows, with `by_hubs` where such links replace pairs."""
    keys = ["key_type", "key_value"]
    sizes = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("block_rows"))
             .where((F.col("block_rows") > HUB_ROWS) & (F.col("block_rows") <= spec.block_limit)))
    sizes = scratch_table(sizes.withColumn("agreed", _agreed(spec, profile)), "hub-blocks")
    level = keyed.join(sizes, keys).withColumn("block", F.concat_ws(SEPARATOR, *keys))
    sides = [p + c for p in ("l_", "r_") for c in keyed.columns if c not in keys]
    links = _oriented(_certain(level, spec, floor, True).select(*sides), self_join)
    rows = keyed.join(sizes.drop("block_rows"), keys, "left")
    return links, rows.withColumn("by_hubs", F.when(F.col("agreed").isNotNull(), _certain_masks(spec, floor))).drop("agreed")


def _undecided(level: DataFrame, spec: IdentitySpec, floor: float) -> DataFrame:
    """Rows with at least one possible partner in their block for which the floor is not certain."""
    masks = level.groupBy("block").agg(F.collect_set("mask").alias("_masks"))
    agreed, mask = F.col("agreed"), F.col("mask")
    open_pair = F.exists("_masks", lambda other: ~_is_certain(spec, floor, agreed, mask.bitwiseAND(other)))
    return level.join(masks, "block").where(open_pair).drop("_masks")


def _sub_blocks(level: DataFrame, similar: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Split blocks by one further agreeing field; fields are taken in order, so a set of fields is met once."""
    values = [F.struct(F.lit(i).alias("index"), F.lit(1 << i).alias("bit"), F.lit(f.name).alias("field"),
                       F.col(f.column).alias("value")) for i, f in enumerate(spec.fields)]
    agreed, last = F.col("agreed"), F.col("last")
    usable = F.filter(F.array(*values), lambda v: v["value"].isNotNull() & (v["index"] > last)
                      & (agreed.bitwiseAND(v["bit"]) == 0))
    spread = level.drop("block_rows").withColumn("_next", F.explode(usable)).select("*", "_next.*").drop("_next")
    spread = spread.withColumns({"before": agreed, "agreed": agreed + F.col("bit"), "last": F.col("index")})
    by_equality = F.col("equal") + F.col("bit")

    def named(df: DataFrame, *parts: Column) -> DataFrame:
        return (df.withColumn("block", F.concat_ws(SEPARATOR, F.col("block"), F.col("field"), *parts))
                .drop("index", "bit", "field", "value", "other"))

    equal = named(spread.withColumn("equal", by_equality), F.col("value"))
    both_ways = (similar.select("field", F.col("v").alias("value"), F.col("w").alias("other"))
                 .unionByName(similar.select("field", F.col("w").alias("value"), F.col("v").alias("other"))))
    near = spread.join(both_ways, ["field", "value"])
    first = ((F.col("side") == "B") & (F.col("value") < F.col("other"))) | (F.col("side") == "L")
    near = near.withColumn("side", F.when(first, "L").otherwise("R"))
    # The block is named by the value of its L rows, then that of its R rows.
    is_left = F.col("side") == "L"
    near = named(near, F.lit("similar"), F.when(is_left, F.col("value")).otherwise(F.col("other")),
                 F.when(is_left, F.col("other")).otherwise(F.col("value")))
    return equal.unionByName(near.select(*equal.columns))


def _with_sizes(sub: DataFrame) -> DataFrame:
    """Add the block size and drop blocks without any pair."""
    def rows(side: str) -> Column:
        return F.count(F.when(F.col("side") == side, 1))

    sizes = sub.groupBy("block").agg(F.count(F.lit(1)).alias("block_rows"), rows("B").alias("b"),
                                     rows("L").alias("l"), rows("R").alias("r"))
    sizes = sizes.where((F.col("b") > 1) | ((F.col("l") > 0) & (F.col("r") > 0))).select("block", "block_rows")
    return sub.join(sizes, "block")


def similar_in(level: DataFrame, spec: IdentitySpec) -> DataFrame:
    """Similar values, per field compared by similarity, among the rows of oversized blocks."""
    found = []
    for threshold in sorted({f.threshold for f in spec.fields if f.comparator != "exact"}):
        values = [level.where(F.col(f.column).isNotNull())
                  .select(F.lit(f.name).alias("field"), F.col(f.column).alias("value")).distinct()
                  for f in spec.fields if f.comparator != "exact" and f.threshold == threshold]
        found.append(similar_values(reduce(DataFrame.unionByName, values), threshold))
    if not found:
        return level.sparkSession.createDataFrame([], "field string, v string, w string, similarity double")
    return scratch_table(reduce(DataFrame.unionByName, found), "similar-values")


def _refined(large: DataFrame, spec: IdentitySpec, profile: str, floor: float, links: bool,
             self_join: bool, once: bool, size: int = BUNDLE_ROWS) -> list[DataFrame]:
    """Pairs of oversized blocks that may reach the floor, similarities not yet computed; without `links` pairs of bundles.

    With `once` a pair is still there on every path of similar values; `_on_first_path` leaves one of them. Without, a shuffle
    over all pairs removes repeats.
    """
    agreed = _agreed(spec, profile)
    level = scratch_table(large.select(
        *[c for c in large.columns if c != "key_value"],
        F.concat_ws(SEPARATOR, "key_type", "key_value").alias("block"),
        agreed.alias("agreed"), agreed.alias("equal"),
        F.lit(0).alias("before"), F.lit(-1).alias("last")), "level")
    similar = similar_in(level, spec)
    # Pairs that were certain one step earlier have been found there.
    done = _is_certain(spec, floor, F.col("l_before"), F.col("l_mask").bitwiseAND(F.col("r_mask")))
    hubs = links and once
    by = ["block", "key_type", "agreed", "equal", "before", "last", "block_rows"]
    # At most 2^fields numbers.
    masks = None if links else sorted(r["mask"] for r in level.select("mask").distinct().collect())
    found = []
    for step in range(len(spec.fields) + 1):
        certain = _certain(level if links else _bundles(level, by, spec, False, size), spec, floor, links, masks)
        found.append(certain.where(~done) if once and step else certain)
        sub = _sub_blocks(_undecided(level, spec, floor), similar, spec)
        sub = scratch_table(_with_sizes(sub.where(~_elsewhere(spec, profile)) if once else sub), "level")
        small = sub.where(F.col("block_rows") <= spec.block_limit)
        if hubs:
            small = small.withColumn("by_hubs", F.when(F.col("block_rows") > HUB_ROWS, _certain_masks(spec, floor)))
        if links:
            pairs = _renamed(small, "l_", ("block",)).join(_renamed(small, "r_", ("block",)), "block").drop("block")
            found.append(pairs.where(_ordered() & ~done & _not_by_hubs() if hubs else _ordered() & ~done))
        else:
            small = _bundles(_dealt(small, "block"), by, spec, True, size)
            found.append(_met(small, small, ("block",), spec).where(~done))
        if hubs:
            found.append(_certain(sub.where((F.col("block_rows") > HUB_ROWS) & (F.col("block_rows") <= spec.block_limit)), spec, floor, links)
                         .where(~done))
        level = sub.where(F.col("block_rows") > spec.block_limit)
        if level.isEmpty():
            break
    if not links:
        return found
    passing = [c for c in large.columns if c not in ("key_type", "key_value", "block_rows")]
    passing += ["key_type", "agreed", "last"] if once else []
    columns = [p + c for p in ("l_", "r_") for c in passing]
    # Filtered before the similarities and before a shuffle that removes repeats: most pairs of a sub-block cannot reach
    # the floor.
    kept = reduce(DataFrame.unionByName, [plausible_pairs(df.select(*columns), spec, floor) for df in found])
    return [_oriented(kept, self_join) if once else _oriented(kept, self_join).dropDuplicates(["l_vid", "r_vid"])]


def listed_pairs(ordinary: DataFrame, large: DataFrame | None, spec: IdentitySpec, profile: str, floor: float, self_join: bool,
                 texts: bool = False, thinned: bool = False) -> DataFrame:
    """All pairs of the given blocks that reach the floor, each once, by pairs of bundles; see `scored_pairs` for `texts`, `thinned`."""
    bundles = _bundles(_dealt(ordinary, "key_type", "key_value"), ["key_type", "key_value"], spec, size=HUB_BUNDLE_ROWS if thinned else BUNDLE_ROWS)
    found = [block_pairs(bundles, spec, profile, True).withColumns({"l_agreed": F.lit(0), "l_last": F.lit(-1)})]
    if large is not None:
        found += _refined(large, spec, profile, floor, False, self_join, True, HUB_BUNDLE_ROWS if thinned else BUNDLE_ROWS)
    of_bundle = ["side", "mask", "part", *_bundled_fields(spec), "rows"]
    names = [p + c for p in ("l_", "r_") for c in of_bundle] + ["l_key_type", "l_agreed", "l_last"]
    known = _highest_exact(spec, profile)
    met = reduce(DataFrame.unionByName, [plausible_pairs(df.select(*names), spec, floor, known) for df in found])
    return _pairs_of_bundles(met, [c for c in ordinary.columns if c not in ("key_type", "key_value")], spec, floor, profile, self_join, texts, thinned)


def scored_pairs(left: DataFrame, spec: IdentitySpec, floor: float, right: DataFrame | None = None,
                 profile: str = "batch", links: bool = False, spanning: bool = False, texts: bool = False, thinned: bool = False) -> DataFrame:
    """Pairs that share a blocking key and weigh at least `floor`, with gammas, weight and confidence.

    `left` holds `vid`, `mask` and the normalised columns; further columns are carried along as `l_*` and `r_*`.
    With `right` the pairs go across the two tables. `links=True` keeps, in oversized blocks, only as many pairs as
    needed to connect what belongs together; `spanning=True` leaves still fewer of those, for callers that take only the
    groups from them and no weights. `texts=True` lists only as many pairs as show which texts compared by similarity meet in
    any pair, and on which side. `thinned=True` leaves pairs out where the rows that pairs of one comparison vector connect hang
    together without them, for callers that choose pairs by weight and take the groups.
    """
    links, once = links or spanning, spanning
    keyed = block_keys(left.withColumn("side", F.lit("B" if right is None else "L")), spec, profile)
    if right is not None:
        # Only blocks that the left table touches matter; this is what bounds the work on a large right table.
        wanted = keyed.select("key_type", "key_value").distinct()
        other = block_keys(right.withColumn("side", F.lit("R")), spec, profile)
        keyed = keyed.unionByName(other.join(wanted, ["key_type", "key_value"], "left_semi"),
                                  allowMissingColumns=True)
    ordinary, large = split_by_size(keyed, spec)
    if not links:
        return (listed_pairs(ordinary, large, spec, profile, floor, right is None, texts, thinned)
                .withColumnRenamed("l_vid", "left_id").withColumnRenamed("r_vid", "right_id"))
    if spanning and spec.block_limit > HUB_ROWS:
        hub_links, rows = _hub_links(ordinary, spec, profile, floor, right is None)
        pairs = block_pairs(rows, spec, profile).where(_not_by_hubs()).select(*hub_links.columns).unionByName(hub_links)
    else:
        pairs = block_pairs(ordinary, spec, profile)
    out = score(compare_pairs(pairs, spec, floor), spec)
    if large is not None:
        refined = compare_similar(_refined(large, spec, profile, floor, links, right is None, once)[0], spec)
        if once:
            # Not before the similarities: the generated method of the join would be too large to be compiled.
            refined = refined.where((_first_shared_key(spec, profile) == F.col("l_key_type")) & _on_first_path(spec))
        refined = score(refined, spec)
        out = out.unionByName(refined.select(*out.columns))
        if not once:
            # A pair of a later ordinary block may have come up again in the refinement.
            out = out.dropDuplicates(["l_vid", "r_vid"])
    return (out.where(F.col("weight") >= floor)
            .withColumnRenamed("l_vid", "left_id").withColumnRenamed("r_vid", "right_id"))
