"""Connected components, entity ids and manual overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.sources.scratch import scratch_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the smallest node among its neighbours and itself."""
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (around.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # One row per node and no sort of the edges: they may be many more than the nodes.
    moved = edges.join(least.hint("shuffle_hash"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where(F.col("a") > F.col("b")).unionByName(least.withColumnRenamed("m", "b")).distinct()


def _unfinished(edges: DataFrame) -> bool:
    """True while some node has two parents, or is a parent and a child at once."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    counts = roles.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return not counts.where((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("parent") > 0))).isEmpty()


def connected_components(vertices: DataFrame, edges: DataFrame, vertex: str = "rec_id") -> DataFrame:
    """`vertex`, `component`: the smallest vertex connected with it. `edges` has `left_id`, `right_id`.

    Alternates large and small star (Kiveris et al., 2014) until every component is a star. Minima are aggregated
    before the shuffle, and the join back has one row per node on one side, so a node with very many neighbours only
    makes the other side long. Each round is written out: plans stay short, and a lost executor costs one round at most.
    """
    low, high = F.least("left_id", "right_id"), F.greatest("left_id", "right_id")
    edges = scratch_table(edges.select(high.alias("a"), low.alias("b")).where(F.col("a") > F.col("b")), "edges")
    # The first round leaves about as many edges as nodes, however dense the graph, so it is the only one over all edges.
    stars = scratch_table(_small_star(edges), "stars")
    while _unfinished(stars):
        stars = scratch_table(_small_star(_large_star(stars)), "stars")
    return (vertices.select(vertex).join(stars.withColumnRenamed("a", vertex), vertex, "left")
            .select(vertex, F.coalesce("b", vertex).alias("component")))


# Weight of a link that a person has set.
MANUAL = 1e9


def _part_of(nodes: DataFrame, around: DataFrame, anchors: DataFrame) -> DataFrame:
    """`node`, `label`: every node gets the label of the anchor that reaches it over the strongest links, link by link."""
    labels = scratch_table(anchors, "labels")
    while True:
        reached = (around.join(labels, "node").join(labels.select(F.col("node").alias("other")), "other", "left_anti")
                   .groupBy(F.col("other").alias("node"))
                   .agg(F.min(F.struct((-F.col("weight")).alias("w"), "label")).getField("label").alias("label")))
        reached = scratch_table(reached, "reached")
        if reached.isEmpty():
            return nodes.join(labels, "node").select("node", "label")
        labels = scratch_table(labels.unionByName(reached), "labels")


def separated_components(vertices: DataFrame, edges: DataFrame, splits: DataFrame, vertex: str = "rec_id") -> DataFrame:
    """Like `connected_components`, but the two ends of every split (`left_id`, `right_id`) end up in different components.

    `edges` has a `weight`. A component that holds both ends is divided between them: every other vertex follows the end
    that it hangs on by the stronger links. One split per component is taken at a time until none is broken, so splits
    that one division settles cost nothing more. Components without a broken split stay as they are.
    """
    pair = (F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id"))
    splits = scratch_table(splits.where(F.col("left_id") != F.col("right_id")).select(*pair).distinct(), "splits")
    edges = scratch_table(edges.select(*pair, "weight").groupBy("left_id", "right_id").agg(F.max("weight").alias("weight"))
                          .join(splits, ["left_id", "right_id"], "left_anti"), "weighted-edges")
    parts = scratch_table(connected_components(vertices, edges, vertex), "components")
    while True:
        ends = [parts.select(F.col(vertex).alias(c), F.col("component").alias(c[:-3])) for c in ("left_id", "right_id")]
        broken = splits.join(ends[0], "left_id").join(ends[1], "right_id").where(F.col("left") == F.col("right"))
        first = scratch_table(broken.groupBy(F.col("left").alias("component")).agg(
            F.min(F.struct("left_id", "right_id")).alias("split")), "broken-splits")
        if first.isEmpty():
            return parts
        torn = parts.join(first.select("component"), "component", "left_semi").select(F.col(vertex).alias("node"), "component")
        torn = scratch_table(torn, "torn")
        around = (edges.join(torn.select(F.col("node").alias("left_id"), F.col("component").alias("l")), "left_id")
                  .join(torn.select(F.col("node").alias("right_id"), F.col("component").alias("r")), "right_id")
                  .where(F.col("l") == F.col("r")))
        around = scratch_table(around.select(F.col("left_id").alias("node"), F.col("right_id").alias("other"), "weight").unionByName(
            around.select(F.col("right_id").alias("node"), F.col("left_id").alias("other"), "weight")), "torn-edges")
        anchors = first.select(F.explode(F.array("split.left_id", "split.right_id")).alias("node")).withColumn("label", F.col("node"))
        divided = _part_of(torn.select("node"), around, anchors)
        names = divided.groupBy("label").agg(F.min("node").alias("component"))
        divided = divided.join(names, "label").select(F.col("node").alias(vertex), "component")
        parts = scratch_table(parts.join(first.select("component"), "component", "left_anti").select(vertex, "component")
                              .unionByName(divided), "components")


def entity_id(member: Column) -> Column:
    return F.sha2(member, 256)


def entity_ids(components: DataFrame) -> DataFrame:
    """Add the entity id: the hash of the smallest member key."""
    return components.withColumn("entity_id", entity_id(F.col("component")))


def apply_overrides(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Edges after manual decisions (`kind`, `left_id`, `right_id`): `merge` adds an edge, `split` removes it.

    A pair that is both merged and split stays split. Components are computed from the result.
    """
    pair = (F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id"))
    merges = overrides.where(F.col("kind") == "merge").select(*pair)
    splits = overrides.where(F.col("kind") == "split").select(*pair).distinct()
    return (edges.select(*pair).unionByName(merges).distinct()
            .join(splits, ["left_id", "right_id"], "left_anti"))
