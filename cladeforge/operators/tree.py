"""The classification tree: closure of ancestors and what is read off it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.sources.scratch import kept, written

#: Levels of the tree.
LEVELS = {1: "root", 2: "cl", 3: "cf", 4: "sf", 5: "fa", 6: "dm", 7: "sp", 8: "px"}
MAX_DEPTH = 7


def closure(nodes: DataFrame) -> DataFrame:
    """node_id, ancestor_id, ancestor_level, depth of every node and its ancestors; depth 0 is the node itself.

    The tree has eight levels at most, so seven joins with the (id, parent, level) columns reach every root.
    """
    up = written(nodes.select(F.col("id").alias("ancestor_id"), F.col("parent_node_id").alias("next"), F.col("level_id").alias("ancestor_level")))
    step = up.select(F.col("ancestor_id").alias("node_id"), "ancestor_id", "ancestor_level", "next", F.lit(0).alias("depth"))
    out = step
    for depth in range(1, MAX_DEPTH + 1):
        step = step.filter("next is not null").select("node_id", F.col("next").alias("ancestor_id")).join(up, "ancestor_id").select("node_id", "ancestor_id", "ancestor_level", "next", F.lit(depth).alias("depth"))
        out = out.union(step)
    return out.drop("next")


def ancestor_at(ids: DataFrame, closed: DataFrame, level: int) -> DataFrame:
    """node_id, ancestor_id: the ancestor of each id on a level, 0 if it has none."""
    at = closed.filter(F.col("ancestor_level") == level).select("node_id", "ancestor_id")
    return ids.join(at, "node_id", "left").select("node_id", F.coalesce("ancestor_id", F.lit(0)).alias("ancestor_id"))


def wide_lineage(closed: DataFrame, nodes: DataFrame, level: int = 8) -> DataFrame:
    """One row for each node of a level: node_id and its ancestors cl, cf, sf, fa, dm, sp (null where missing)."""
    leaves = nodes.filter(F.col("level_id") == level).select(F.col("id").alias("node_id"))
    levels = {k: v for k, v in LEVELS.items() if 2 <= k < level}
    return closed.join(leaves, "node_id", "left_semi").groupBy("node_id").pivot("ancestor_level", list(levels)).agg(F.min("ancestor_id")).toDF("node_id", *levels.values())


def descendants(ids: DataFrame, closed: DataFrame, nodes: DataFrame, level: int | None = None) -> DataFrame:
    """ancestor_id, node_id: what lies below each id, on one level or on all."""
    below = closed.filter("depth > 0").join(ids.select(F.col("node_id").alias("ancestor_id")), "ancestor_id", "left_semi")
    if level is not None:
        below = below.join(nodes.filter(F.col("level_id") == level).select(F.col("id").alias("node_id")), "node_id", "left_semi")
    return below.select("ancestor_id", "node_id")


def is_ancestor(pairs: DataFrame, closed: DataFrame) -> DataFrame:
    """Pairs (ancestor_id, node_id) with whether the first stands above the second."""
    known = closed.filter("depth > 0").select("ancestor_id", "node_id", F.lit(True).alias("above"))
    return pairs.join(known, ["ancestor_id", "node_id"], "left").withColumn("above", F.coalesce("above", F.lit(False)))


def relationship(pairs: DataFrame, closed: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with their deepest shared level (0 if none) and what it makes them."""
    above = closed.filter("depth > 0").select("node_id", "ancestor_id", "ancestor_level")
    shared = (
        pairs.join(above.withColumnRenamed("node_id", "a"), "a")
        .join(above.select(F.col("node_id").alias("b"), "ancestor_id"), ["b", "ancestor_id"])
        .groupBy("a", "b")
        .agg(F.max("ancestor_level").alias("shared_level"))
    )
    level = F.coalesce("shared_level", F.lit(0))
    names = F.when(level >= 5, "shared_family").when(level == 4, "shared_superfamily").when(level == 3, "shared_fold_only").when(level == 2, "shared_class_only").otherwise("none")
    return pairs.join(shared, ["a", "b"], "left").select("a", "b", level.alias("shared_level"), names.alias("relationship"))


def lineage_history(closed: DataFrame) -> DataFrame:
    """Levels at which a stable identifier's ancestor changed over releases; being absent counts as a value.

    closed: identifier, release_id, ancestor_level, ancestor_sunid over all releases.
    """
    releases = closed.select("identifier", "release_id").distinct().groupBy("identifier").agg(F.count("*").alias("releases"))
    levels = closed.groupBy("identifier", "ancestor_level").agg(F.count_distinct("ancestor_sunid").alias("kinds"), F.count_distinct("release_id").alias("present"))
    values = F.col("kinds") + F.when(F.col("present") < F.col("releases"), 1).otherwise(0)
    return levels.join(releases, "identifier").withColumn("values", values).filter("values > 1").select("identifier", "ancestor_level", "values")


#: Stands for the parent of roots.
NOWHERE = -(1 << 62)


def tree_order(nodes: DataFrame, scores: DataFrame) -> DataFrame:
    """id, new_id: numbers in depth-first order.

    Children stand by class string (class), number in it (fold to family), upper-case text (protein, species), and score
    then name (domain); "automated matches" come last. A node whose parent isn't there is a root.

    Level by level from below, subtrees are counted; then all nodes are dealt by parent and order, and running sums over the ranges say how many
    nodes stand before one under its parent; level by level from above, a node's number is its parent's and one more, and those. Each
    level takes part once each way, and a node with any number of children is as many tasks as its children fill.
    """
    known = nodes.select(F.col("parent_node_id").alias("up")).distinct().join(nodes.select(F.col("id").alias("up")), "up", "left_semi")
    own = nodes.join(scores, "id", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).join(known, F.col("parent_node_id") == F.col("up"), "left")
    last = F.when(F.col("description") == "automated matches", 1).otherwise(0)
    number = F.element_at(F.split("sccs", r"\."), -1).cast("int")
    key = [
        last.alias("last"),
        F.when(F.col("level_id").between(3, 5), number).otherwise(0).alias("number"),
        F.when(F.col("level_id") == 8, -F.col("score")).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("level_id") == 2, F.col("sccs")).when(F.col("level_id") == 8, F.coalesce("sid", F.lit(""))).when(F.col("level_id") > 5, F.upper("description")).otherwise("").alias("text"),
        F.col("id"),
    ]
    order = ["up", "last", "number", "score", "text", "id"]
    rows = written(own.select(F.coalesce("up", F.lit(NOWHERE)).alias("up"), "level_id", *key))
    levels = [r[0] for r in rows.select("level_id").distinct().orderBy("level_id").collect()]  # eight at most
    sized: list[DataFrame] = []
    below = rows.select(F.col("up").alias("id"), F.lit(0).cast("long").alias("below")).limit(0)
    for level in reversed(levels):
        at = written(rows.filter(F.col("level_id") == level).join(below, "id", "left").withColumn("size", 1 + F.coalesce("below", F.lit(0))).drop("below"))
        sized.append(at)
        below = below.union(at.groupBy("up").agg(F.sum("size"))).groupBy("id").agg(F.sum("below").alias("below"))
    dealt = written(reduce(DataFrame.unionByName, sized).repartitionByRange(*order).withColumn("part", F.spark_partition_id())) if sized else rows.select("*", F.lit(1).alias("size"), F.lit(0).alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = dealt.groupBy("part").agg(F.sum("size").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(F.broadcast(offsets), "part").select("id", "up", "level_id", (F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("all_before"))
    places = written(placed)
    least = places.groupBy("up").agg(F.min("all_before").alias("least"))
    done = rows.sparkSession.createDataFrame([(NOWHERE, 0)], "up long, above long")
    out = None
    for level in levels:
        at = places.filter(F.col("level_id") == level).join(least, "up").join(done, "up").select("id", (F.col("above") + 1 + F.col("all_before") - F.col("least")).alias("new_id"))
        out = at if level == levels[-1] else written(at)
        done = done.union(out)
    return done.filter(F.col("up") != NOWHERE).toDF("id", "new_id")


def numbered(rows: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """rows with dense numbers in an order that must be total: ranks within ranges, plus the sizes of the ranges before."""
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn("__rank", rank).join(offsets, "__part").withColumn(name, F.col("offset") + F.col("__rank") + (start - 1)).drop("__part", "__rank", "offset")


def leafless_nodes(nodes: DataFrame, leaf_level: int = 8) -> DataFrame:
    """Nodes above the leaves without a child."""
    parents = nodes.select(F.col("parent_node_id").alias("id")).distinct()
    return nodes.filter(F.col("level_id") < leaf_level).join(parents, "id", "left_anti")


def duplicate_siblings(nodes: DataFrame) -> DataFrame:
    """parent_node_id, level_id, description, n of siblings with one text."""
    return nodes.groupBy("parent_node_id", "level_id", "description").agg(F.count("*").alias("n")).filter("n > 1")


def automatch_closure(matches: DataFrame, seeds: DataFrame) -> DataFrame:
    """sid of all that was matched to the seeds directly or over others.

    matches: sid, target (read off the comment). Each round follows the newly found only, without those seen, so a cycle ends.
    """
    edges = matches.select("sid", "target").distinct()
    seen = frontier = kept(seeds.select("sid").distinct())
    while True:
        frontier = kept(edges.join(frontier.withColumnRenamed("sid", "target"), "target").select("sid").distinct().join(seen, "sid", "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
    return seen.join(seeds.select("sid"), "sid", "left_anti")
