"""Operators over node, edge and closure DataFrames, for sets of anchors at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.session import cut, scratch


def subtree(links: DataFrame, nodes: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, key, depth, page, rid, ord): descendants of each anchor in order of depth, page and document."""
    rows = links.join(anchors.select(F.col("key").alias("ancestor")), "ancestor", "left_semi").select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("key"), "depth")
    rows = rows.join(nodes.select("key", "page", "rid"), "key")
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("anchor").orderBy("depth", "page", "rid"))).select("anchor", "key", "depth", "page", "rid", "ord")


def nearest_of_type(links: DataFrame, nodes: DataFrame, types: Sequence[str]) -> DataFrame:
    """(key, owner): the nearest ancestor, self included, of one of the types; nodes without one have no row."""
    owners = nodes.where(F.col("node_type").isin(*types)).select(F.col("key").alias("ancestor"))
    near = links.join(owners, "ancestor").groupBy("descendant").agg(F.min(F.struct("depth", "ancestor")).alias("m"))
    return near.select(F.col("descendant").alias("key"), F.col("m.ancestor").alias("owner"))


def dependencies(links: DataFrame, edges: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, dst) once each: what the subtree of an anchor refers to, outside of itself."""
    scope = links.join(anchors.select(F.col("key").alias("ancestor")), "ancestor", "left_semi").select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("src"))
    out = scope.join(edges.where("dst is not null").select("src", "dst").distinct(), "src").select("anchor", "dst").distinct()
    return out.join(links.select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("dst")), ["anchor", "dst"], "left_anti")


def k_hop(links: DataFrame, edges: DataFrame, anchors: DataFrame, hops: int, hubs: DataFrame | None = None) -> DataFrame:
    """(anchor, key, hop): nodes reached from the subtree of each anchor in at most `hops` steps, at their first hop.

    The visited set begins with the whole subtree; a hub is reached but not expanded. Each hop is one join and one
    anti-join; each hop is added to one folder of the shared folder, so the plan doesn't grow with the hops.
    """
    spark, schema = links.sparkSession, "anchor string, key string, hop int"
    folder = scratch(spark, "hops")
    steps = edges.where("dst is not null").select("src", "dst").distinct()
    start = links.join(anchors.select(F.col("key").alias("ancestor")), "ancestor", "left_semi").select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("key"), F.lit(0).alias("hop"))
    start.write.parquet(f"{folder}/n=0")
    for hop in range(1, hops + 1):
        frontier = spark.read.schema(schema).parquet(f"{folder}/n={hop - 1}")
        seen = spark.read.schema(schema).parquet(folder)
        open_ = frontier if hubs is None else frontier.join(hubs.select("key"), "key", "left_anti")
        reached = open_.select("anchor", F.col("key").alias("src")).join(steps, "src").select("anchor", F.col("dst").alias("key")).distinct()
        reached.join(seen.select("anchor", "key"), ["anchor", "key"], "left_anti").withColumn("hop", F.lit(hop)).write.parquet(f"{folder}/n={hop}")
    return spark.read.schema(schema).parquet(folder).where("hop > 0").select("anchor", "key", "hop")


def leaf_chain(links: DataFrame, nodes: DataFrame, marked: DataFrame, leaf_types: Sequence[str]) -> DataFrame:
    """(key, source): marked nodes and those above them that are reached through an unbroken chain of leaf types."""
    up = links.join(marked.select(F.col("key").alias("descendant")), "descendant", "left_semi").join(nodes.select(F.col("key").alias("ancestor"), "node_type"), "ancestor")
    ok = (F.col("depth") == 0) | F.col("node_type").isin(*leaf_types)
    run = F.min(F.when(ok, 1).otherwise(0)).over(Window.partitionBy("descendant").orderBy("depth", "ancestor").rowsBetween(Window.unboundedPreceding, 0))
    return up.withColumn("whole", run).where("whole = 1").select(F.col("ancestor").alias("key"), F.col("descendant").alias("source"))


def longest_paths(tracks: DataFrame, steps: DataFrame) -> DataFrame:
    """(key, weeks): the longest sum of weeks of a path of the DAG that ends at each track.

    tracks: (key, weeks); steps: (src, dst). Relaxes one edge a round until nothing changes; steps that run in a loop raise ValueError.
    """
    steps = cut(steps.select("src", "dst"))
    state = cut(tracks.select("key", "weeks", F.col("weeks").alias("total")))
    rounds = state.count()
    for _ in range(rounds + 1):
        best = steps.join(state.select(F.col("key").alias("src"), "total"), "src").groupBy(F.col("dst").alias("key")).agg(F.max("total").alias("before"))
        new = cut(state.join(best, "key", "left").select("key", "weeks", (F.col("weeks") + F.coalesce("before", F.lit(0))).alias("new"), "total"))
        if new.where("new <> total").isEmpty():
            return state.select("key", F.col("total").alias("weeks"))
        state = new.select("key", "weeks", F.col("new").alias("total"))
    raise ValueError("the steps run in a loop, so no path is the longest")


def within_budget(lines: DataFrame, group: str, order: Sequence[str], budget: int, always: int, priority: str = "priority") -> DataFrame:
    """Rows of each group that stay when the last in order are dropped until the sizes fit the budget.

    Rows with a `priority` up to `always` stay in any case but count. Closed form of dropping one after the other.
    Each row has a size of at least 1, so no more than `budget` rows of one priority can stay: the rest is left out
    before a group comes together in one task (up to 1,000 the planner does so before the shuffle).
    """
    nth = F.row_number().over(Window.partitionBy(group, priority).orderBy(*order))
    few = lines.where(F.col(priority) > always).withColumn("_nth", nth).where(F.col("_nth") <= budget).drop("_nth")
    lines = lines.where(F.col(priority) <= always).unionByName(few)
    running = F.sum("size").over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("running", running).where((F.col("running") <= budget) | (F.col(priority) <= always))
