"""Parent-child links to full hierarchies by pointer doubling."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key
from lexigrove.session import exists, scratch


class _Rounds:
    """The state of the nodes over the rounds: each round's folder has the nodes it settled and those still open."""

    STATE = "key string, ptr string, path array<string>, fault string"

    def __init__(self, spark: SparkSession, first: DataFrame):
        self.spark, self.folder, self.n = spark, scratch(spark, "hierarchy"), -1
        observed = Observation()
        self.add(first.observe(observed, F.count(F.lit(1)).alias("n")))
        self.rows = observed.get["n"]

    def add(self, state: DataFrame) -> None:
        self.n += 1
        state.withColumn("settled", F.col("ptr").isNull() | F.col("fault").isNotNull()).write.partitionBy("settled").parquet(f"{self.folder}/{self.n}")

    def _read(self, rounds: Iterable[int], settled: bool) -> DataFrame:
        # A folder is missing where a round left no such node.
        paths = [p for n in rounds if exists(self.spark, p := f"{self.folder}/{n}/settled={str(settled).lower()}")]
        return self.spark.read.schema(self.STATE).parquet(*paths) if paths else self.spark.createDataFrame([], self.STATE)

    def open(self) -> DataFrame:
        return self._read([self.n], False)

    def all(self) -> DataFrame:
        return self._read(range(self.n + 1), True).unionByName(self.open())


def hierarchy(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """Path, depth and root of every node of a forest of unknown height; loops are detected.

    Returns one row per node key: `key`, `path` (its ancestors, nearest first), `depth`, `root`,
    `state` ('tree', 'cycle' for a node on a loop, 'below' for a node under a loop), and `labels`
    (each spelling in which the node table prints the id). For 'cycle' and 'below' depth and root are null
    and path is null.

    Method: each node points at its parent; a round joins the pointers to themselves, doubling the jump and
    concatenating the path segments, so a tree of height h takes log2(h) rounds. Only nodes with an open pointer
    take part in the join. A node that meets itself on its own path is on a loop; a node whose path meets a loop is
    below it; what is still open after log2(n) rounds can only be such a node.

    Scale: a round moves the open nodes only and writes each settled one once; the spellings of the ids stay out of the rounds and
    are joined at the end. The pointer side of each join holds one row per key, so a parent
    with very many children only skews the probe side, which adaptive execution splits. The rounds' tables stand in the shared folder.

    Defined cases: ids compare without outer white space and case; null or blank ids give no row; a null, blank or
    unknown parent makes a root; repeated rows count once; an id with several different parents keeps the smallest
    parent key that exists; an empty table gives no rows; columns other than the two are ignored.
    """
    base = nodes.select(F.col(id_col).alias("label"), id_key(F.col(id_col)).alias("key"), id_key(F.col(parent_col)).alias("up")).where("key is not null")
    named = base.groupBy("key").agg(F.collect_set("label").alias("labels"))
    links = base.where("up is not null").select("key", "up").distinct()
    known = named.select(F.col("key").alias("up"))
    parent = links.join(known, "up", "left_semi").groupBy("key").agg(F.min("up").alias("up"))
    first = named.select("key").join(parent, "key", "left").select(
        "key", F.col("up").alias("ptr"), F.when(F.col("up").isNull(), F.array().cast("array<string>")).otherwise(F.array("up")).alias("path"), F.when(F.col("up") == F.col("key"), "cycle").alias("fault")
    )
    rounds = _Rounds(nodes.sparkSession, first)
    for _ in range(max(1, math.ceil(math.log2(rounds.rows + 1)) + 1) if rounds.rows else 0):
        if rounds.open().isEmpty():
            break
        jump = rounds.all().select(F.col("key").alias("ptr"), F.col("ptr").alias("next"), F.col("path").alias("tail"), F.col("fault").alias("above"))
        joined = rounds.open().join(jump, "ptr", "inner")
        path = F.concat("path", "tail")
        # A path is cut where it meets the node again, so it never grows along a loop.
        on_loop = F.array_contains(path, F.col("key"))
        meets = F.size(F.array_distinct(path)) < F.size(path)
        rounds.add(
            joined.select(
                "key",
                F.when(F.col("above").isNull(), F.col("next")).alias("ptr"),
                F.when(on_loop, F.slice(path, 1, F.array_position(path, F.col("key")).cast("int"))).when(F.col("above").isNotNull() | meets, F.array().cast("array<string>")).otherwise(path).alias("path"),
                F.when(on_loop, "cycle").when(F.col("above").isNotNull() | meets, "below").alias("fault"),
            )
        )
    state = rounds.all().join(named, "key")
    fault = F.coalesce(F.col("fault"), F.when(F.col("ptr").isNotNull(), "below"))
    in_tree = fault.isNull()
    return state.select(
        "key",
        F.when(in_tree, F.col("path")).alias("path"),
        F.when(in_tree, F.size("path")).alias("depth"),
        F.when(in_tree, F.coalesce(F.try_element_at("path", F.lit(-1)), F.col("key"))).alias("root"),
        F.coalesce(fault, F.lit("tree")).alias("state"),
        "labels",
    )


def closure_pairs(forest: DataFrame) -> DataFrame:
    """All (ancestor, descendant, depth) keys of the tree nodes of `hierarchy`, each node its own ancestor at depth 0."""
    chain = F.concat(F.array("key"), F.col("path"))
    return forest.where("state = 'tree'").select(F.posexplode(chain).alias("depth", "ancestor"), F.col("key").alias("descendant")).select("ancestor", "descendant", "depth")


def closure_faults(nodes: DataFrame, closure: DataFrame) -> DataFrame:
    """Faults of a stored closure against the true one: (fault, ancestor, descendant), keys as in `hierarchy`.

    'cycle' for nodes on a loop; for descendants neither on nor below a loop 'missing' (a true pair not stored),
    'extra' (a stored pair that is not true, also with unknown names), 'depth' (a true pair stored with another
    depth; null counts as another). A pair stored several times with a right and a wrong depth is a 'depth' fault.
    Null or blank names in the closure give no row. Ids are written as the node table spells them (the smallest
    of several spellings), else as the closure does.
    """
    forest = hierarchy(nodes)
    spelled = forest.select("key", F.array_min("labels").alias("label"), "state")
    stored = (
        closure.select(id_key("ancestor").alias("ancestor"), id_key("descendant").alias("descendant"), F.col("depth").alias("stored_depth"), F.col("ancestor").alias("a_text"), F.col("descendant").alias("d_text"))
        .where("ancestor is not null and descendant is not null")
        .groupBy("ancestor", "descendant")
        .agg(F.min("a_text").alias("a_text"), F.min("d_text").alias("d_text"), F.min(F.coalesce("stored_depth", F.lit(-1))).alias("lo"), F.max(F.coalesce("stored_depth", F.lit(-1))).alias("hi"))
    )
    true = closure_pairs(forest)
    both = true.join(stored, ["ancestor", "descendant"], "full")
    faults = both.select(
        F.when(F.col("lo").isNull(), "missing").when(F.col("depth").isNull(), "extra").when((F.col("lo") != F.col("depth")) | (F.col("hi") != F.col("depth")), "depth").alias("fault"), "ancestor", "descendant", "a_text", "d_text"
    ).where("fault is not null")
    a, d = spelled.select(F.col("key").alias("ancestor"), F.col("label").alias("a_label")), spelled.select(F.col("key").alias("descendant"), F.col("label").alias("d_label"), "state")
    named = faults.join(a, "ancestor", "left").join(d, "descendant", "left")
    wrong = named.where(F.coalesce(F.col("state"), F.lit("tree")) == "tree").select("fault", F.coalesce("a_label", "a_text").alias("ancestor"), F.coalesce("d_label", "d_text").alias("descendant"))
    loops = spelled.where("state = 'cycle'").select(F.lit("cycle").alias("fault"), F.col("label").alias("ancestor"), F.col("label").alias("descendant"))
    return wrong.unionByName(loops)
