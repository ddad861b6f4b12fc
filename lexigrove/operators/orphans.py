"""References to records that do not exist: direct orphans in time and the cascade below them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexigrove.functions.ids import id_key
from lexigrove.session import remove, scratch


@dataclass(frozen=True)
class ForeignKey:
    """One reference from `child`.`field` to the ids of `parent`.

    record: column of the child that names its row in the result. at: column with the time at which the reference
    must hold, or None where it is enough that the parent has ever existed. where: SQL condition on the child for this key to apply. blank_is_orphan: whether a null or blank
    reference counts as orphan. child_id: the id column by which other tables refer to the child (None: nobody does).
    """

    child: str
    field: str
    parent: str
    record: str
    at: str | None
    where: str = "true"
    blank_is_orphan: bool = False
    child_id: str | None = None


def lives(df: DataFrame, id_col: str = "id", born: str = "loaded_at", died: str = "deleted_at") -> DataFrame:
    """(key, born, died) of each state of each record, without repeated rows."""
    return df.select(id_key(id_col).alias("key"), F.col(born).alias("born"), F.col(died).alias("died")).where("key is not null and born is not null").distinct()


def _ends(df: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """One row per reference end of the keys of one child table, from a single pass over it."""

    def end(k: ForeignKey) -> Column:
        return F.when(
            F.coalesce(F.expr(k.where), F.lit(False)),
            F.struct(F.lit(k.child).alias("table"), F.col(k.record).cast("string").alias("record"), F.lit(k.field).alias("field"), F.lit(k.parent).alias("parent"), id_key(k.field).alias("key"), (F.col(k.at) if k.at else F.lit(None).cast("timestamp")).alias("at"), F.lit(k.at is None).alias("ever"), F.lit(k.blank_is_orphan).alias("blank"), (id_key(k.child_id) if k.child_id else F.lit(None).cast("string")).alias("own")),
        )

    return df.select(F.explode(F.array_compact(F.array(*[end(k) for k in keys]))).alias("e")).select("e.*").where("key is not null or blank")


def _uncovered(ends: DataFrame, alive: DataFrame) -> DataFrame:
    """The ends that no life of their parent covers at their time."""
    a, e = alive.alias("a"), ends.alias("e")
    in_time = (F.col("a.born") <= F.col("e.at")) & (F.col("a.died").isNull() | (F.col("a.died") > F.col("e.at")))
    there = (F.col("e.parent") == F.col("a.parent")) & (F.col("e.key") == F.col("a.key")) & (F.col("e.ever") | in_time)
    return e.join(a, there, "left_anti")


class _Cascade:
    """The fixpoint over the tables that are referred to by others, held as parquet in one folder of the shared folder.

    `levels` has the orphan ends, `keys` the ids by which their records are referred to, each once, with the round that reaches
    them: the fewest steps up to a direct orphan. An id (table and key) is a source if one of its own ends is a direct orphan. Of
    the others those whose ends name one parent only jump up, twice as far each round, until they stand on a source or on an id of several
    parents; the jump of an id that comes to neither ends in nothing and leaves the rounds. So a chain takes log2 of its length in rounds. Ids of
    several parents are few; over them and the jumps between them alone, shorter ways are sought step by step until there are none.
    """

    LEVEL = "`table` string, record string, field string, parent string, key string, at timestamp, how string, round int, own string"
    KEYS = "parent string, key string, from_round int"
    IDS = "`table` string, own string, parent string, key string"
    JUMPS = f"{IDS}, steps int, n int, stop string"

    def __init__(self, ends: DataFrame, alive: DataFrame, max_rounds: int):
        self.spark, self.max_rounds = ends.sparkSession, max_rounds
        self.folder = scratch(self.spark, "orphans")
        ends = self._keep("ends", ends)
        direct = self._add(_uncovered(ends, alive), "direct", F.lit(0))
        own = direct.where("own is not null").select(F.col("table").alias("parent"), F.col("own").alias("key")).distinct()
        sources = self._keep("keys/of=sources", own.withColumn("from_round", F.lit(0)))
        if not sources.isEmpty():
            at = ["table", "record", "field"]
            open_ = self._keep("open", ends.join(direct.select(*at), at, "left_anti"))
            below = self._keep("keys/of=below", self._below(open_, sources))
            if (below.agg(F.max("from_round")).first()[0] or 0) >= max_rounds:
                self._too_deep()
            self._add(open_.join(self.keys(), ["parent", "key"]), "inherited", F.col("from_round") + 1)
        for name in ("ends", "open", "ids", "jumps", "ways", "near"):
            remove(self.spark, f"{self.folder}/{name}")

    def _too_deep(self) -> None:
        raise RuntimeError(f"the cascade of orphans goes on after {self.max_rounds} rounds; raise max_rounds")

    def _read(self, name: str, schema: str | StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self._read(name, df.schema)

    def _add(self, ends: DataFrame, how: str, n: Column) -> DataFrame:
        return self._keep(f"levels/of={how}", ends.select("table", "record", "field", "parent", "key", "at", F.lit(how).alias("how"), n.alias("round"), "own"))

    def _below(self, open_: DataFrame, sources: DataFrame) -> DataFrame:
        """(parent, key, from_round) of the ids below a source."""
        links = open_.where("own is not null and not (table = parent and own = key)").select("table", "own", "parent", "key")
        links = links.join(sources.select(F.col("parent").alias("table"), F.col("key").alias("own")), ["table", "own"], "left_anti")
        up = F.struct("parent", "key")
        ids = links.groupBy("table", "own").agg(F.min(up).alias("up"), F.max(up).alias("last"))
        one = F.col("up") == F.col("last")
        self._keep("ids", ids.select("table", "own", *[F.when(one, F.col(f"up.{x}")).alias(x) for x in ("parent", "key")]))
        ids = self._read("ids", self.IDS)
        stops = sources.select("parent", "key", F.lit("source").alias("stop")).unionByName(ids.select(F.col("table").alias("parent"), F.col("own").alias("key"), F.when(F.col("key").isNull(), "several").otherwise("none").alias("stop")))
        jumps = self._jumps(ids.where("key is not null").join(stops, ["parent", "key"]).withColumn("steps", F.lit(1)))
        found = jumps.where("stop = 'source'").select(F.col("table").alias("parent"), F.col("own").alias("key"), F.col("steps").alias("from_round"))
        several = ids.where("key is null").select("table", "own")
        if several.isEmpty():
            return found
        near = self._near(links.join(several, ["table", "own"], "left_semi"), jumps, stops.where("stop <> 'none'"))
        under = jumps.where("stop = 'several'").join(near, ["parent", "key"]).select(F.col("table").alias("parent"), F.col("own").alias("key"), (F.col("from_round") + F.col("steps")).alias("from_round"))
        return found.unionByName(near).unionByName(under)

    def _jumps(self, first: DataFrame) -> DataFrame:
        """The jumps of ids of one parent to the source or id of several parents where they end; stop is 'none' while they go on."""

        def put(n: int, df: DataFrame) -> int:
            df.select("table", "own", "parent", "key", "steps", "stop").write.partitionBy("stop").parquet(f"{self.folder}/jumps/n={n}")
            return self._read("jumps", self.JUMPS).where(f"n = {n} and stop = 'none'").count()

        n, left, before = 0, put(0, first), -1
        while left not in (0, before):  # while any can still end, some end in each round; the others are on or under a loop without a source
            jumps = self._read("jumps", self.JUMPS)
            far = jumps.where(f"n = {n} or stop <> 'none'").select(F.col("table").alias("parent"), F.col("own").alias("key"), F.col("parent").alias("to"), F.col("key").alias("to_key"), F.col("steps").alias("more"), "stop")
            on = jumps.where(f"n = {n} and stop = 'none'").select("table", "own", "parent", "key", "steps").join(far, ["parent", "key"])
            n, before, left = n + 1, left, put(n + 1, on.select("table", "own", F.col("to").alias("parent"), F.col("to_key").alias("key"), (F.col("steps") + F.col("more")).alias("steps"), "stop"))
        return self._read("jumps", self.JUMPS).where("stop <> 'none'").drop("n")

    def _near(self, links: DataFrame, jumps: DataFrame, stops: DataFrame) -> DataFrame:
        """(parent, key, from_round) of the ids of several parents that are below a source."""
        far = jumps.select(F.col("table").alias("parent"), F.col("own").alias("key"), F.col("parent").alias("to"), F.col("key").alias("to_key"), "steps", "stop")
        far = far.unionByName(stops.select("parent", "key", F.col("parent").alias("to"), F.col("key").alias("to_key"), F.lit(0).alias("steps"), "stop"))
        ways = self._keep("ways", links.join(far, ["parent", "key"]).groupBy("table", "own", "to", "to_key", "stop").agg((F.min("steps") + 1).alias("steps")))

        def put(n: int, df: DataFrame) -> DataFrame:
            return self._keep(f"near/n={n}", df.groupBy(F.col("table").alias("parent"), F.col("own").alias("key")).agg(F.min("steps").alias("from_round")))

        def best() -> DataFrame:
            return self._read("near", self.KEYS).groupBy("parent", "key").agg(F.min("from_round").alias("from_round"))

        new, n = put(0, ways.where("stop = 'source'")), 0
        while not new.isEmpty():
            n += 1
            if n > self.max_rounds:  # each step adds one or more, so what is still getting nearer is that deep
                self._too_deep()
            on = ways.where("stop = 'several'").join(new.select(F.col("parent").alias("to"), F.col("key").alias("to_key"), "from_round"), ["to", "to_key"])
            known = best().select(F.col("parent").alias("table"), F.col("key").alias("own"), F.col("from_round").alias("least"))
            on = on.select("table", "own", (F.col("from_round") + F.col("steps")).alias("steps")).join(known, ["table", "own"], "left")
            new = put(n, on.where("least is null or steps < least"))
        return best()

    def levels(self) -> DataFrame:
        return self._read("levels", self.LEVEL).drop("of")

    def keys(self) -> DataFrame:
        return self._read("keys", self.KEYS).drop("of")


def orphans(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey], cascade: bool = True, max_rounds: int = 10_000) -> DataFrame:
    """Every orphan reference end: (table, record, field, parent, key, at, how, round).

    how is 'direct' when no state of the parent table with that key is alive at the reference's own time
    (born <= at and died null or later than at), and 'inherited' when the parent is there but is itself an orphan
    record, directly or through its own parent; round is 0 for direct ends and else the number of steps down.
    An end that is both is 'direct'.

    Method: fixpoint cascade. Round 0 is an anti-join of all ends with the lives of their parents; below it, pointer doubling finds
    for each key the fewest steps up to a key found orphan in round 0, and an end of a key n steps down is of round n + 1. Keys of one parent take
    log2 of the longest chain in joins, however deep the cascade; between keys with several parents (states that name different ones) it is
    one join a step. Loops end: jumps that no longer settle are on or under a loop without an orphan. A cascade of more
    than `max_rounds` rounds raises RuntimeError; a result is never cut short.

    Scale: one pass over each child table; the anti-join shuffles the ends once on (parent, key), and a hot key is
    split by adaptive execution since the parent side holds few rows a key. The loop runs only over tables that are
    referred to by others; the others (the large fact tables) join once with the final set. Each join reads the open jumps
    and the settled ones from the shared folder and adds its own to folders there, so plan and driver memory don't grow
    with the joins before it; keys that come to no orphan leave, so after a few joins only long chains are left. The ends
    themselves join the keys once. With cascade=False only round 0 is computed.

    Defined cases: keys compare without outer white space and case; a null or blank reference gives a row only where
    `blank_is_orphan`; a null time (where the key has one) is never covered by a life, so such an end is direct; repeated rows give one row
    each record, field; an empty parent table makes every end direct; an empty child gives none; further columns,
    whatever their names, are ignored.
    """
    by_child: dict[str, list[ForeignKey]] = {}
    for k in keys:
        by_child.setdefault(k.child, []).append(k)
    alive = _union([lives(tables[p]).withColumn("parent", F.lit(p)) for p in sorted({k.parent for k in keys})])
    looped = [c for c, ks in by_child.items() if cascade and any(k.child_id for k in ks)]
    columns = ["table", "record", "field", "parent", "key", "at", "how", "round"]
    parts, seen = [], None
    if looped:
        inner = _Cascade(_union([_ends(tables[c], by_child[c]) for c in looped]).distinct(), alive, max_rounds)
        parts, seen = [inner.levels().select(*columns)], inner.keys()
    rest = [_ends(tables[c], by_child[c]) for c in by_child if c not in looped]
    if rest:
        ends = _union(rest)
        one = _uncovered(ends, alive).withColumns({"how": F.lit("direct"), "round": F.lit(0)}).select(*columns)
        if seen is not None:
            below = ends.join(seen, ["parent", "key"]).withColumns({"how": F.lit("inherited"), "round": F.col("from_round") + 1}).select(*columns)
            one = one.unionByName(below.join(one.select("table", "record", "field"), ["table", "record", "field"], "left_anti").select(*columns))
        parts.append(one)
    return _union(parts).distinct()


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphan ends per parent table, month of their time and how: (target_table, month, how, ends, records)."""
    return found.groupBy(F.col("parent").alias("target_table"), F.date_format("at", "yyyy-MM").alias("month"), "how").agg(F.count(F.lit(1)).alias("ends"), F.countDistinct("table", "record").alias("records"))
