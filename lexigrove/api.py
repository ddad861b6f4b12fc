"""The retrieval tools as plain functions over a directory of tables; each returns a DataFrame."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key
from lexigrove.functions.text import STOP
from lexigrove.operators import retrieval as op
from lexigrove.plans import bundle, graph
from lexigrove.plans import search as hybrid
from lexigrove.plans.views import nodes


def _key(anchor: str) -> Column:
    return id_key(F.lit(anchor))


def _one(spark: SparkSession, anchor: str) -> DataFrame:
    return spark.range(1).select(_key(anchor).alias("key"))


def search(spark: SparkSession, d: str, query: str, limit: int = 10, mode: str = "fuse") -> DataFrame:
    """The best articles for a text, with a snippet. mode: fts (words), vec (vectors), rrf (both by rank), fuse (the top half of each first), or nodes (words, nodes of any type)."""
    n = nodes(spark, d)
    shown = n.select("key", F.col("rid").alias("doc"), "id", "node_type", "designator", "volume", "page", F.left(F.coalesce(F.nullif("heading", F.lit("")), "body"), F.lit(160)).alias("snippet"))
    asked = spark.createDataFrame([(0, query)], "qid bigint, text string")
    if mode == "nodes":
        docs = n.select("rid", F.concat_ws(" ", "heading", "body").alias("text"))
        hits = op.bm25(docs, asked, "rid", "text", STOP, limit).join(shown, "doc")
    else:
        hits = hybrid.hybrid(spark, d, asked, limit, mode).withColumnRenamed("id", "key").join(shown, "key")
    return hits.select("rank", "id", "node_type", "designator", "volume", "page", "snippet").orderBy("rank")


def resolve(spark: SparkSession, d: str, anchor: str) -> DataFrame:
    """The nodes that an id, a printed designator or a text means, in the order of the tiers."""
    return hybrid.resolve(spark, d, spark.createDataFrame([(anchor,)], "text string")).orderBy("tier", "pos")


def get_provision(spark: SparkSession, d: str, anchor: str) -> DataFrame:
    """The text leaves of any node with their modality, in document order."""
    return graph.get_provision(spark, d, _one(spark, anchor)).orderBy("rid")


def get_context(spark: SparkSession, d: str, anchor: str, budget: int = 8_000, hops: int = 1) -> DataFrame:
    """The context bundle of any node as Markdown, cut to a budget of approximate tokens."""
    return bundle.bundle_markdown(spark, d, _key(anchor), budget, hops)


def neighbors(spark: SparkSession, d: str, anchor: str) -> DataFrame:
    """Parent, children, outgoing, term and the first 50 incoming neighbours of a node."""
    return graph.neighbors(spark, d, _one(spark, anchor)).orderBy("rel", "other")


def what_cites(spark: SparkSession, d: str, anchor: str) -> DataFrame:
    """What cites a node or anything in its subtree."""
    return graph.what_cites(spark, d, _key(anchor)).orderBy("src", "kind")


def capabilities(spark: SparkSession, d: str) -> DataFrame:
    """What the graph can't answer, by probes of the tables."""
    return graph.capability_probes(spark, d)


TOOLS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (search, resolve, get_provision, get_context, neighbors, what_cites, capabilities)}

_JSON = {"str": "string", "int": "integer"}


def schemas() -> list[dict]:
    """The tools as JSON schemas: name, description, and the arguments besides session and directory with type and default."""
    out = []
    for name, f in TOOLS.items():
        arguments = list(inspect.signature(f).parameters.values())[2:]
        properties = {a.name: {"type": _JSON[a.annotation]} | ({} if a.default is a.empty else {"default": a.default}) for a in arguments}
        schema = {"type": "object", "properties": properties, "required": [a.name for a in arguments if a.default is a.empty], "additionalProperties": False}
        out.append({"name": name, "description": inspect.getdoc(f) or name, "input_schema": schema})
    return out


def call(spark: SparkSession, d: str, name: str, **arguments) -> DataFrame:
    """Run a tool by name; an unknown tool or argument, or one that is missing, raises with what there is."""
    if name not in TOOLS:
        raise KeyError(f"no tool {name!r}; there are {', '.join(TOOLS)}")
    schema = next(x for x in schemas() if x["name"] == name)["input_schema"]
    wrong, missing = set(arguments) - set(schema["properties"]), set(schema["required"]) - set(arguments)
    if wrong or missing:
        raise TypeError(f"{name} takes {', '.join(schema['properties']) or 'no arguments'}; unknown: {sorted(wrong)}, missing: {sorted(missing)}")
    return TOOLS[name](spark, d, **arguments)
