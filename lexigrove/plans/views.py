"""Clean views of the document graph, as DataFrames and as SQL with the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key
from lexigrove.operators.wide import current_cells
from lexigrove.sources.tables import table

#: The same white space as functions.ids.OUTER_SPACE, as far as it occurs at the ends of ids.
WS = "concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), ' ', chr(133), chr(160), chr(8203), chr(8239), chr(12288), chr(65279))"


def key_sql(col: str) -> str:
    return f"nullif(lower(trim({col}, {WS})), '')"


# What decides between several states of one key after their times: every other column, so that the result doesn't depend on the order of rows.
NODE_TIES = ["rid", "id", "permalink", "volume", "node_type", "number", "designator", "heading", "body", "parent", "page", "bbox", "modality"]
REF_TIES = ["src", "dst", "kind", "text", "reason", "chunk", "line", "s", "e", "seen_at"]
DEFINITION_TIES = ["id", "term", "norm", "blob", "body_offset", "body"]


def _ties(columns: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    A window rather than an aggregate over whole rows: few keys have several rows, so combining before the shuffle would sort all rows once more for little.
    """
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Live nodes: the latest state of each id, if it isn't deleted; key and up are the comparison keys of id and parent."""
    rows = table(spark, d, "node").withColumn("key", id_key("id"))
    last = latest(rows, ["key"], [F.col("loaded_at").desc(), F.col("deleted_at").asc_nulls_first(), *map(F.asc_nulls_first, NODE_TIES)]).where("deleted_at is null")
    box = F.split(F.regexp_replace("bbox", r"[\[\] ]", ""), ",")
    return last.withColumns({"up": id_key("parent")} | {c: F.get(box, F.lit(i)).cast("double") for i, c in enumerate(("x0", "y0", "x1", "y1"))})


N = f"""n AS (SELECT *, {key_sql("parent")} AS up, {", ".join(f"CAST(string_split(regexp_replace(bbox, '[\\[\\] ]', '', 'g'), ',')[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(("x0", "y0", "x1", "y1")))}
  FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC NULLS LAST, deleted_at ASC NULLS FIRST, {_ties(NODE_TIES)}) AS rn FROM (SELECT *, {key_sql("id")} AS key FROM node)) WHERE rn = 1 AND deleted_at IS NULL)"""


def edges(spark: SparkSession, d: str) -> DataFrame:
    """References once per ref_id with comparison keys of src, dst and kind; a blank dst is null."""
    once = latest(table(spark, d, "ref"), ["ref_id"], [F.col("loaded_at").desc(), *map(F.asc_nulls_first, REF_TIES)])
    return once.select("ref_id", id_key("src").alias("src"), id_key("dst").alias("dst"), id_key("kind").alias("kind"), "text", "reason", "chunk", "line", "s", "e", "seen_at")


E = f"""e AS (SELECT ref_id, {key_sql("src")} AS src, {key_sql("dst")} AS dst, {key_sql("kind")} AS kind, text, reason, chunk, line, s, e, seen_at
  FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC NULLS LAST, {_ties(REF_TIES)}) AS rn FROM ref) WHERE rn = 1)"""


def links(spark: SparkSession, d: str) -> DataFrame:
    """The stored closure once per pair, with comparison keys and the smallest depth."""
    return table(spark, d, "closure").select(id_key("ancestor").alias("ancestor"), id_key("descendant").alias("descendant"), "depth").groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth"))


C = f"""c AS (SELECT {key_sql("ancestor")} AS ancestor, {key_sql("descendant")} AS descendant, min(depth) AS depth FROM closure GROUP BY 1, 2)"""


def cells(spark: SparkSession, d: str) -> DataFrame:
    return current_cells(table(spark, d, "cell"))


G = """g AS (SELECT table_id, r, c, text, greatest(coalesce(rowspan, 1), 1) AS rowspan, greatest(coalesce(colspan, 1), 1) AS colspan
  FROM (SELECT *, row_number() OVER (PARTITION BY table_id, r, c ORDER BY loaded_at DESC, text DESC NULLS LAST, rowspan DESC NULLS LAST, colspan DESC NULLS LAST) AS rn FROM cell WHERE table_id IS NOT NULL AND r IS NOT NULL AND c IS NOT NULL) WHERE rn = 1)"""


def definitions(spark: SparkSession, d: str) -> DataFrame:
    """Live definitions: the latest state of each id, if it isn't deleted."""
    rows = table(spark, d, "definition").withColumn("key", id_key("id"))
    return latest(rows, ["key"], [F.col("loaded_at").desc(), F.col("deleted_at").asc_nulls_first(), *map(F.asc_nulls_first, DEFINITION_TIES)]).where("deleted_at is null")


D = f"""d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC NULLS LAST, deleted_at ASC NULLS FIRST, {_ties(DEFINITION_TIES)}) AS rn FROM (SELECT *, {key_sql("id")} AS key FROM definition)) WHERE rn = 1 AND deleted_at IS NULL)"""


def sql(*views: str, recursive: bool = False) -> str:
    """A WITH clause of the given views."""
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(views) + "\n"
