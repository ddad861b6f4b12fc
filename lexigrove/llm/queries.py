"""Queries over the language-model problems, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.llm.encode import encode
from lexigrove.llm.leak import leaks
from lexigrove.llm.overlap import overlap_report, overlaps
from lexigrove.llm.reading import reading_levels
from lexigrove.llm.split import items, split_items
from lexigrove.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of one train and one dev or test row that put the same question."""
    found = overlaps(table(spark, d, "evalset"))
    return found.select(F.least("train_id", "held_id").alias("qid_a"), F.greatest("train_id", "held_id").alias("qid_b")).distinct()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps per split and source."""
    records = table(spark, d, "evalset")
    return overlap_report(overlaps(records), records)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized items and how they must be cut."""
    return split_items(items(table(spark, d, "node"))).select("node_id", "how").distinct()


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All pieces of all oversized items in order."""
    return split_items(items(table(spark, d, "node")))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every document encoded by byte_bpe_50k."""
    return encode(table(spark, d, "documents"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "heldout"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of a held-out item."""
    return _leaks(spark, d).where("how = 'passage'").select("doc_id", "item_id").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Per item the documents that hold a passage or a re-parameterised variant of it."""
    return _leaks(spark, d).groupBy("item_id", "how").agg(F.countDistinct("doc_id").alias("documents"))


def _levels(spark: SparkSession, d: str) -> DataFrame:
    return reading_levels(table(spark, d, "documents"), table(spark, d, "reading_label"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The reading band of each English document."""
    return _levels(spark, d).select("doc_id", "band").distinct()


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents, words and the parts of the formula per band."""
    return _levels(spark, d).groupBy("band").agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"), F.round(F.avg("unfamiliar"), 4).alias("unfamiliar"), F.round(F.avg("sentence"), 2).alias("sentence"))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p5_found, p5_pieces, p6_ids, p7_found, p7_report, p8_found, p8_profile)}

_BLANK = "heading IS NULL OR regexp_replace(heading, '[\\s\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+', '', 'g') = ''"

ORACLE = {
    "p5_found": f"""
WITH item AS (SELECT DISTINCT id AS node_id, CASE WHEN {_BLANK} THEN body ELSE heading || chr(10) || body END AS t FROM node WHERE id IS NOT NULL AND body IS NOT NULL AND body <> ''),
part AS (SELECT node_id, t, unnest(string_split_regex(regexp_replace(t, '([.;:?!])(\\s)', '\\1' || chr(1) || '\\2', 'g'), '[\\n\\r\\x01]')) AS p FROM item WHERE length(t) > 1000)
SELECT DISTINCT node_id, CASE WHEN max(length(p)) > 1000 THEN 'forced' ELSE 'boundary' END AS how FROM part GROUP BY node_id, t""",
}
