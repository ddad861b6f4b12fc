"""JSON lines with a header row: reading skips and returns the header, writing puts it first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META = "_meta"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of gzip or plain JSON lines without the header row; the schema is declared, never inferred."""
    return spark.read.schema(f"{META} boolean, {schema}").json(path).where(f"coalesce({META}, false) = false").drop(META)


def read_header(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The header row alone."""
    return spark.read.schema(f"{META} boolean, {schema}").json(path).where(META).drop(META)


def write_jsonl(df: DataFrame, path: str, order: list[str], header: dict[str, str]) -> None:
    """One gzip file a partition, rows in order of the key; the header is a file of its own that sorts first.

    Rows are range-partitioned, not gathered, so a large table stays spread; read together the files are in order.
    """
    spark = df.sparkSession
    head = spark.range(1).select(F.lit(True).alias(META), *[F.lit(v).alias(k) for k, v in header.items()])
    head.write.mode("overwrite").option("compression", "gzip").json(f"{path}/0-header")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "gzip").json(f"{path}/1-rows")
