"""Sinks: tables, pages of text and link records, written where all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F



def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """One parquet table each, partitioned where asked."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{folder}/{name}.parquet")


def write_pages(lines: DataFrame, folder: str, group: str, order: list[str], text: str) -> None:
    """Text pages: one folder a group, its lines in order. Groups are not gathered on the driver."""
    lines.repartition(group).sortWithinPartitions(group, *order).select(group, text).write.mode("overwrite").partitionBy(group).text(folder)


def publish(df: DataFrame, path: str) -> int:
    """Write a parquet table beside its place, count what can be read back, then put it in place of the old one.

    Readers see the old table or the new one. Returns the number of rows; a write that loses rows raises and changes nothing.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    stage, old = f"{path}.stage-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    observed = Observation()
    df.observe(observed, F.count(F.lit(1)).alias("n")).write.parquet(stage)
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = jvm.org.apache.hadoop.fs.Path
    found = spark.read.parquet(stage).count()
    if found != observed.get["n"]:
        fs.delete(at(stage), True)
        raise OSError(f"{path}: {observed.get['n']} rows were written, {found} can be read")
    had = fs.exists(at(path))
    if had:
        fs.rename(at(path), at(old))
    if not fs.rename(at(stage), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"{path}: the new table couldn't be put in place")
    if had:
        fs.delete(at(old), True)
    return found
