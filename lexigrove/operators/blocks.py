"""A query set against all rows, a bounded block of queries at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

from lexigrove.session import scratch


def over_blocks(spark: SparkSession, blocks: Iterable, against: Callable[..., DataFrame], schema: str, name: str) -> DataFrame:
    """The rows of against(broadcast block) of all blocks, columns by `schema`.

    One block stays lazy. Of several, one broadcast is alive at a time: each block's rows are added to a folder of the shared
    folder, and its broadcast is destroyed before the next block is taken. No block gives no rows.
    """
    blocks = iter(blocks)
    first = next(blocks, None)
    if first is None:
        return spark.createDataFrame([], schema)
    second = next(blocks, None)
    if second is None:
        return against(spark.sparkContext.broadcast(first))
    folder = scratch(spark, name)
    for block in chain([first, second], blocks):
        shared = spark.sparkContext.broadcast(block)
        against(shared).write.mode("append").parquet(folder)
        shared.destroy()
    return spark.read.schema(schema).parquet(folder)
