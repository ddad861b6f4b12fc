"""Incremental maintenance with Structured Streaming: an extension, batch pipelines need none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.operators.retrieval import tokens


def index_deltas(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, docs): what a batch of new documents adds to the document frequencies."""
    return rows.select(id_col, F.explode(F.array_distinct(tokens(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("docs"))


def maintain_index(spark: SparkSession, source: str, schema, folder: str, id_col: str, text_col: str, files_per_trigger: int = 4) -> None:
    """Follow a folder of parquet files and keep deltas of the index, one folder per batch.

    A batch writes its deltas under its own number, so a batch that is run again after a failure replaces itself: the
    index is exact however often executors are lost. `current_index` sums the deltas.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def upsert(batch: DataFrame, number: int) -> None:
        index_deltas(batch, id_col, text_col).write.mode("overwrite").parquet(f"{folder}/deltas/batch={number}")

    stream.select(id_col, text_col).writeStream.foreachBatch(upsert).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()


def current_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/deltas").groupBy("term").agg(F.sum("docs").alias("docs"))


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts per event-time window and key; rows later than `late` behind the newest are left out."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))  # a watermark needs an instant
    return timed.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def run_to_table(spark: SparkSession, result: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all that is there and read what it appended."""
    result.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/out")


def sessions(events: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    """(key, start, last, n): sessions of events no further apart than `gap`, in batch or stream."""
    s = events.withColumn(time, F.col(time).cast("timestamp")).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"), F.max(time).alias("last"))
    return s.select(key, F.col("w.start").alias("start"), "last", "n")


def running_totals(events: DataFrame, key: str, time: str, tie: str, value: str) -> DataFrame:
    """df with the running sum of value per key in order of time."""
    return events.withColumn("total", F.round(F.sum(value).over(Window.partitionBy(key).orderBy(time, tie).rowsBetween(Window.unboundedPreceding, 0)), 4))


