"""File manifests: sizes and digests of binary files, and their verification."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.session import shared_dir
from lexigrove.sources.sinks import publish

#: A pointer in place of a file's content is shorter than this and begins so.
STUB_BYTES, STUB_MAGIC = 1024, b"version https://git-lfs.github.com/spec/v1"


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes, sha256) of files."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def directory_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """(path, bytes, sha256, stub) of all parquet files under a directory, with paths relative to it."""
    root = _qualified(spark, directory)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(directory)
    head = F.substring("content", 1, len(STUB_MAGIC)) == F.lit(bytearray(STUB_MAGIC))
    return files.select(F.expr(f"substring(path, {len(root) + 2})").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), ((F.col("length") < STUB_BYTES) & head).alias("stub"))


def declared_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """The manifest that was written for a directory to the shared folder; the first call writes it."""
    path = f"{shared_dir(spark)}/manifest-{hashlib.sha256(_qualified(spark, directory).encode()).hexdigest()}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        publish(directory_manifest(spark, directory).select("path", "bytes", "sha256"), path)
    return spark.read.parquet(path)


def _qualified(spark: SparkSession, directory: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def verify(declared: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status): missing, undeclared, stub, size, digest or ok."""
    f = found.select("path", F.col("bytes").alias("b"), F.col("sha256").alias("h"), (F.col("stub") if "stub" in found.columns else F.lit(False)).alias("stub"))
    both = declared.select("path", "bytes", "sha256").join(f, "path", "full")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("bytes").isNull(), "undeclared").when(F.col("stub"), "stub").when(F.col("b") != F.col("bytes"), "size").when(F.col("h") != F.col("sha256"), "digest").otherwise("ok")
    return both.select("path", status.alias("status"))
