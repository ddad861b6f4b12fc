"""Table source: one parquet per table in a directory, with clear errors for what is missing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Read `{directory}/{name}.parquet`; columns are pruned and filters pushed by Catalyst.

    A missing table raises FileNotFoundError with the path that was looked for.
    """
    path = f"{directory.rstrip('/')}/{name}.parquet"
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"there is no table {name!r}: {path} doesn't exist; give the directory that holds the parquet tables") from e
        raise
