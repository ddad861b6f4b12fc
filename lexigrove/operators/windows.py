"""Window operators: clusters, islands, carry-forward, bounded levels and subsequences."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def gap_clusters(df: DataFrame, by: Sequence[str], value: str, gap: float, tie: str) -> DataFrame:
    """df with `cluster`: a new one begins where a value lies more than `gap` above the one before it."""
    w = Window.partitionBy(*by).orderBy(value, tie)
    jump = F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0)
    return df.withColumn("_jump", jump).withColumn("cluster", F.sum("_jump").over(w)).drop("_jump")


def gap_clusters_from_start(df: DataFrame, by: Sequence[str], value: str, gap: float, tie: str) -> DataFrame:
    """df with `cluster`: a new one begins where a value lies more than `gap` above the first of the open cluster.

    Depends on where the cluster began, so it is a fold over each group in order; groups must be bounded (a page).
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([value, tie], kind="stable")
        clusters, start, n = [], None, -1
        for v in pdf[value]:
            if start is None or v - start > gap:
                start, n = v, n + 1
            clusters.append(n)
        return pdf.assign(cluster=clusters)

    return df.groupBy(*by).applyInPandas(fold, StructType([*df.schema.fields, StructField("cluster", IntegerType())]))


def islands(df: DataFrame, by: Sequence[str], value: str, most: int = 1) -> DataFrame:
    """(by, first, last, n): runs of values in which neighbours differ by at most `most`."""
    w = Window.partitionBy(*by).orderBy(value)
    new = F.when(F.col(value) - F.lag(value).over(w) <= most, 0).otherwise(1)
    run = df.select(*by, value).distinct().withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return run.groupBy(*by, "_run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count(F.lit(1)).alias("n")).drop("_run")


def clamped_levels(raw: Column, order: Column, by: Column) -> Column:
    """Level of each row when no level may exceed the one before it by more than one and the first is 0.

    Closed form of the running rule: the smallest of raw[j] + (i - j) over all rows j up to i, and i itself.
    """
    w = Window.partitionBy(by).orderBy(order)
    i = F.row_number().over(w) - 1
    return F.least(F.min(raw - i).over(w.rowsBetween(Window.unboundedPreceding, 0)) + i, i)


def carry_forward(value: Column, by: Sequence[str], order: Sequence[str]) -> Column:
    """The last value up to each row that isn't null."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def longest_nondecreasing(keys: Sequence[str]) -> list[int]:
    """Positions of a longest non-decreasing subsequence, n log n."""
    tails: list[str] = []
    at: list[int] = []
    before = [-1] * len(keys)
    for i, k in enumerate(keys):
        p = bisect_right(tails, k)
        before[i] = at[p - 1] if p else -1
        if p == len(tails):
            tails.append(k)
            at.append(i)
        else:
            tails[p], at[p] = k, i
    found, i = [], at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def boundary_chain(df: DataFrame, by: str, order: str, key: str) -> DataFrame:
    """The rows of each group that make a longest chain of non-decreasing keys in the given order.

    A group is one text with its definitions, which one task can hold.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, key], kind="stable")
        return pdf.iloc[longest_nondecreasing(pdf[key].tolist())]

    return df.groupBy(by).applyInPandas(fold, df.schema)
