"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, share: float = 0.02, least: int = 10_000) -> list:
    """Keys with more than `share` of all rows (at least `least`); at most 1/share keys exist, so the list is bounded.

    The counts are aggregated map-side before the shuffle, so the hot key itself never travels row by row.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    top = counts.orderBy(F.desc("count")).limit(max(1, int(1 / share)) + 1).collect()
    rows = df.count()
    return [r[0] for r in top if r[1] > max(least, share * rows)]


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: list, how: str = "left", salts: int = 32) -> DataFrame:
    """left join right on `key`, the hot keys of `left` spread over `salts` partitions.

    Only the right rows of hot keys are repeated (`salts` times); right must hold few rows per key (a dimension).
    """
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    spread = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0).cast("bigint")))
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    return spread.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], how).drop("_salt")
