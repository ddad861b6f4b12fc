"""Comparison of results as bags of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def bag(rows, columns=None) -> Counter:
    """Rows of Spark (by column name) or tuples as a bag."""
    return Counter(tuple(plain(r[c]) for c in (columns or range(len(r)))) for r in rows)


def spark_bag(df) -> Counter:
    return bag(df.collect(), sorted(df.columns))


def rows(df) -> list[tuple]:
    return sorted((tuple(plain(x) for x in r) for r in df.collect()), key=repr)
