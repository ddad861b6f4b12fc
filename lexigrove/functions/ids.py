"""Identifier normalisation: ids are equal after taking off outer white space and ignoring letter case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space, and the byte order mark and zero-width space.
OUTER_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def trimmed(col: Column | str) -> Column:
    """col without outer white space of any kind."""
    return F.trim(F.col(col) if isinstance(col, str) else col, F.lit(OUTER_SPACE))


def id_key(col: Column | str) -> Column:
    """The comparison key of an id; null for a null or blank id."""
    key = F.lower(trimmed(col))
    return F.when(key != "", key)
