"""Splitting oversized items at natural boundaries by recursive bisection."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1_000, 100

# The natural boundaries, strongest first: line breaks, then the marks . ; : ? ! followed by white space.
_BOUNDARY = re.compile(r"(?:\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])|[.;:?!](?=\s)")


def boundaries(text: str) -> list[tuple[int, int]]:
    """(position after the boundary, strength) of each natural boundary inside text, in order.

    Strength 3 for an empty line, 2 for a line break, 1 for a mark.
    """
    found: list[tuple[int, int]] = []
    for m in _BOUNDARY.finditer(text):
        if m[0][0] in ".;:?!":
            strength = 1
        else:
            strength = 3 if found and found[-1][1] >= 2 and not text[found[-1][0] : m.start()].strip() else 2
        if 0 < m.end() < len(text):
            found.append((m.end(), strength))
    return found


def longest_stretch(text: str, cuts: list[tuple[int, int]]) -> int:
    """The longest run of characters between two neighbouring boundaries (the ends of the text count as such)."""
    edges = [0, *(p for p, _ in cuts), len(text)]
    return max(b - a for a, b in zip(edges, edges[1:], strict=False))


def _cut(lo: int, hi: int, size: int, places: list[int], strengths: list[int], text: str) -> int:
    """Where to cut [lo, hi): the strongest boundary near the midpoint, the nearest of equals, else a blank, else the midpoint."""
    mid = (lo + hi) // 2
    a, b = bisect_right(places, lo), bisect_left(places, hi)
    if a < b:
        # "Near" is the middle half; outside of it the nearest boundary counts, whatever its strength.
        quarter = (hi - lo) // 4
        near = range(max(a, bisect_left(places, mid - quarter)), min(b, bisect_right(places, mid + quarter)))
        if near:
            return places[min(near, key=lambda i: (-strengths[i], abs(places[i] - mid), places[i]))]
        return places[min(range(a, b), key=lambda i: (abs(places[i] - mid), places[i]))]
    # No natural boundary: a multiple of the size, so that the fewest pieces are forced, and before a word if possible.
    at = lo + size * max(1, round((mid - lo) / size))
    at = at if lo < at < hi else mid
    blank = max(text.rfind(" ", max(lo + 1, at - 60), at), text.rfind("\t", max(lo + 1, at - 60), at))
    return blank + 1 if lo < blank + 1 < hi else at


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of text, in order: each at most `limit` long, each after the first starting `overlap` before the end of the last.

    Halves are cut again while they exceed the limit minus the overlap (the first piece has no overlap and may fill the
    limit); neighbouring leaves that still fit together are joined again.
    """
    if len(text) <= limit:
        return [(0, len(text))] if text else []
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    size = limit - overlap
    cuts = boundaries(text)
    places, strengths = [p for p, _ in cuts], [s for _, s in cuts]
    leaves, todo = [], [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= (limit if lo == 0 else size):
            leaves.append((lo, hi))
            continue
        at = _cut(lo, hi, size, places, strengths, text)
        todo.append((at, hi))
        todo.append((lo, at))
    joined = [leaves[0]]
    for lo, hi in leaves[1:]:
        first = joined[-1][0]
        if hi - first <= (limit if first == 0 else size):
            joined[-1] = (first, hi)
        else:
            joined.append((lo, hi))
    return [(max(0, lo - overlap) if lo else 0, hi) for lo, hi in joined]


def items(nodes: DataFrame) -> DataFrame:
    """(node_id, item): heading, line break, body; the body alone under a null or blank heading; no body, no item."""
    blank = F.trim(F.regexp_replace(F.coalesce("heading", F.lit("")), r"(?U)\s+", " ")) == ""
    return nodes.where("body is not null and body <> '' and id is not null").select(F.col("id").alias("node_id"), F.when(blank, F.col("body")).otherwise(F.concat("heading", F.lit("\n"), "body")).alias("item"))


def split_items(items_: DataFrame, id_col: str = "node_id", text_col: str = "item", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of every item longer than `limit`: (id, seq, first, last, piece, how, n_chars), first and last as offsets [first, last).

    how is 'forced' when some stretch between two neighbouring natural boundaries is itself longer than the limit,
    else 'boundary'. Lengths are code points.

    Method: recursive bisection: an item is cut at the strongest boundary near its midpoint, the halves again until
    they fit, then each piece gets the overlap before it.

    Scale: one pass, no shuffle beyond the removal of repeated items; short items are filtered before Python sees them.
    A long text is cut in its own task with a sorted boundary list, n log n in its length.

    Defined cases: null or blank ids and texts and items within the limit give no rows; a stretch longer than the limit
    minus the overlap is cut inside, before a word where there is one; repeated rows count once; different texts
    under one id give each its own pieces (told apart by `n_chars` and text); extra columns are ignored.
    """
    long = items_.select(F.col(id_col).alias("id"), F.col(text_col).alias("item")).where(F.length("item") > limit).where("id is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                how = "forced" if longest_stretch(text, boundaries(text)) > limit else "boundary"
                rows.extend((key, i, a, b, text[a:b], how, len(text)) for i, (a, b) in enumerate(pieces(text, limit, overlap)))
                if len(rows) >= 2_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    kind = items_.schema[id_col].dataType.simpleString()
    return long.mapInArrow(run, f"id {kind}, seq int, first int, last int, piece string, how string, n_chars int").withColumnRenamed("id", id_col)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (None, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "seq", "first", "last", "piece", "how", "n_chars"])
