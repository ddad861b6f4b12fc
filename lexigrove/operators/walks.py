"""Walks: lines in document order become a tree by state machines that know which marker must come next."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexigrove.functions.text import ROMAN

#: Points by which a line must be indented beyond its clause list to be of a deeper one.
DEEPER = 12

_SENTENCE = re.compile(r"\(([0-9]+(?:\.[0-9]+)?)\)")
_CLAUSE = re.compile(r"\(([a-z](?:\.[0-9]+)?)\)")
_SUBCLAUSE = re.compile(r"\(([ivxl]+)\)")
_NUMBER = re.compile(r"([0-9]+(?:\.[0-9]+){0,3}[A-Z]?)\.?")


def ordered_fold(df: DataFrame, by: str, order: list[str], fold: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """`fold` over the rows of each group in order, streamed: a group is sorted by Spark and never held as a whole.

    fold gets an iterator of rows as dicts and yields dicts of the result's columns.
    """
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        ahead = next(rows, None)
        held: list[dict] = []
        while ahead is not None:
            key = ahead[by]

            def group(key=key) -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[by] == key:
                    row, ahead = ahead, next(rows, None)
                    yield row

            one = group()
            for found in fold(one):
                held.append(found)
                if len(held) >= 8_192:
                    yield pa.RecordBatch.from_pylist(held, schema=out)
                    held = []
            for _ in one:  # what the fold didn't take
                pass
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=out)

    return df.repartition(by).sortWithinPartitions(by, *order).mapInArrow(run, schema)


def accepted_markers(rows: Iterator[dict]) -> Iterator[dict]:
    """Each row (number) with the number expected at it and whether the marker is accepted: it is the next in sequence, or a decimal insertion.

    A marker that isn't accepted is a wrapped line and doesn't move the sequence on.
    """
    want = 1
    for row in rows:
        number = row["number"] or ""
        inserted = re.fullmatch(r"[0-9]+\.[0-9]+", number) is not None
        ok = inserted or number == str(want)
        yield row | {"expected": want, "ok": ok}
        if ok and not inserted:
            want = int(number) + 1


class Walk:
    """The state of a walk: the open node of each level, the next number of each list, the indent of the open clause list."""

    LEVELS = ("root", "part", "section", "subsection", "article", "sentence", "clause", "subclause")

    def __init__(self) -> None:
        self.open: dict[str, str] = {}
        self.next = {"sentence": 1, "clause": 1, "subclause": 1}
        self.indent: float | None = None

    def host(self) -> str | None:
        return next((self.open[x] for x in reversed(self.LEVELS) if x in self.open), None)

    def enter(self, level: str, key: str) -> str:
        at = self.LEVELS.index(level)
        self.open = {x: k for x, k in self.open.items() if self.LEVELS.index(x) < at} | {level: key}
        for lower in self.next:
            if self.LEVELS.index(lower) > at:
                self.next[lower] = 1
        if at <= self.LEVELS.index("sentence"):
            self.indent = None
        return key


def _head(walk: Walk, marker: str) -> tuple[str, str] | None:
    """(level, key) of a numbered head; None where its number belongs to another part, or to no part."""
    m = _NUMBER.fullmatch(marker)
    if not m or "part" not in walk.open:
        return None
    number = m[1]
    steps = number.split(".")
    part = walk.open["part"]
    if steps[0] != part.rsplit("/", 1)[-1] or not 2 <= len(steps) <= 4:
        return None
    level = ("section", "subsection", "article")[len(steps) - 2]
    # Heads above that were never printed are supplied.
    for k, upper in enumerate(("section", "subsection")[: len(steps) - 2], 2):
        if upper not in walk.open:
            walk.enter(upper, f"{part}/{'.'.join(steps[:k]).rstrip('ABCDEFGH')}")
    return level, f"{part}/{number}"


def division_walk(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows (key, volume_key, marker, opens, region, x0) of one volume in document order to (key, derived, level): the id that the walk gives a line, null for a line that is text of the open node.

    opens marks the head of something else than a division, region the lines of tables and figures. A division is a letter and a full stop, a part a number and a full stop under it; heads carry two to four numbers, of which the first must be the part's;
    sentences (1), clauses (a) and subclauses (i) must be the next in their list or a decimal insertion. "(i)" is a clause only where the letter is due
    in the clause list, and not where it is indented below that list and a subclause i is due.
    """
    walk = Walk()
    root = None
    for row in rows:
        marker = row["marker"] or ""
        level = key = None
        if row["opens"]:
            walk, root = Walk(), None
        elif row["region"]:
            pass
        elif re.fullmatch(r"[A-Z]\.", marker):
            root = f"{row['volume_key']}/{marker[:-1].lower()}"
            walk = Walk()
            level, key = "root", walk.enter("root", root)
        elif re.fullmatch(r"[0-9]+\.", marker) and root:
            level, key = "part", walk.enter("part", f"{root}/{marker[:-1]}")
        elif head := _head(walk, marker):
            level, key = head[0], walk.enter(*head)
            walk.next["sentence"] = 1
        elif (m := _SENTENCE.fullmatch(marker)) and "article" in walk.open:
            if "." in m[1] or int(m[1]) == walk.next["sentence"]:
                level, key = "sentence", walk.enter("sentence", f"{walk.open['article']}/({m[1]})")
                walk.next["sentence"] += "." not in m[1]
        else:
            level, key = _list_item(walk, marker, row["x0"]) or (None, None)
        yield {"key": row["key"], "derived": key, "level": level, "host": None if key else walk.host()}


def _list_item(walk: Walk, marker: str, x0: float | None) -> tuple[str, str] | None:
    c, s = _CLAUSE.fullmatch(marker), _SUBCLAUSE.fullmatch(marker)
    deeper = walk.indent is not None and x0 is not None and x0 > walk.indent + DEEPER
    due = chr(96 + walk.next["clause"])
    as_clause = bool(c) and (c[1] == due or "." in c[1] and not deeper)
    n = walk.next["subclause"]
    as_sub = bool(s) and n <= len(ROMAN) and s[1] == ROMAN[n - 1]
    if as_sub and "clause" in walk.open and not (as_clause and not deeper):
        walk.next["subclause"] += 1
        return "subclause", walk.enter("subclause", f"{walk.open['clause']}/({s[1]})")
    if as_clause and "sentence" in walk.open:
        walk.enter("clause", f"{walk.open['sentence']}/({c[1]})")
        walk.indent = x0 if walk.indent is None else walk.indent
        if "." not in c[1]:
            walk.next["clause"] = ord(c[1]) - 96 + 1
        return "clause", walk.open["clause"]
    return None


def rooted_walk(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows (key, marker, label, opens, prefix, x0) to (key, derived, level, heading): the walk of acts, appendices and standards.

    opens marks a root (prefix: what its heads carry before their number, null where the root is none of these); a head is a number of up to four parts and a full stop;
    (1), (a) and (i) under it follow the rules of `division_walk`. A label (a marginal note) waits and becomes the heading of the next head or (1)-item; of several the last.
    """
    walk, pending, root, prefix = Walk(), None, None, ""
    for row in rows:
        marker = row["marker"] or ""
        level = key = heading = None
        pending = row["label"] or pending
        if row["opens"]:
            root, prefix, pending = row["key"] if row["prefix"] is not None else None, row["prefix"], None
            walk = Walk()
            if root:
                level, key = "root", walk.enter("root", root)
        elif root is None:
            pass
        elif (m := re.fullmatch(r"([0-9]+(?:\.[0-9]+){0,3})\.", marker)) and not row["region"]:
            level, key = "head", walk.enter("article", f"{root}/{prefix}{m[1]}")
            walk.next["sentence"] = 1
            heading, pending = pending, None
        elif (m := _SENTENCE.fullmatch(marker)) and "article" in walk.open:
            if "." in m[1] or int(m[1]) == walk.next["sentence"]:
                level, key = "sentence", walk.enter("sentence", f"{walk.open['article']}/({m[1]})")
                walk.next["sentence"] += "." not in m[1]
                heading, pending = pending, None
        elif item := _list_item(walk, marker, row["x0"]):
            level, key = item
        yield {"key": row["key"], "derived": key, "level": level, "heading": heading}


def index_walk(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows (key, opens, level) of an index, level 0 for main entries, to (key, derived, above): one running number for all entries, a subentry under the last entry of the level above."""
    n, root = 0, None
    open_: list[str] = []
    for row in rows:
        if row["opens"]:
            n, root, open_ = 0, row["key"], []
            continue
        if root is None:
            continue
        n += 1
        level = min(row["level"], len(open_))
        above = open_[level - 1] if level else root
        key = f"{above}/{'s' if level else 'e'}{n}"
        open_ = [*open_[:level], key]
        yield {"key": row["key"], "derived": key, "above": above}
