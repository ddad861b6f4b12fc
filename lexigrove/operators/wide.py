"""Attribute-value cells into wide rows with typed columns."""

from __future__ import annotations

import datetime
import re
import unicodedata
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal, localcontext
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of a wide row, since a DataFrame's schema lives on the driver; `long_values` takes catalogs of any size.
MAX_ATTRS = 4_000
#: Rows of a table that travel together; a long table is spread over many tasks.
BLOCK_ROWS = 4_096
SPARK_TYPES = {"decimal": "decimal(20,2)", "integer": "bigint", "boolean": "boolean", "date": "date", "text": "string"}

# How printed tables write a value.
TRUE = ("yes", "y", "required", "permitted")
FALSE = ("no", "n", "not required", "not permitted")
NO_VALUE = ("n/a", "n.a.")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
FULL_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
FRACTIONS = {"½": "0.5", "¼": "0.25", "¾": "0.75", "⅓": "0.3333", "⅔": "0.6667", "⅛": "0.125", "⅜": "0.375", "⅝": "0.625", "⅞": "0.875"}

_SPACE = re.compile(r"[\s​﻿]+")
_NOTE = re.compile(r"\s?[(\[]\s?\d{1,2}\s?[)\]]$")
_NOTE_SIGNS = "*†‡§¹²³⁴⁵⁶⁷⁸⁹"
_DASHES = re.compile(r"[\s\-‐-―−_.·…]*")
_SIGN = re.compile(r"^([-−‐-―+])\s*(?=[\d.,½¼¾⅓⅔⅛⅜⅝⅞])")
_INTEGER = re.compile(r"\d{1,3}(?:([ ,'’])\d{3})(?:\1\d{3})*|\d+")
_DECIMAL = re.compile(r"(\d+)(?:[.,](\d*))?|[.,](\d+)")
_MIXED = re.compile(r"(\d*)\s?([½¼¾⅓⅔⅛⅜⅝⅞])|(?:(\d+)\s+)?(\d+)\s?[/⁄]\s?(\d+)")
_ISO = re.compile(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})")
_DAY_FIRST = re.compile(r"(\d{1,2})(?:st|nd|rd|th)?[ -]([a-z]+)\.?,?[ -](\d{4})")
_MONTH_FIRST = re.compile(r"([a-z]+)\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})")


def folded(text: str | None) -> str:
    """text trimmed, with white space of any kind folded to one blank."""
    return _SPACE.sub(" ", text or "").strip()


def _bare(text: str) -> str:
    """Letters and digits only, without case and forms of characters."""
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", text).lower())


def without_note(text: str) -> str:
    """A folded text without the note marks at its end; only the end is looked at, however long the text is."""
    while True:
        before = len(text)
        text = text.rstrip().rstrip(_NOTE_SIGNS)
        if m := _NOTE.search(text, max(0, len(text) - 8)):
            text = text[: m.start()]
        if len(text) == before:
            return text


def head_keys(label: str | None, unit: str | None) -> set[str]:
    """Keys under which a printed head means this label: with and without its unit."""
    bare = _bare(label or "")
    return {bare, bare + _bare(unit)} if bare and unit else {bare} - {""}


def head_forms(text: str | None) -> list[str]:
    """Keys of a printed head, the best first."""
    plain = folded(text).rstrip(" :")
    cut = without_note(plain).rstrip(" :")
    inner = re.sub(r"\s*[(\[]\s*\d{1,2}\s*[)\]]\s*", " ", cut)
    return list(dict.fromkeys(k for k in (_bare(cut), _bare(inner), _bare(plain)) if k))


def _figure(text: str, unit: str | None) -> str:
    """A printed figure without unit and note marks."""
    while True:
        before = text
        text = without_note(text)
        if unit:
            for form in (unit, unit.replace("2", "²")):
                if text.lower().endswith(form.lower()) and len(text) > len(form) and not text[: -len(form)][-1:].isalpha():
                    text = text[: -len(form)].rstrip()
        if text == before:
            return text


def _number(text: str, integer: bool) -> Decimal | int | str | None:
    """The figure, as text where its column's type can't hold it, or None."""
    sign = 1
    if m := _SIGN.match(text):
        sign, text = (1 if m[1] == "+" else -1), text[m.end() :]
    if integer:
        if not _INTEGER.fullmatch(text):
            return None
        digits = re.sub(r"\D", "", text).lstrip("0") or "0"
        if len(digits) < 19 or len(digits) == 19 and -(2**63) <= sign * int(digits) < 2**63:
            return sign * int(digits)
        return "-" * (sign < 0) + "".join(str(unicodedata.digit(x)) for x in digits)
    with localcontext() as exact:
        exact.prec = max(28, len(text) + 10)
        if m := _MIXED.fullmatch(text):
            if m[2]:
                value = Decimal(m[1] or 0) + Decimal(FRACTIONS[m[2]])
            elif Decimal(m[5]):
                value = Decimal(m[3] or 0) + Decimal(m[4]) / Decimal(m[5])
            else:
                return None
        elif m := _DECIMAL.fullmatch(text):
            value = Decimal(f"{m[1] or 0}.{m[2] or m[3] or 0}")
        else:
            return None
        value = sign * value.quantize(Decimal("0.01"), ROUND_HALF_UP)
        return value if abs(value) < Decimal(10) ** 18 else format(value, "f")


def _date(text: str) -> datetime.date | None:
    low = text.lower()
    if m := _ISO.fullmatch(low):
        y, mo, d = int(m[1]), int(m[3]), int(m[4])
    else:
        if m := _DAY_FIRST.fullmatch(low):
            d, name, y = int(m[1]), m[2], int(m[3])
        elif m := _MONTH_FIRST.fullmatch(low):
            name, d, y = m[1], int(m[2]), int(m[3])
        else:
            return None
        name = "sep" if name == "sept" else name
        mo = MONTHS.index(name) + 1 if name in MONTHS else FULL_MONTHS.index(name) + 1 if name in FULL_MONTHS else 0
    try:
        return datetime.date(y, mo, d)
    except ValueError:
        return None


@lru_cache(maxsize=100_000)
def parse_value(text: str | None, kind: str, unit: str | None):
    """The typed value that a printed cell states (a figure too large for its type: as text), or None."""
    plain = folded(text)
    if not plain or _DASHES.fullmatch(plain) or plain.lower() in NO_VALUE:
        return None
    if kind == "text":
        return plain
    if kind in ("integer", "decimal"):
        return _number(_figure(plain, unit), kind == "integer")
    plain = without_note(plain)
    if kind == "boolean":
        low = plain.lower()
        return True if low in TRUE else False if low in FALSE else None
    if kind == "date":
        return _date(plain)
    raise ValueError(f"unknown data type {kind!r}")


class ColumnBuilder:
    """One sparse typed column of a batch: a value buffer and a validity mask over the batch's entities."""

    def __init__(self, kind: str):
        self.kind, self.at, self.values = kind, [], []

    def put(self, entity: int, value) -> None:
        self.at.append(entity)
        self.values.append(value)

    def finish(self, n: int) -> pa.Array:
        at = np.array(self.at, dtype=np.int64)
        valid = np.zeros(n, dtype=bool)
        valid[at] = True
        bits = pa.py_buffer(np.packbits(valid, bitorder="little"))
        if self.kind == "text":
            full = np.full(n, None, dtype=object)
            full[at] = self.values
            return pa.array(full, type=pa.string())
        if self.kind == "decimal":
            low = np.zeros((n, 2), dtype=np.int64)
            cents = [int(v.scaleb(2)) for v in self.values]
            low[at, 0] = np.array([c & (2**64 - 1) for c in cents], dtype=np.uint64).view(np.int64)
            low[at, 1] = [c >> 64 for c in cents]
            return pa.Array.from_buffers(pa.decimal128(20, 2), n, [bits, pa.py_buffer(low)])
        if self.kind == "boolean":
            full = np.zeros(n, dtype=bool)
            full[at] = self.values
            return pa.Array.from_buffers(pa.bool_(), n, [bits, pa.py_buffer(np.packbits(full, bitorder="little"))])
        if self.kind == "date":
            full = np.zeros(n, dtype=np.int32)
            full[at] = [v.toordinal() - 719163 for v in self.values]
            return pa.Array.from_buffers(pa.date32(), n, [bits, pa.py_buffer(full)])
        full = np.zeros(n, dtype=np.int64)
        full[at] = self.values
        return pa.Array.from_buffers(pa.int64(), n, [bits, pa.py_buffer(full)])


@lru_cache(maxsize=100_000)
def _head_key(text: str | None) -> str | None:
    return next(iter(head_forms(text)), None)


def _values_of(cells: list[tuple], r: int) -> list[tuple[object, object]] | None:
    """(attribute, value) of one entity, the leftmost value of each attribute; None for a row that is the head again.

    cells: (column, row the cell stands in, attribute, its data type, its unit, key of the column's head, text).
    """
    # Of several cells over one place the one that begins lowest holds.
    last = {cell[0]: cell for cell in sorted(cells, key=lambda x: x[:2])}
    own = [(key, text) for _, at, _, _, _, key, text in last.values() if at == r and _head_key(text)]
    if len(own) > 1 and all(key == _head_key(text) for key, text in own):
        return None
    found = {}
    for _, _, a, kind, unit, _, text in last.values():
        value = None if a is None or a in found else parse_value(text, kind, unit)
        if value is not None:
            found[a] = value
    return list(found.items())


def _entities_of(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[tuple]]]:
    keys, places = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    bounds, flat = batch.column(2).offsets.to_pylist(), batch.column(2).values
    parts = [flat.field(i).to_pylist() for i in range(flat.type.num_fields)]
    for i, (table_id, r) in enumerate(zip(keys, places, strict=True)):
        yield table_id, r, list(zip(*(x[bounds[i] : bounds[i + 1]] for x in parts), strict=True))


def _builder(attrs: list[tuple[str, str, str | None]], more: str):
    """Streams entities (table_id, r, cells) into wide batches of bounded size.

    cells: (column, row the cell stands in, attribute index, key of the column's head, text).
    """
    names = ["table_id", "r", *(a for a, _, _ in attrs), more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            n = len(tables)
            rest = pa.array([large.get(i) for i in range(n)], pa.map_(pa.string(), pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(tables, pa.string()), pa.array(rows, pa.int32()), *(c.finish(n) for c in columns), rest], names=names)

        def fresh() -> tuple:
            return [], [], [ColumnBuilder(k) for _, k, _ in attrs], {}

        tables, rows, columns, large = fresh()
        for batch in batches:
            for table_id, r, cells in _entities_of(batch):
                values = _values_of([(c, at, a, *(attrs[a][1:] if a is not None else (None, None)), key, text) for c, at, a, key, text in cells], r)
                if values is None:
                    continue
                for a, value in values:
                    if isinstance(value, str) and attrs[a][1] != "text":
                        large.setdefault(len(tables), []).append((attrs[a][0], value))
                    else:
                        columns[a].put(len(tables), value)
                tables.append(table_id)
                rows.append(r)
                if len(tables) >= 8_192:
                    yield flush()
                    tables, rows, columns, large = fresh()
        if tables:
            yield flush()

    return run


def _as_text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _long_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(t, r, a, _as_text(v)) for t, r, cells in _entities_of(batch) for a, v in _values_of(cells, r) or ()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], names=["table_id", "r", "attr", "val"])


def catalog_rows(catalog: DataFrame) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """The catalog on the driver, in order of attr; raises beyond MAX_ATTRS, the bound of a wide schema (see `long_values`)."""
    rows = catalog.select("attr", "data_type", "unit", "label", "short_label").where("attr is not null").distinct().limit(MAX_ATTRS + 1).collect()
    if len(rows) > MAX_ATTRS:
        raise ValueError(f"the catalog has more than {MAX_ATTRS} attributes; use long_values")
    return sorted((r[0], (r[1] or "text").strip().lower(), r[2], r[3], r[4]) for r in {r[0]: r for r in sorted(rows, key=str)}.values())


def current_cells(cells: DataFrame) -> DataFrame:
    """Of several states of a cell the one with the latest loaded_at (then the largest text), spans at least 1."""
    state = F.struct(F.coalesce(F.col("loaded_at"), F.lit("0001-01-01").cast("timestamp")).alias("at"), "text", "rowspan", "colspan")
    return (
        cells.where("table_id is not null and r is not null and c is not null")
        .groupBy("table_id", "r", "c")
        .agg(F.max(state).alias("s"))
        .select("table_id", "r", "c", "s.text", F.greatest(F.coalesce("s.rowspan", F.lit(1)), F.lit(1)).alias("rowspan"), F.greatest(F.coalesce("s.colspan", F.lit(1)), F.lit(1)).alias("colspan"))
    )


def _grid(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current cells, (table_id, ncols, head_r, r1) of each table, its head cells (table_id, c, text))."""
    latest = current_cells(cells)
    # One pass for width and head of each table: the rows per span are few.
    per_span = latest.groupBy("table_id", "colspan").agg(F.min("r").alias("r0"), F.max(F.col("r") + F.col("rowspan")).alias("r1"), F.max(F.col("c") + F.col("colspan")).alias("reach"))
    width = per_span.withColumn("ncols", F.max("reach").over(Window.partitionBy("table_id")))
    found = width.groupBy("table_id", "ncols").agg(F.min(F.when(_inner(), F.col("r0"))).alias("head_r"), F.max("r1").alias("r1")).where("head_r is not null")
    head = latest.join(found.select("table_id", "ncols", F.col("head_r").alias("r")), ["table_id", "r"]).where(_inner()).select("table_id", "c", "text")
    return latest, found, head


def _inner() -> Column:
    """Whether a cell is no caption or divider; a one-column table has no cell that is as wide as the table and yet a caption."""
    return (F.col("colspan") < F.col("ncols")) | (F.col("ncols") == 1)


def _entities(latest: DataFrame, found: DataFrame, head: DataFrame, fields: list[str], block_rows: int) -> DataFrame:
    """(table_id, r, cells) in order of entities; head: (table_id, c, h), whose `fields` each cell gets besides c, own_r and text."""
    block = lambda c: F.floor(F.col(c) / block_rows).cast("int")
    head = head.groupBy("table_id").agg(F.map_from_entries(F.collect_list(F.struct("c", "h"))).alias("head"))
    known = found.join(head, "table_id").select("table_id", "ncols", "head_r", "head", F.explode(F.sequence(block("head_r"), block("r1"))).alias("blk"))
    spread = latest.select("table_id", "c", "text", "colspan", F.col("r").alias("own_r"), F.explode(F.sequence(F.col("r"), F.col("r") + F.col("rowspan") - 1)).alias("r")).withColumn("blk", block("r"))
    placed = spread.join(known, ["table_id", "blk"]).where(_inner() & (F.col("own_r") > F.col("head_r"))).withColumn("h", F.try_element_at("head", F.col("c")))
    # The join's partitioning by table and block also serves the grouping by entity.
    entities = placed.groupBy("table_id", "blk", "r").agg(F.collect_list(F.struct("c", "own_r", *(f"h.{f}" for f in fields), "text")).alias("cells"))
    return entities.sortWithinPartitions("table_id", "r").select("table_id", "r", "cells")


def _more_name(attrs: list[tuple]) -> str:
    name = "more"
    while name in {"table_id", "r", *(a for a, *_ in attrs)}:
        name += "_"
    return name


def wide_rows(cells: DataFrame, catalog: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per (table_id, r) that is an entity, with one typed column per attr of the catalog.

    A last column `more` maps attr to text for the figures that their column's type can't hold (null for all other rows), so that no value is lost.

    Method: the head of each table maps its columns to attribute indices; cells are sorted by entity and streamed
    into sparse column builders with validity masks and typed buffers (decimal128, int64, bit-packed boolean, date32).

    Scale: rows travel keyed by (table_id, block of `block_rows` rows), so one very long table is spread over many
    tasks; what a table needs everywhere (its width, its head) is repeated once a block. Nothing is collected but the
    catalog, whose size is checked: beyond MAX_ATTRS attributes it raises, and `long_values` gives the values.

    Defined cases: cells with null table_id, r or c give nothing; null spans count as 1; several states of a cell:
    the latest loaded_at holds, a null one is the oldest; a cell as wide as the table is a caption or divider; the
    first other row is the head; a row whose filled cells all repeat the head is no entity; a cell with rowspan n
    gives its value to n rows, unless a row has a cell of its own there; of two columns for one attr the leftmost
    value holds; an entity without any value keeps its row; a text that states no value of its type is null, however long it is, and every
    word is a value of type text; an empty table gives no rows; extra columns are ignored.
    """
    attrs = catalog_rows(catalog)
    keys: dict[str, int] = {}
    for i, (_, _, unit, label, short) in enumerate(attrs):
        for text in (label, short):
            for k in head_keys(text, unit):
                keys.setdefault(k, i)

    @F.pandas_udf("struct<key:string,attr:int>")
    def head_of(text: pd.Series) -> pd.DataFrame:
        once = {}
        for t in text.unique():
            forms = head_forms(t)
            hit = next((k for k in forms if k in keys), None)
            once[t] = (hit or (forms[0] if forms else None), keys.get(hit) if hit else None)
        return pd.DataFrame({"key": [once[t][0] for t in text], "attr": pd.array([once[t][1] for t in text], dtype="Int32")})

    latest, found, head = _grid(cells)
    ordered = _entities(latest, found, head.select("table_id", "c", head_of("text").alias("h")), ["attr", "key"], block_rows)
    more = _more_name(attrs)
    schema = ", ".join(["table_id string", "r int", *(f"`{a}` {SPARK_TYPES.get(k, 'string')}" for a, k, *_ in attrs), f"`{more}` map<string,string>"])
    return ordered.mapInArrow(_builder([(a, k if k in SPARK_TYPES else "text", u) for a, k, u, *_ in attrs], more), schema)


def wide_values(wide: DataFrame, catalog: DataFrame) -> DataFrame:
    """The filled values of wide rows: (table_id, r, attr, val), val in the text form of its type."""
    attrs = catalog_rows(catalog)
    pair = "array<struct<attr:string,val:string>>"
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(f"`{a}`").cast("string").alias("val")) for a, *_ in attrs]).cast(pair)
    rest = F.coalesce(F.map_entries(F.col(f"`{_more_name(attrs)}`")).cast(pair), F.array().cast(pair))
    return wide.select("table_id", "r", F.explode(F.concat(F.filter(pairs, lambda p: p["val"].isNotNull()), rest)).alias("p")).select("table_id", "r", "p.attr", "p.val")


def long_values(cells: DataFrame, catalog: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of wide_values(wide_rows(...)), for catalogs of any size: (table_id, r, attr, val).

    The catalog is joined with the forms of the heads instead of being held on the driver, and no wide schema is built. Defined cases as in `wide_rows`;
    of several attributes with one printed form the smallest holds in both.
    """

    @F.pandas_udf("array<string>")
    def forms(text: pd.Series) -> pd.Series:
        return text.map(head_forms)

    @F.pandas_udf("array<string>")
    def labels(label: pd.Series, short: pd.Series, unit: pd.Series) -> pd.Series:
        return pd.Series([sorted(head_keys(a, u) | head_keys(b, u)) for a, b, u in zip(label, short, unit, strict=True)], dtype=object)

    kind = F.coalesce(F.lower(F.trim("data_type")), F.lit("text"))
    one = catalog.where("attr is not null").groupBy("attr").agg(F.max(F.struct("data_type", "unit", "label", "short_label")).alias("s")).select("attr", "s.*")
    attr = F.min(F.struct("attr", F.when(kind.isin(*SPARK_TYPES), kind).otherwise("text").alias("kind"), "unit"))
    known = one.select("*", F.explode(labels("label", "short_label", "unit")).alias("form")).groupBy("form").agg(attr.alias("a"))
    latest, found, head = _grid(cells)
    printed = head.select("table_id", "c", F.posexplode_outer(forms("text")).alias("pos", "form")).join(known, "form", "left")
    best = F.min(F.struct(F.col("a").isNull(), "pos", "form", "a"))
    heads = printed.groupBy("table_id", "c").agg(best.alias("b")).select("table_id", "c", F.struct("b.a.attr", "b.a.kind", "b.a.unit", F.col("b.form").alias("key")).alias("h"))
    ordered = _entities(latest, found, heads, ["attr", "kind", "unit", "key"], block_rows)
    return ordered.mapInArrow(_long_rows, "table_id string, r int, attr string, val string")
