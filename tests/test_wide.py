from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from lexigrove.operators.wide import head_forms, head_keys, long_values, parse_value, wide_rows, wide_values

T = [dt.datetime(2024, 1, d) for d in range(1, 9)]
CATALOG = [("width", "Width", "Wd.", "integer", "mm"), ("load", "Design load", "Load", "decimal", "kPa"), ("comb", "Combustible", "Comb.", "boolean", None), ("eff", "Effective date", "Eff.", "date", None), ("mat", "Material", "Mat.", "text", None)]


def catalog(spark, rows=CATALOG):
    return spark.createDataFrame(rows, "attr string, label string, short_label string, data_type string, unit string")


def cells(spark, rows):
    full = [(t, r, c, rs, cs, x, at, "k", 1) for t, r, c, rs, cs, x, at in rows]
    return spark.createDataFrame(full, "table_id string, r int, c int, rowspan int, colspan int, text string, loaded_at timestamp, attr string, blk int")


def values(spark, rows, **kw):
    cat = catalog(spark)
    got = {tuple(r) for r in wide_values(wide_rows(cells(spark, rows), cat, **kw), cat).collect()}
    assert got == {tuple(r) for r in long_values(cells(spark, rows), cat, **kw).collect()}
    return got


def grid(t, lines, at=T[0]):
    return [(t, r, c, 1, 1, x, at) for r, line in enumerate(lines) for c, x in enumerate(line)]


@pytest.mark.parametrize("text, kind, unit, want", [
    ("1,247 (8)", "integer", "mm", 1247), ("9 799", "integer", "mm", 9799), ("7,950mm", "integer", "mm", 7950), ("3 909persons", "integer", "persons", 3909), ("1 469 mm", "integer", "mm", 1469),
    ("12,34", "integer", None, None), ("437½", "integer", "mm", None), ("\t− 5\n", "integer", None, -5), ("TBD", "integer", None, None), ("10,1000", "integer", None, None),
    ("437½", "decimal", "mm", Decimal("437.50")), ("20 ½", "decimal", "mm", Decimal("20.50")), ("3¼ kPa", "decimal", "kPa", Decimal("3.25")), ("– 43.71 °C", "decimal", "°C", Decimal("-43.71")), ("14,65", "decimal", "m", Decimal("14.65")),
    ("8", "decimal", "m", Decimal("8.00")), ("287.", "decimal", "mm", Decimal("287.00")), ("4.55 m2K/W", "decimal", "m2K/W", Decimal("4.55")), ("1 234.5", "decimal", None, None), ("9.86 (7)", "decimal", None, Decimal("9.86")), ("–", "decimal", None, None),
    ("Not permitted", "boolean", None, False), (" YES\n", "boolean", None, True), ("Required", "boolean", None, True), ("maybe", "boolean", None, None),
    ("8 Jun. 2009", "date", None, dt.date(2009, 6, 8)), ("MARCH 16, 2015", "date", None, dt.date(2015, 3, 16)), ("2001/08/07", "date", None, dt.date(2001, 8, 7)), ("2001-13-07", "date", None, None), ("31 April 2001", "date", None, None),
    ("Group  D", "text", None, "Group D"), ("n/a", "text", None, None), ("——", "text", None, None), ("", "text", None, None), (None, "text", None, None),
])
def test_values(text, kind, unit, want):
    assert parse_value(text, kind, unit) == want


@pytest.mark.parametrize("text", ["WIDTH, mm", "Width (mm) (3)", "width\nmm", "Wd.:", " Wd.  (mm) ", "Width (2)", "Wd. (mm):"])
def test_heads(text):
    assert set(head_forms(text)) & (head_keys("Width", "mm") | head_keys("Wd.", "mm"))


def test_other_heads_stay_out():
    assert not set(head_forms("see width")) & head_keys("Width", "mm")


def test_table_with_everything(spark):
    rows = grid("t", [["Item", "Width (mm)", "Load, kPa", "Comb.", "Eff.", "Mat."], ["x", "1,200", "2,5", "no", "1 May 2020", " steel\nstud "], ["y", "n/a", "-", "varies", "", None]])
    rows += [("t", 3, 0, 1, 6, "Group A", T[0])]  # divider
    rows += grid("t", [[]] * 4 + [["item", "WIDTH (mm)", "Load, kPa (1)", "Comb.", "Eff.", "Mat."]])  # the head again
    rows += [("t", 5, 1, 2, 1, "7", T[0]), ("t", 5, 0, 1, 1, "z", T[0]), ("t", 6, 0, 1, 1, "zz", T[0]), ("t", 6, 2, 1, 1, "1.00", T[0])]
    rows += [("t", 1, 1, 1, 1, "900", T[1]), ("t", 1, 1, 1, 1, "800", T[0]), ("t", 1, 1, 1, 1, "900", T[1])]  # corrected, repeated
    want = {("t", 1, "width", "900"), ("t", 1, "load", "2.50"), ("t", 1, "comb", "false"), ("t", 1, "eff", "2020-05-01"), ("t", 1, "mat", "steel stud"), ("t", 5, "width", "7"), ("t", 6, "width", "7"), ("t", 6, "load", "1.00")}
    assert values(spark, rows) == want
    assert values(spark, rows, block_rows=2) == want


def test_caption_before_head_and_two_columns_of_one_attr(spark):
    rows = [("t", 0, 0, 1, 3, "Table 1", T[0])] + grid("t", [[], ["Item", "Width", "Wd."], ["a", "", "5"], ["b", "3", "4"]])
    assert values(spark, rows) == {("t", 2, "width", "5"), ("t", 3, "width", "3")}


def test_entity_without_values_keeps_its_row(spark):
    wide = wide_rows(cells(spark, grid("t", [["Item", "Width"], ["a", "-"]])), catalog(spark)).collect()
    assert [(r.table_id, r.r, r.width, r.load, r.mat) for r in wide] == [("t", 1, None, None, None)]


def test_nulls_and_empty(spark):
    assert values(spark, []) == set()
    assert values(spark, [(None, 1, 1, 1, 1, "x", T[0]), ("t", None, 1, 1, 1, "x", T[0]), ("t", 1, None, 1, 1, "x", T[0])]) == set()
    assert values(spark, [("t", 0, 0, None, None, "Item", None), ("t", 0, 1, None, None, "Width", None), ("t", 1, 1, None, None, "4", None), ("t", 1, 1, 1, 1, "5", T[0])]) == {("t", 1, "width", "5")}


def test_long_table_over_many_blocks_and_batches(spark):
    lines = [["Item", "Width", "Mat."]] + [[f"i{k}", str(k), f"m{k}"] for k in range(1, 9_001)]
    got = values(spark, grid("long", lines) + grid("short", lines[:3]), block_rows=512)
    assert got == {("long", k, "width", str(k)) for k in range(1, 9_001)} | {("long", k, "mat", f"m{k}") for k in range(1, 9_001)} | {("short", k, a, v) for k in (1, 2) for a, v in (("width", str(k)), ("mat", f"m{k}"))}


def test_typed_columns(spark):
    kinds = dict(wide_rows(cells(spark, []), catalog(spark)).dtypes)
    assert kinds == {"table_id": "string", "r": "int", "width": "bigint", "load": "decimal(20,2)", "comb": "boolean", "eff": "date", "mat": "string", "more": "map<string,string>"}


def test_very_long_texts(spark):
    long = "1" * 200_000
    rows = grid("t", [["Item", "Width", "Mat.", "Load"], ["a", long, "x " * 100_000, " " * 200_000], ["b", "(1)" * 50_000, "y", "- " * 100_000]])
    assert values(spark, rows) == {("t", 1, "width", long), ("t", 1, "mat", "x " * 99_999 + "x"), ("t", 2, "mat", "y")}


def test_words_are_values_of_type_text(spark):
    words = ["Varies", "TBD", "NP", "By test", "None stated"]
    got = values(spark, grid("t", [["Item", "Mat.", "Width"], *[[f"i{k}", w, w] for k, w in enumerate(words)]]))
    assert got == {("t", k + 1, "mat", w) for k, w in enumerate(words)}


@pytest.mark.parametrize("attr, text, want", [
    ("Width", "9223372036854775807", "9223372036854775807"), ("Width", "-9,223,372,036,854,775,808 mm", "-9223372036854775808"), ("Width", "9223372036854775808", "9223372036854775808"), ("Width", "-" + "7" * 201 + " (2)", "-" + "7" * 201),
    ("Load", "123456789012345678,5 kPa", "123456789012345678.50"), ("Load", "-999999999999999999.994", "-999999999999999999.99"), ("Load", "1000000000000000000", "1000000000000000000.00"), ("Load", "3" * 5_000 + ".125", "3" * 5_000 + ".13"),
])
def test_large_figures_are_kept(spark, attr, text, want):
    assert {v for *_, v in values(spark, grid("t", [["Item", attr], ["a", text]]))} == {want}


def test_long_head(spark):
    assert values(spark, grid("t", [["Item", "Width" + " (2)" * 60 + " *"], ["a", "5"]])) == {("t", 1, "width", "5")}


def test_catalog_beyond_the_bound(spark):
    rows = [(f"a{k}", f"Label {k}", None, "integer", None) for k in range(4_001)]
    c = cells(spark, grid("t", [["Item", "label 4000"], ["a", "5"]]))
    with pytest.raises(ValueError, match="long_values"):
        wide_rows(c, catalog(spark, rows))
    assert [tuple(r) for r in long_values(c, catalog(spark, rows)).collect()] == [("t", 1, "a4000", "5")]
