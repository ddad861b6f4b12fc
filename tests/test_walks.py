"""The walks as state machines on lines with known trees."""

from __future__ import annotations

import random

from lexigrove.operators import walks
from tests.util import rows


def lines(*markers, **first):
    """Lines of a volume; a line is a marker or (marker, indent)."""
    out = []
    for i, m in enumerate(markers):
        marker, x0 = m if isinstance(m, tuple) else (m, 36.0)
        out.append({"key": i, "volume_key": "v1", "marker": marker, "x0": x0, "opens": False, "region": False, "label": None, "prefix": None} | (first if i == 0 else {}))
    return out


def derived(*markers):
    return [r["derived"] and r["derived"].removeprefix("v1/b/9/9.1.1.1") for r in walks.division_walk(iter(lines("B.", "9.", "9.1.", "9.1.1.", "9.1.1.1.", *markers)))][5:]


def test_heads():
    got = [(r["level"], r["derived"]) for r in walks.division_walk(iter(lines("B.", "9.", "9.1.", "9.1.1.", "9.1.1.1.", "9.1.1.1A.", "8.1.1.1.", "10.", "10.2.3.4.")))]
    assert got == [("root", "v1/b"), ("part", "v1/b/9"), ("section", "v1/b/9/9.1"), ("subsection", "v1/b/9/9.1.1"), ("article", "v1/b/9/9.1.1.1"), ("article", "v1/b/9/9.1.1.1A"), (None, None), ("part", "v1/b/10"), ("article", "v1/b/10/10.2.3.4")]


def test_sentences_must_be_next_or_a_decimal_insertion():
    assert derived("(1)", "(2)", "(2.1)", "(5)", "(3)", "(1)") == ["/(1)", "/(2)", "/(2.1)", None, "/(3)", None]


def test_i_is_a_clause_only_where_the_letter_is_due():
    letters = [f"({chr(97 + k)})" for k in range(8)]
    # after (h) the letter i is due, so (i) at the same indent is a clause
    assert derived("(1)", *letters, "(i)")[-1] == "/(1)/(i)"
    # after (a) a roman one is due
    assert derived("(1)", "(a)", "(i)", "(ii)", "(b)", "(i)") == ["/(1)", "/(1)/(a)", "/(1)/(a)/(i)", "/(1)/(a)/(ii)", "/(1)/(b)", "/(1)/(b)/(i)"]
    # both are due: the indent decides
    assert derived("(1)", *letters, ("(i)", 66.0))[-1] == "/(1)/(h)/(i)"


def test_decimal_clause_is_no_clause_when_deeper():
    assert derived("(1)", "(a)", "(a.1)", ("(a.2)", 66.0), "(b)") == ["/(1)", "/(1)/(a)", "/(1)/(a.1)", None, "/(1)/(b)"]


def test_lists_begin_anew():
    assert derived("(1)", "(a)", "(b)", "(2)", "(a)", "(c)", "(b)") == ["/(1)", "/(1)/(a)", "/(1)/(b)", "/(2)", "/(2)/(a)", None, "/(2)/(b)"]
    assert derived("(a)", "(1)", "(i)") == [None, "/(1)", None]


def test_text_belongs_to_the_open_node():
    rows_ = list(walks.division_walk(iter([*lines("B.", "9.", "9.1.1.1."), *[dict(lines("9.1.1.1.")[0], region=True, key=9)], *lines("(1)", None)])))
    assert rows_[3]["host"] == "v1/b/9/9.1.1.1" and rows_[5]["host"] == "v1/b/9/9.1.1.1/(1)"


def test_acts_labels_and_other_roots():
    act = lines("", "1.", "(1)", "(2)", "2.1.", "(1)", "(a)", opens=True, prefix="", key="v1/act")
    for i, label in ((1, "First"), (3, "Waits"), (4, "Second")):
        act[i]["label"] = label
    got = [(r["derived"], r["heading"]) for r in walks.rooted_walk(iter(act))]
    assert got == [("v1/act", None), ("v1/act/1", "First"), ("v1/act/1/(1)", None), ("v1/act/1/(2)", "Waits"), ("v1/act/2.1", "Second"), ("v1/act/2.1/(1)", None), ("v1/act/2.1/(1)/(a)", None)]
    notes = lines("", "3.1.2.", "(1)", opens=True, prefix="a-", key="v1/appa")
    assert [r["derived"] for r in walks.rooted_walk(iter(notes))] == ["v1/appa", "v1/appa/a-3.1.2", "v1/appa/a-3.1.2/(1)"]
    assert [r["derived"] for r in walks.rooted_walk(iter(lines("", "1.", opens=True, key="v1/b")))] == [None, None]


def test_index():
    rows_ = [{"key": "r", "opens": True, "level": 0}] + [{"key": i, "opens": False, "level": lv} for i, lv in enumerate([2, 1, 1, 2, 0, 1])]
    assert [r["derived"] for r in walks.index_walk(iter(rows_))] == ["r/e1", "r/e1/s2", "r/e1/s3", "r/e1/s3/s4", "r/e5", "r/e5/s6"]


def test_fold_streams_groups_in_order(spark):
    random.seed(3)
    data = [(g, i, v) for g in range(9) for i, v in enumerate(random.choices(["1", "2", "3", "1.1"], k=30))]
    random.shuffle(data)
    df = spark.createDataFrame(data, "g int, i int, number string").repartition(5)
    got = rows(walks.ordered_fold(df, "g", ["i"], walks.accepted_markers, "g int, i int, number string, expected int, ok boolean"))
    assert got == sorted((tuple(r.values()) for g in range(9) for r in walks.accepted_markers({"g": g, "i": i, "number": v} for _, i, v in sorted(x for x in data if x[0] == g))), key=repr)
    assert rows(walks.ordered_fold(df.where("false"), "g", ["i"], walks.accepted_markers, "g int, i int, number string, expected int, ok boolean")) == []
