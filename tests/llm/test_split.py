from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigrove.llm.split import boundaries, items, longest_stretch, pieces, split_items


def check(text, limit=1000, overlap=100):
    got = pieces(text, limit, overlap)
    if not text:
        assert got == []
        return got
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(0 < b - a <= limit for a, b in got)
    assert all(c == b - overlap for (_, b), (c, _) in zip(got, got[1:], strict=False))
    core = text[: got[0][1]] + "".join(text[a + overlap : b] for a, b in got[1:])
    assert core == text
    return got


def test_short_and_exact():
    assert check("") == [] and check("abc") == [(0, 3)] and check("x" * 1000) == [(0, 1000)]
    assert len(check("x" * 1001)) == 2


def test_natural_boundaries_are_used():
    text = " ".join(f"Sentence number {i} is about this long." for i in range(120))
    got = check(text)
    ends = {p for p, _ in boundaries(text)}
    assert all(b in ends for _, b in got[:-1])
    assert longest_stretch(text, boundaries(text)) < 60


def test_line_breaks_win_over_marks():
    text = ("word. " * 80 + "\n") + ("word. " * 100)
    assert check(text)[0][1] == 481


def test_forced():
    text = "a short one. " + "x" * 1500 + ". the end."
    check(text)
    assert longest_stretch(text, boundaries(text)) > 1000


def test_decimal_points_are_no_boundaries():
    assert boundaries("3.2.1 is 2.4 m") == [] and [p for p, _ in boundaries("a. b; c\nd? e")] == [2, 5, 8, 10]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .;\n\t!?:é日", max_size=400), st.integers(20, 60), st.integers(0, 19))
def test_any_text(text, limit, overlap):
    check(text, limit, overlap)


def test_very_long():
    random.seed(1)
    text = "".join(random.choice(["word ", "end. ", "\n", "x" * 40]) for _ in range(60_000))
    check(text)
    check("y" * 300_000)


def test_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        pieces("x" * 50, 10, 10)


def test_items_and_rows(spark):
    body = "One sentence here. " * 70
    nodes = [("a", "Head", body), ("a", "Head", body), ("b", "  \t", "y" * 1200), ("c", None, "short"), ("d", "h", None), ("e", "h", ""), (None, "h", body), ("f", "H" * 500, "b" * 500), ("g", "H" * 500, "b" * 499), ("h", "x", "z" * 2000), ("h", "x", body)]
    df = spark.createDataFrame([(*n, "clash", 1) for n in nodes], "id string, heading string, body string, piece string, seq int")
    rows = split_items(items(df)).collect()
    how = {(r.node_id, r.how) for r in rows}
    assert how == {("a", "boundary"), ("b", "forced"), ("f", "boundary"), ("h", "forced"), ("h", "boundary")}
    a = sorted((r.seq, r.first, r.last, r.piece) for r in rows if r.node_id == "a")
    text = "Head\n" + body
    assert [(f, e) for _, f, e, _ in a] == pieces(text) and all(p == text[f:e] for _, f, e, p in a)
    assert split_items(items(df.where("false"))).collect() == []
