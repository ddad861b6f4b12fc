from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexigrove.operators.hierarchy import closure_faults, closure_pairs, hierarchy
from tests.util import rows

NODE = "id string, parent string, ancestor string, key string"


def frame(spark, pairs):
    # ancestor and key clash with names that the operator uses itself
    return spark.createDataFrame([(i, p, "x", "y") for i, p in pairs], NODE)


def brute(pairs):
    norm = lambda x: x.strip().lower() if x and x.strip() else None
    keys = {norm(i) for i, _ in pairs} - {None}
    up = {}
    for i, p in pairs:
        i, p = norm(i), norm(p)
        if i and p in keys:
            up[i] = min(up.get(i, p), p)
    out = {}
    for k in keys:
        seen, x = [], k
        while x in up and up[x] not in seen and up[x] != k:
            x = up[x]
            seen.append(x)
        if x in up:
            on = up[x] == k
            out[k] = ("cycle" if on else "below", None)
        else:
            out[k] = ("tree", tuple(seen))
    return out


def found(spark, pairs):
    return {r.key: (r.state, tuple(r.path) if r.path is not None else None) for r in hierarchy(frame(spark, pairs)).collect()}


def test_chain_branch_and_spellings(spark):
    pairs = [("A", None), (" a/1 ", "A "), ("A/2", "a"), ("a/2/x", "A/2"), ("lost", "nowhere"), ("blank", "  "), (None, "a"), ("  ", "a"), ("A/2", "a"), ("A/2", "a")]
    assert found(spark, pairs) == brute(pairs)
    by = {r.key: r for r in hierarchy(frame(spark, pairs)).collect()}
    assert by["a/2/x"].depth == 2 and by["a/2/x"].root == "a" and by["lost"].root == "lost" and by["a"].depth == 0


def test_loops(spark):
    pairs = [("s", "s"), ("u", "s"), ("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("r", None), ("k", "r")]
    assert found(spark, pairs) == brute(pairs)
    assert {k for k, v in found(spark, pairs).items() if v[0] == "cycle"} == {"s", "a", "b", "c"}


def test_long_chain(spark):
    pairs = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(150)]
    got = found(spark, pairs)
    assert got["n149"] == ("tree", tuple(f"n{i}" for i in range(148, -1, -1)))


def test_empty(spark):
    assert hierarchy(frame(spark, [])).collect() == []
    assert closure_pairs(hierarchy(frame(spark, []))).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdefgh"), st.sampled_from([None, *"abcdefghz"])), max_size=10, unique_by=lambda t: t[0]))
def test_any_links(spark, pairs):
    assert found(spark, pairs) == brute(pairs)


@pytest.mark.parametrize("stored, want", [
    ([("a", "a", 0), ("b", "b", 0), ("A", "b ", 1)], []),
    ([("a", "a", 0), ("b", "b", 0)], [("missing", "a", "b")]),
    ([("a", "a", 0), ("b", "b", 0), ("a", "b", 2)], [("depth", "a", "b")]),
    ([("a", "a", 0), ("b", "b", 0), ("a", "b", 1), ("a", "b", 3)], [("depth", "a", "b")]),
    ([("a", "a", 0), ("b", "b", 0), ("a", "b", None)], [("depth", "a", "b")]),
    ([("a", "a", 0), ("b", "b", 0), ("a", "b", 1), ("Q", "b", 4), ("b", "a", 1), (None, "a", 1)], [("extra", "Q", "b"), ("extra", "b", "a")]),
])
def test_faults(spark, stored, want):
    closure = spark.createDataFrame(stored, "ancestor string, descendant string, depth int")
    assert rows(closure_faults(frame(spark, [("a", None), ("b", "a")]), closure)) == sorted(want, key=repr)


def test_faults_with_loop(spark):
    nodes = frame(spark, [("a", "b"), ("b", "a"), ("under", "a"), ("r", None)])
    closure = spark.createDataFrame([("r", "r", 0), ("a", "under", 1), ("b", "b", 0)], "ancestor string, descendant string, depth int")
    assert rows(closure_faults(nodes, closure)) == [("cycle", "a", "a"), ("cycle", "b", "b")]
