from __future__ import annotations

import datetime as dt
import random

import pytest

from lexigrove.operators.orphans import ForeignKey, orphan_report, orphans

T = [dt.datetime(2024, 1, d) for d in range(1, 20)]
KEYS = [
    ForeignKey("node", "parent", "node", record="rid", at=None, child_id="id"),
    ForeignKey("ref", "src", "node", record="ref_id", at="seen_at", blank_is_orphan=True),
    ForeignKey("ref", "dst", "definition", record="ref_id", at="seen_at", where="kind = 'term'"),
    ForeignKey("ref", "dst", "node", record="ref_id", at="seen_at", where="coalesce(kind, '') <> 'term'"),
]


def tables(spark, node, ref, definition=()):
    state = "rid bigint, id string, parent string, loaded_at timestamp, deleted_at timestamp, own string, round int"
    return {
        "node": spark.createDataFrame([(*n, "x", 7) for n in node], state),
        "ref": spark.createDataFrame([(*r, "x") for r in ref], "ref_id bigint, src string, dst string, kind string, seen_at timestamp, how string"),
        "definition": spark.createDataFrame([(*x, 1) for x in definition], "id string, loaded_at timestamp, deleted_at timestamp, key int"),
    }


def found(spark, *args, **kw):
    return {(r.table, r.record, r.field): (r.how, r.round) for r in orphans(tables(spark, *args), KEYS, **kw).collect()}


def test_lives(spark):
    node = [(1, "A", None, T[3], T[6]), (2, "a ", None, T[8], None), (3, "B", None, T[0], None), (3, "B", None, T[0], None)]
    ref = [(i, "b", "A", "code", t) for i, t in ((1, T[2]), (2, T[3]), (3, T[5]), (4, T[6]), (5, T[7]), (6, T[8]), (7, T[9]))]
    # born <= at, and a deletion at the very moment counts as deleted
    assert {k[1] for k in found(spark, node, ref)} == {"1", "4", "5"}


def test_kinds_blanks_nulls_and_repeats(spark):
    node = [(1, "a", None, T[0], None)]
    ref = [(1, "a", "DEF/x", "term", T[2]), (2, "a", "DEF/y", "term", T[2]), (3, "a", "DEF/x", None, T[2]), (4, "a", None, "code", T[2]), (5, "a", "  ", "code", T[2]), (6, None, None, "code", T[2]), (7, "a", "a", "code", None), (2, "a", "DEF/y", "term", T[2])]
    got = found(spark, node, ref, [("def/X", T[0], None)])
    assert set(got) == {("ref", "2", "dst"), ("ref", "3", "dst"), ("ref", "6", "src"), ("ref", "7", "src"), ("ref", "7", "dst")}


def test_cascade(spark):
    node = [(1, "a", "gone", T[0], None), (2, "b", "A", T[0], None), (3, "c", "b", T[0], None), (4, "r", None, T[0], None), (5, "k", "r", T[0], None), (6, "u", "v", T[0], None), (7, "v", "u", T[0], None)]
    got = found(spark, node, [(1, "c", "k", "code", T[2]), (2, "r", "zz", "code", T[2]), (3, "k", "r", "code", T[2])])
    assert got == {("node", "1", "parent"): ("direct", 0), ("node", "2", "parent"): ("inherited", 1), ("node", "3", "parent"): ("inherited", 2), ("ref", "1", "src"): ("inherited", 3), ("ref", "2", "dst"): ("direct", 0)}
    assert ("ref", "1", "src") not in found(spark, node, [(1, "c", "k", "code", T[2])], cascade=False)


def test_empty_tables(spark):
    assert found(spark, [], []) == {}
    assert set(found(spark, [], [(1, "a", "b", "code", T[0])])) == {("ref", "1", "src"), ("ref", "1", "dst")}


def test_report(spark):
    t = tables(spark, [(1, "a", None, T[0], None)], [(1, "a", "x", "code", T[2]), (2, "a", "y", "code", T[2])])
    assert [tuple(r) for r in orphan_report(orphans(t, KEYS)).collect()] == [("node", "2024-01", "direct", 2, 2)]


def test_very_long_ids(spark):
    long = "x/" * 100_000
    assert set(found(spark, [(1, long, None, T[0], None)], [(1, f" {long.upper()}\n", long + "y", "code", T[2])])) == {("ref", "1", "dst")}


def test_plan_does_not_grow_with_the_rounds(spark):
    def chain(n):
        node = [(i, f"n{i}", f"n{i - 1}" if i else "gone", T[0], None) for i in range(n)]
        return orphans(tables(spark, node, [(1, f"n{n - 1}", f"n{n - 1}", "code", T[2])]), KEYS)

    short, long = chain(4), chain(40)
    assert {r.round for r in long.collect()} == set(range(41))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(short) == size(long)


def test_too_many_rounds_raise(spark):
    node = [(i, f"n{i}", f"n{i - 1}" if i else "gone", T[0], None) for i in range(6)]
    with pytest.raises(RuntimeError, match="max_rounds"):
        orphans(tables(spark, node, []), KEYS, max_rounds=3)


def test_two_states_and_a_loop_below_an_orphan(spark):
    # b has a state under the orphan a and one under d, which is below b: a loop that hangs on an orphan.
    node = [(1, "a", "gone", T[0], None), (2, "b", "a", T[0], T[1]), (3, "b", "d", T[1], None), (4, "d", "b", T[0], None)]
    assert found(spark, node, []) == {("node", "1", "parent"): ("direct", 0), ("node", "2", "parent"): ("inherited", 1), ("node", "4", "parent"): ("inherited", 2), ("node", "3", "parent"): ("inherited", 3)}


def test_a_long_chain_takes_few_rounds(spark):
    def jobs(n):
        node = [(i, f"n{i}", f"n{i - 1}" if i else "gone", T[0], None) for i in range(n)]
        t = tables(spark, node, [])
        spark.sparkContext.setJobGroup(f"chain of {n}", "")
        orphans(t, KEYS)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"chain of {n}"))

    assert 0 < jobs(120) < 2 * jobs(12)


@pytest.mark.parametrize("states", [1.0, 1.2, 2.0])
def test_rounds_of_random_graphs(spark, states):
    rng = random.Random(f"orphans {states}")
    ids = [f"n{i}" for i in range(300)]
    own = ids + [rng.choice(ids) for _ in range(round(300 * (states - 1)))]
    up = lambda i: rng.choice(["gone", None, *ids[max(0, i - 3) : i] * 40, *ids[i : i + 3]]) if i % 50 else ("gone", None)[i // 50 % 2]
    node = [(rid, key, up(int(key[1:])), T[0], None) for rid, key in enumerate(own)]
    known, want = set(ids), {}
    level = {rid for rid, _, p, *_ in node if p is not None and p not in known}
    for n in range(len(node) + 1):
        want |= {rid: n for rid in level}
        keys = {node[rid][1] for rid in level} - {node[rid][1] for rid in want if want[rid] < n}
        level = {rid for rid, _, p, *_ in node if p in keys and rid not in want}
    got = {int(k[1]): r for k, (_, r) in found(spark, node, []).items()}
    assert got == want and max(want.values()) > 9
