"""Every query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.util import bag, spark_bag

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
NO_SQL = sorted(set(QUERIES) - set(ORACLE))


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_only_known_queries_lack_sql():
    core = {"index_tree", "pending_label", "tree_walk", "tree_walk_v2", "gap_cluster_start", "lattice_cells", "lnds_boundaries", "manifest_verify", "overlap_suppress", "p3_wide", "tokenize"}
    assert {n for n in NO_SQL if not n.startswith(("p1_", "p5_", "p6_", "p7_", "p8_"))} <= core


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in sorted(columns)]
    assert spark_bag(df) == bag([tuple(r[i] for i in order) for r in cursor.fetchall()])


@pytest.mark.parametrize("name", NO_SQL)
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns
    df.collect()


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
