"""Ratio gates must fail when what they measure is broken; results don't depend on the order of rows; scans are pruned."""

from __future__ import annotations

import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove import api
from lexigrove.functions.vectors import dot, encoder
from lexigrove.plans.aggregates import R as aggregates
from lexigrove.plans.graph import R as graph
from lexigrove.plans.views import nodes
from tests.util import rows


@pytest.fixture
def spoiled(spark, data, tmp_path):
    """A copy of the tables in which one column of one table is changed."""

    def make(table: str, **columns) -> str:
        for p in Path(data).glob("*.parquet"):
            if p.name != f"{table}.parquet":
                (tmp_path / p.name).symlink_to(p)
        target = tmp_path / f"{table}.parquet"
        shutil.rmtree(target, ignore_errors=True)
        spark.read.parquet(f"{data}/{table}.parquet").withColumns(columns).repartition(3, "loaded_at").write.parquet(str(target))
        return str(tmp_path)

    return make


def passed(spark, folder):
    return {r.gate: r.passed for r in aggregates.queries["gate_summary"](spark, folder).collect()}


@pytest.mark.parametrize("table, column, value, gate", [
    ("ref", "dst", F.lit, "refs resolved"), ("ref", "kind", F.lit, "refs with a kind"), ("node", "modality", F.lit, "leaves with modality"), ("node", "heading", F.lit, "articles with heading"),
])
def test_gate_fails_when_broken(spark, data, spoiled, table, column, value, gate):
    before = passed(spark, data)
    after = passed(spark, spoiled(table, **{column: value(None).cast("string")}))
    assert not after[gate]
    assert {g: p for g, p in after.items() if g != gate and p != before[g]} == {}


def test_order_of_rows_does_not_matter(spark, data, spoiled):
    folder = spoiled("node")
    for name in ("content_digest", "facts"):
        assert rows(aggregates.queries[name](spark, data)) == rows(aggregates.queries[name](spark, folder))


def test_a_lost_link_shows_in_the_tree(spark, data, spoiled):
    walk = graph.queries["mr_closure"]
    whole, cut = walk(spark, data).first(), walk(spark, spoiled("node", parent=F.lit(None).cast("string"))).first()
    assert whole.pairs == whole.walked and cut.pairs == cut.walked < whole.pairs


def test_scans_are_pruned_and_filters_pushed(spark, data, capsys):
    graph.queries["unresolved_refs"](spark, data).explain("formatted")
    plan = capsys.readouterr().out
    assert "bbox" not in plan and "seen_at" not in plan.split("ReadSchema")[1].split("\n")[0]
    spark.read.parquet(f"{data}/evalset.parquet").where("qid = 3").select("q").explain("formatted")
    assert "EqualTo(qid,3)" in capsys.readouterr().out


def test_tools(spark, data):
    leaves = graph.queries["get_provision"](spark, data).select(F.col("anchor").alias("key"))
    article = nodes(spark, data).where("node_type = 'article' and up is not null").join(leaves, "key", "left_semi").orderBy("rid").first().key
    assert api.call(spark, data, "get_provision", anchor=f" {article.upper()}").count() > 0
    assert api.call(spark, data, "get_context", anchor=article).first().markdown.startswith("[anchor]")
    assert api.call(spark, data, "neighbors", anchor=article).where("rel = 'parent'").count() == 1
    hits = api.call(spark, data, "search", query="fire separation of the floor assembly", limit=5, mode="nodes").collect()
    assert [h["rank"] for h in hits] == list(range(1, len(hits) + 1))
    assert api.call(spark, data, "capabilities").count() == 7 and api.call(spark, data, "what_cites", anchor="nowhere").count() == 0
    with pytest.raises(KeyError):
        api.call(spark, data, "nothing")


def test_encoder(spark):
    lengths = encoder(lambda texts: np.array([[len(t), 1.0] for t in texts]), batch=2)
    df = spark.createDataFrame([("abc",), (None,), ("",), ("abcdefgh",)], "t string").withColumn("v", lengths("t"))
    got = df.withColumn("n", dot("v", "v")).collect()
    assert [r.v is None for r in got] == [False, True, False, False] and all(abs(r.n - 1) < 1e-5 for r in got if r.v is not None)
    assert abs(got[0].v[0] / got[0].v[1] - 3) < 1e-5
