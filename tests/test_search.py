"""Hybrid search, anchors and tools on small tables, and the promise of the fused list on the test tables."""

from __future__ import annotations

import json

import pytest

from lexigrove import api
from lexigrove.functions.vectors import HashedWords
from lexigrove.operators import retrieval as op
from lexigrove.plans import search
from tests.test_whole import closure, node, small  # noqa: F401
from tests.util import rows


@pytest.fixture()
def corpus(small):  # noqa: F811
    return small(
        node=[
            node(1, "V1/B/9/9.1.1.1", "article", designator="9.1.1.1.", heading="Guard height", body="Guards shall be high."),
            node(2, "V2/B/9/9.1.1.1", "article", designator="9.1.1.1.", heading="Roof anchors", body="Anchors on roofs hold ropes.") | {"volume": 2},
            node(3, "V1/INDEX/e1", "index_entry", heading="Guard height"),
            node(4, "V1/B/9/9.2", "section", designator="9.2.", body="The guard height of a deck."),
        ],
        closure=closure(("v1/b/9/9.1.1.1", "v1/b/9/9.1.1.1", 0), ("v2/b/9/9.1.1.1", "v2/b/9/9.1.1.1", 0)),
    )


def test_anchor_tiers(spark, corpus):
    of = lambda a: [(r.tier, r.key) for r in api.resolve(spark, corpus, a).collect()]
    assert of(" v2/B/9/9.1.1.1 ") == [(1, "v2/b/9/9.1.1.1")]
    assert of("9.1.1.1") == of("9.1.1.1..") == [(2, "v1/b/9/9.1.1.1"), (2, "v2/b/9/9.1.1.1")]
    assert of("guard HEIGHT") == [(3, "v1/b/9/9.1.1.1"), (3, "v1/b/9/9.2"), (3, "v1/index/e1")]
    assert of("9.2") == [(2, "v1/b/9/9.2")] and of("B/9/9.1") == [(4, "v1/b/9/9.1.1.1"), (4, "v2/b/9/9.1.1.1")]
    assert of("nothing here") == of("   ") == []


@pytest.mark.parametrize("mode", ["fts", "vec", "rrf", "fuse"])
def test_search_modes(spark, corpus, mode):
    assert [r.id for r in api.search(spark, corpus, "roof anchors", 1, mode).collect()] == ["V2/B/9/9.1.1.1"]


def test_search_of_nodes_and_unknown_mode(spark, corpus):
    assert {r.node_type for r in api.search(spark, corpus, "guard height", mode="nodes").collect()} == {"article", "index_entry", "section"}
    with pytest.raises(ValueError, match="mode"):
        api.search(spark, corpus, "x", mode="other")


@pytest.mark.parametrize("n", [1, 4, 5])
def test_fused_list_holds_the_top_half_of_each(spark, data, n):
    q = search.questions(spark, data)
    ids = lambda df: {(r.qid, r.id) for r in df.collect()}
    fused = ids(search.hybrid(spark, data, q, n))
    half = -(-n // 2)
    assert len(fused) <= n * q.select("qid").distinct().count()
    both = [ids(search.hybrid(spark, data, q, half, m)) for m in ("vec", "fts")]
    assert both[0] <= fused and (n % 2 or both[1] <= fused)


def test_encoder_can_be_replaced(spark, corpus):
    q = spark.createDataFrame([(1, "anything")], "qid bigint, text string")
    likes = lambda word: lambda texts: [[1.0 if word in t or t == "anything" else 0.0, 1.0] for t in texts]
    assert rows(search.by_vectors(spark, corpus, q, 1, likes("Roof")).select("id")) == [("v2/b/9/9.1.1.1",)]
    assert HashedWords(8).encode(["", "one two one"]).tolist()[0] == [0.0] * 8


def test_phrase_and_substring_hits(spark):
    docs = spark.createDataFrame([(1, "a b c a b", False), (2, "b a", False), (3, "ab c", True), (4, None, False)], "doc bigint, text string, demoted boolean")
    q = spark.createDataFrame([(1, "A b"), (2, "z"), (3, "!"), (4, None), (5, "a b c")], "qid bigint, text string")
    assert rows(op.phrase_hits(docs, q).select("qid", "doc", "tf")) == [(1, 1, 2), (5, 1, 1)]
    assert rows(op.substring_hits(docs.select("doc", "text"), q)) == [(5, 1)]


def test_tools_describe_themselves(spark, corpus):
    tools = {t["name"]: t["input_schema"] for t in json.loads(json.dumps(api.schemas()))}
    assert set(tools) == set(api.TOOLS) and tools["get_context"]["required"] == ["anchor"] and tools["search"]["properties"]["limit"] == {"type": "integer", "default": 10}
    assert api.call(spark, corpus, "resolve", anchor="9.2").count() == 1
    for wrong in ({}, {"anchor": "a", "colour": "red"}):
        with pytest.raises(TypeError):
            api.call(spark, corpus, "resolve", **wrong)
