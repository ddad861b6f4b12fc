"""Queries over the graph and the tools on small tables with known results."""

from __future__ import annotations

import datetime

import pytest

from lexigrove import api
from lexigrove.operators import retrieval
from lexigrove.plans import bundle, graph, pipeline, texts
from tests.util import rows


@pytest.fixture()
def small(spark, data, tmp_path):
    """A function that writes tables with the columns of the test tables; what a row doesn't name is null."""

    def write(**tables):
        for name in ("node", "ref", "closure", "cell", "definition"):
            schema = spark.read.parquet(f"{data}/{name}.parquet").schema
            given = [tuple(r.get(c) for c in schema.names) for r in tables.get(name, [])]
            spark.createDataFrame(given, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def node(rid, id, node_type, parent=None, **more):
    return {"rid": rid, "id": id, "node_type": node_type, "parent": parent, "volume": 1, "page": 1} | more


def closure(*pairs):
    return [{"ancestor": a, "descendant": b, "depth": k} for a, b, k in pairs]


def test_project_body_cuts_only_owners_of_tables(spark, small):
    long = "word " * 200
    d = small(
        node=[node(1, "a", "article"), node(2, "a/(1)", "sentence", "a", body=long), node(3, "a/(2)", "sentence", "a", body=long), node(4, "t", "table", body=long)],
        closure=closure(("a", "a", 0), ("a", "a/(1)", 1), ("a", "a/(2)", 1), ("a/(1)", "a/(1)", 0), ("a/(2)", "a/(2)", 0)),
        ref=[{"ref_id": 1, "src": "a/(1)", "dst": "t", "kind": "cap_ref"}],
    )
    assert {r.key: len(r.body) for r in texts.project_body(spark, d).collect()} == {"a/(1)": 599, "a/(2)": 999, "t": 999}


def test_what_cites_looks_at_the_subtree(spark, small):
    d = small(
        node=[node(1, "a", "article"), node(2, "a/(1)", "sentence", "a"), node(3, "b", "article")],
        closure=closure(("a", "a", 0), ("a", "a/(1)", 1), ("a/(1)", "a/(1)", 0)),
        ref=[{"ref_id": i, "src": s, "dst": t, "kind": k} for i, (s, t, k) in enumerate([("b", "a/(1)", "code_ref"), ("b", "a", "code_ref"), ("c", "A/(1) ", "term"), ("b", "z", "note")])],
    )
    assert rows(api.what_cites(spark, d, " A").select("src", "kind")) == [("b", "code_ref"), ("c", "uses_term")]
    assert rows(graph.what_cites(spark, d)) == [("a", "b", "code_ref"), ("a", "c", "uses_term"), ("a/(1)", "b", "code_ref"), ("a/(1)", "c", "uses_term"), ("z", "b", "note")]


def test_bundle_has_all_sections_and_table_rows(spark, small):
    refs = [("cap_ref", "t", None), ("supp", "sb-2", "SB-2"), ("note", "x", None), ("code_ref", "b", None), ("term", "def", None), ("code_ref", None, "9.9.9")]
    d = small(
        node=[node(1, "s", "section", heading="Scope"), node(2, "a", "article", "s", heading="Art"), node(3, "a/(1)", "sentence", "a", body="As O. Reg. 88/21 requires."), node(4, "t", "table"), node(5, "sb-2", "supplementary_standard"), node(6, "x", "note", body="why"), node(7, "b", "article", heading="B")],
        closure=closure(("s", "s", 0), ("s", "a", 1), ("s", "a/(1)", 2), ("a", "a", 0), ("a", "a/(1)", 1), ("a/(1)", "a/(1)", 0)),
        ref=[{"ref_id": i, "src": "a/(1)", "dst": t, "kind": k, "text": x, "reason": None if t else "nowhere"} for i, (k, t, x) in enumerate(refs)] + [{"ref_id": 9, "src": "b", "dst": "a", "kind": "code_ref"}],
        cell=[{"table_id": "T", "r": i, "c": k, "text": f"{i}.{k}"} for i in range(20) for k in range(2)],
        definition=[{"id": "def", "term": "defined", "body": "meaning"}],
    )
    text = api.get_context(spark, d, "A").first().markdown
    shown = "\n".join(f"{i}.0 | {i}.1" for i in range(15)), "\n".join(f"{i}.0 | {i}.1" for i in range(15, 20))
    assert text == "\n".join(["[anchor] a Art", "[ancestors] s Scope", "[text] Art", "[text] As O. Reg. 88/21 requires.", "[terms] defined: meaning", "[cites] b B (cites): ", "[notes] x: why", "[tables] t", shown[0], f"[tables] {shown[1]}", "[standards] SB-2", "[amendments] a/(1): O. Reg. 88/21", "[cited_by] b B", '[unresolved] "9.9.9" (code_ref) - nowhere'])
    assert {r.section for r in bundle.context_bundle(spark, d).where("anchor = 'a'").collect()} == set(bundle.SECTIONS)
    least = api.get_context(spark, d, "A", budget=1).first().markdown
    assert "[cited_by]" not in least and "[cites]" not in least and shown[1] not in least and shown[0] in least and "[unresolved]" in least
    assert [tuple(r) for r in bundle.bundle_completeness(spark, d).collect()] == [(1, 0, 5, 5, 5, 1, 1)]
    assert "[cites]" not in api.get_context(spark, d, "A", hops=0).first().markdown


def test_hub_is_delivered_by_reference(spark, small):
    others = [node(100 + i, f"o{i}", "article", heading=f"O{i}") for i in range(51)]
    d = small(node=[node(1, "h", "article", heading="Hub"), *others], closure=closure(("h", "h", 0)), ref=[{"ref_id": i, "src": "h", "dst": f"o{i}", "kind": "code_ref"} for i in range(51)])
    assert api.get_context(spark, d, "h").first().markdown.split("\n") == ["[anchor] h Hub", "[anchor] delivered by reference: more than 50 dependencies", "[text] Hub"]


def test_bundle_marks_modality_and_caps_rows(spark, small):
    d = small(
        node=[node(1, "a", "article"), node(2, "a/(1)", "sentence", "a", body="It shall not burn."), node(3, "a/(2)", "sentence", "a", body="word " * 200), node(4, "t", "table", "a")],
        closure=closure(("a", "a", 0), ("a", "a/(1)", 1), ("a", "a/(2)", 1), ("a", "t", 1), ("a/(2)", "a/(2)", 0)),
        ref=[{"ref_id": 1, "src": "t", "dst": "a/(2)", "kind": "forms_part_of"}],
        cell=[{"table_id": "t", "r": i, "c": 0, "text": f"row{i}"} for i in range(30)],
    )
    text = api.get_context(spark, d, "a").first().markdown
    assert "[text] It shall not burn. [prohibition]" in text and "[further characters: the table below]" in text and "row24\n... 5 further rows" in text and "row25" not in text


def test_tools_take_any_node(spark, small):
    d = small(
        node=[node(1, "s", "section"), node(2, "n", "note", "s", body="text"), node(3, "x", "act_section"), node(4, "gone", "note", body="old", deleted_at=datetime.datetime(2024, 1, 1))],
        closure=closure(("s", "s", 0), ("s", "n", 1), ("n", "n", 0), ("gone", "gone", 0)),
        ref=[{"ref_id": 1, "src": "n", "dst": "x", "kind": "act_ref"}],
    )
    assert [rows(api.get_provision(spark, d, a).select("anchor", "body")) for a in ("S", "n", "gone")] == [[("s", "text")], [("n", "text")], []]
    assert rows(api.neighbors(spark, d, "n")) == [("n", "out", "x"), ("n", "parent", "s")] and rows(api.neighbors(spark, d, "x")) == [("x", "in", "n")]
    assert rows(graph.ancestors(spark, d)) == [("n", "n", 2), ("n", "s", 1), ("s", "s", 1)]
    assert rows(graph.subtree(spark, d).select("anchor", "key")) == [("n", "n"), ("s", "n"), ("s", "s")]
    assert rows(graph.dep_count(spark, d)) == [("n", 1), ("s", 1)] and rows(graph.hub_nodes(spark, d)) == []


def test_manifest_verify_remembers_the_files(spark, tmp_path):
    d = tmp_path / "tables"
    for name in ("node", "ref", "part", "cell"):
        spark.range(9).coalesce(1).write.parquet(str(d / f"{name}.parquet"))
    files = {p.parent.stem: p for p in d.glob("*/*.parquet")}
    assert {r.status for r in pipeline.manifest_verify(spark, str(d)).collect()} == {"ok"}
    files["node"].write_bytes(files["node"].read_bytes()[::-1])
    files["ref"].write_text("version https://git-lfs.github.com/spec/v1\nsize 9\n")
    files["part"].unlink()
    spark.range(9).coalesce(1).write.parquet(str(d / "new.parquet"))
    for crc in d.glob("*/.*.crc"):
        crc.unlink()
    got = {r.path.split(".")[0]: r.status for r in pipeline.manifest_verify(spark, str(d)).collect()}
    assert got == {"node": "digest", "ref": "stub", "part": "missing", "cell": "ok", "new": "undeclared"}


def test_knn_of_equal_vectors_takes_the_smallest_ids(spark):
    ids = [(i * 37) % 200 for i in range(200)]
    v = spark.createDataFrame([(i, [1.0, 0.0] if i % 4 else [0.5, 0.5]) for i in ids], "vec_id bigint, embedding array<float>")
    q = v.where("vec_id in (0, 1)")
    want = [i for i in range(200) if i % 4][:5]
    for parts in (1, 3):
        got = retrieval.knn(v.repartition(parts), q, "vec_id", "embedding", 5).orderBy("qid", "rank").collect()
        assert [r.id for r in got if r.qid == 1] == want and [r.id for r in got if r.qid == 0] == list(range(5))


def test_article_text_has_headings_designators_and_cells(spark, small):
    d = small(
        node=[node(1, "s", "section", designator="3.1.", heading="Scope"), node(2, "a", "article", "s", designator="3.1.1.", heading="Art"), node(3, "a/(1)", "sentence", "a", designator="(1)", body="word " * 200), node(4, "a/(2)", "sentence", "a", designator="(2)", body="Short.")]
        + [node(5, "t", "table"), node(6, "b", "article", body="x" * 2000)],
        closure=closure(("s", "a", 1), ("a", "a", 0), ("a", "a/(1)", 1), ("a", "a/(2)", 1), ("a/(1)", "a/(1)", 0), ("b", "b", 0)),
        ref=[{"ref_id": 1, "src": "a/(1)", "dst": "t", "kind": "cap_ref"}],
        cell=[{"table_id": "T", "r": r, "c": k, "text": x} for r, k, x in ((0, 0, "Span"), (0, 1, " "), (1, 0, "4.2 m"))],
    )
    body = ("word " * 120).strip()
    assert rows(texts.article_text(spark, d)) == [("a", f"3.1. Scope\n3.1.1. Art (1) {body} (2) Short. Span 4.2 m"), ("b", "x" * 1400)]
