"""The citation grammar on texts with known citations."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lexigrove.plans import grammar
from tests.test_whole import node, small  # noqa: F401

CASES = [
    ("See Table 9.10.2.4. and Figure A-1.2.3-B", [("cap_ref", "Table 9.10.2.4."), ("cap_ref", "Figure A-1.2.3-B")]),
    ("(See Note A-5.4.1.(2), below)", [("note", "Note A-5.4.1.(2")]),
    ("as SB-10 and SA-1 say, XSB-10 doesn't", [("supp", "SB-10"), ("supp", "SA-1")]),
    ("Form 1.2.3.-A is filed", [("form", "Form 1.2.3.-A")]),
    ("under C.A. B12 or C.A.F3", [("ca", "C.A. B12"), ("ca", "C.A.F3")]),
    ("to CAN/CSA-B44 or ASTM E84-10", [("std", "CAN/CSA-B44"), ("std", "ASTM E84-10")]),
    ("in Subsection 3.2.6. and Sentence 9.10.3.1.(2)(a) of Division B", [("code_ref", "3.2.6."), ("code_ref", "9.10.3.1.(2)(a)")]),
    ("under subsection 34(2.3) and clauses 8(1)(a.1)", [("act_ref", "subsection 34(2.3)"), ("act_ref", "clauses 8(1)(a.1)")]),
    ("by s. 15.1 of this Act, ss. 3", [("short", "s. 15.1"), ("short", "ss. 3")]),
    ("1.2.3 is cut short, 1.2.3A. is whole", [("code_ref", "1.2."), ("code_ref", "1.2.3A.")]),
    ("", []), (None, None), ("\x01Table 1.2\x02", [("cap_ref", "Table 1.2")]),
]


@pytest.mark.parametrize("text, want", CASES)
def test_alternatives_and_places(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(grammar.citations("t").alias("c")).first().c
    if want is None:
        assert got is None or got == []
        return
    assert [(c.kind, c.text) for c in got] == want
    assert all(text.replace("\x01", " ").replace("\x02", " ")[c.s : c.e] == c.text and c.tail == text.replace("\x02", " ")[c.e : c.e + 22] for c in got)


def test_first_alternative_wins_as_in_a_scan(spark):
    text = " ".join(t for t, _ in CASES if t) * 3
    rx = re.compile("|".join(f"(?P<{n}__>{p})" for n, p in grammar.ALTERNATIVES), re.ASCII)
    text = text.replace("\x01", " ").replace("\x02", " ")
    want = [(m.lastgroup.removesuffix("__"), m.start(), m.end()) for m in rx.finditer(text)]
    got = spark.createDataFrame([(text,)], "t string").select(F.explode(grammar.citations("t")).alias("c")).select("c.*").collect()
    assert [(r.kind, r.s, r.e) for r in got] == want


def test_context(spark, small):  # noqa: F811
    bodies = ["By Article 3.1.1. of Division C it is so.", "ABC1.2.3. is a name.", "Sentence 1.1.1.(1) of the Planning Act applies.", "See section 4 of the Building Code Act.", "By s. 7 of this Act, s. 8 repealed."]
    d = small(node=[node(i, f"n{i}", "sentence", body=b) for i, b in enumerate(bodies)])
    docs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "doc_id bigint, text string")
    docs.write.parquet(f"{d}/documents.parquet")
    got = {(r.owner, r.text): (r.division, r.this_act, r.skipped) for r in grammar.cited(grammar.chunks(spark, d)).collect()}
    assert got == {
        ("n0", "3.1.1."): ("C", False, None), ("n1", "1.2.3."): (None, False, "part of a designation"), ("n2", "1.1.1.(1)"): (None, False, "another statute"),
        ("n3", "section 4"): (None, False, "another statute"), ("n4", "s. 7"): (None, True, None), ("n4", "s. 8"): (None, False, "amending statute"),
    }
    assert {(r.kind, r.outcome): r.n for r in grammar.citation_skip_reasons(spark, d).collect()}[("short", "kept")] == 2
    assert {(r.owner, r.division) for r in grammar.division_qualifier(spark, d).where("division is not null").collect()} == {("0", "C")}


def test_parts(spark, small):  # noqa: F811
    d = small(node=[node(1, "a", "sentence", heading="See Note A-1.2.", body="9.10.3.1.(2)(a) and subsection 34(2.3)(b.1)")], cell=[{"table_id": "t", "r": 3, "c": 1, "text": "Table 1.2.3."}])
    got = {(r.chunk, r.text): (r.number, r.sentence, r.clause) for r in grammar.extract_citations(spark, d).collect()}
    assert got == {("h", "Note A-1.2."): ("1.2", None, None), ("*", "9.10.3.1.(2)(a)"): ("9.10.3.1", "2", "a"), ("*", "subsection 34(2.3)(b.1)"): ("34", "2.3", "b.1"), ("g3.1", "Table 1.2.3."): ("1.2.3", None, None)}
