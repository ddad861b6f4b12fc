"""Text functions and rule tables on literals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexigrove.functions import text as T
from lexigrove.functions.rules import MODALITY, MODALITY_RENDERED, first_match, line_role
from lexigrove.plans.aggregates import glob_pattern
from lexigrove.plans.graph import merged
from lexigrove.plans.views import nodes
from tests.test_whole import node, small  # noqa: F401
from tests.util import rows


def each(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_modality_rules(spark):
    texts = ["It shall\nnot burn", "It shall in no case burn", "They are not permitted", "It may not be", "It is required to be", "Doors are permitted", "It may be", "It need not be", "It is not required", "Except here", "It is", None]
    want = ["prohibition"] * 4 + ["obligation"] + ["permission"] * 2 + ["exemption"] * 3 + ["statement", None]
    assert each(spark, texts, first_match(F.col("t"), MODALITY, "statement")) == want
    rendered = ["obligation", "prohibition", "statement", "permission", "obligation", "permission", "permission", "exemption", "exemption", "exemption", "statement", None]
    assert each(spark, texts, first_match(F.col("t"), MODALITY_RENDERED, "statement")) == rendered


@pytest.mark.parametrize("font, x, text, want", [
    ("Arial-Black", 36, "9.1.2. Scope", "subsection"), ("Arial-Black", 36, "9.1.2.3. Scope", "article"), ("Arial-Black", 36, "9.1. Scope", "section"), ("Arial-Black", 36, "Marginal note", "label"), ("Arial-Black", 36, "9. Part", "text"),
    ("Arial-Bold", 36, "Section 4.1 Fire", "section"), ("Arial-Bold", 36, "Section 4.1 of the Act", "text"), ("Times-Bold", 36, "4.1 The owner", "act_section"), ("Times-Bold", 450, "4.1 The owner", "text"),
    ("Times", 36, "(2.1) It", "sentence"), ("Times", 36, "(a) it", "clause"), ("Times", 36, "(iv) it", "subclause"), ("Times", 36, "(i) it", "clause"), ("Times", 36, "it is", "text"), ("Times", 36, "", "text"),
])
def test_line_roles(spark, font, x, text, want):
    df = spark.createDataFrame([(font, float(x), text)], "f string, x double, t string")
    assert df.select(line_role(F.col("f"), F.col("x"), F.col("t"))).first()[0] == want


def test_designators_entities_links_and_efforts(spark):
    assert each(spark, ["4.1.7.6-.G", "4.1.7.6..-G", "4.1.7.6.-G", " 1.2.3. ", None], T.repaired_designator("t")) == ["4.1.7.6.-G", "4.1.7.6.-G", "4.1.7.6.-G", "1.2.3", None]
    assert each(spark, ["&lt;a&gt; &amp;amp; &eacute;&#39;", "", None], T.html_unescape("t")) == ["<a> &amp; é'", "", None]
    assert each(spark, ["see www.x.org/a, (http://y.org). Write to me@z.ca;", "none", None], T.links("t")) == [["https://www.x.org/a", "http://y.org", "mailto:me@z.ca"], [], None]
    assert each(spark, ["2 weeks", "3 Days", "4 weeks+", "soon", "1.5 weeks"], T.weeks("t")) == [2.0, 0.6, 4.0, 1.0, 1.5]


def test_globs():
    import re

    ok = lambda g, p: re.search(glob_pattern(g), p) is not None
    assert ok("a/*", "a/b") and not ok("a/*", "a/b/c") and ok("a/**", "a/b/c") and ok("a.?", "a.b") and not ok("a.b", "axb") and not ok("a/*", "xa/b")


def test_merge_fails_on_a_repeated_id(spark):
    one, two = spark.createDataFrame([("a", 1), ("b", 1)], "key string, v int"), spark.createDataFrame([(2, "b")], "v int, key string")
    assert rows(merged([one, two.where("false")])) == [("a", 1), ("b", 1)]
    with pytest.raises(ValueError, match="b"):
        merged([one, two])


def test_one_live_row_for_all_spellings_of_an_id(spark, small):  # noqa: F811
    d = small(node=[node(1, "A", "article", heading="one"), node(1, " a", "article", heading="two"), node(1, "a ", "article", heading="two")])
    assert rows(nodes(spark, d).select("key", "heading")) == [("a", "two")]
