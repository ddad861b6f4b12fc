"""Queries that profile, index and reconcile: counts, digests, ratios, indexes over keys."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import C, D, E, G, N, cells, definitions, edges, key_sql, links, nodes, sql
from lexigrove.plans.windows import LINES, lines
from lexigrove.sources.tables import table

R = Registry()
query = R.query


@query(sql(N) + "SELECT node_type, count(*) AS n FROM n GROUP BY 1")
def count_by_type(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).groupBy("node_type").agg(F.count("*").alias("n"))


@query(sql(E) + "SELECT kind, count(DISTINCT dst) AS targets, count(*) AS refs FROM e GROUP BY 1")
def distinct_targets(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).groupBy("kind").agg(F.countDistinct("dst").alias("targets"), F.count("*").alias("refs"))


@query(sql(D) + "SELECT blob, round(avg(length(body)), 6) AS mean, max(length(body)) AS longest FROM d GROUP BY 1")
def definition_length(spark: SparkSession, d: str) -> DataFrame:
    return definitions(spark, d).groupBy("blob").agg(F.round(F.avg(F.length("body")), 6).alias("mean"), F.max(F.length("body")).alias("longest"))


@query(sql(LINES) + """, k AS (SELECT doc_id, li, regexp_replace(trim(t, concat(' ', chr(9), chr(13))), '[0-9]+', '#', 'g') AS k FROM l),
m AS (SELECT k, count(*) AS n, count(DISTINCT doc_id) AS docs, list_sort(list(li))[count(*) // 2 + 1] AS middle FROM k WHERE k <> '' GROUP BY 1)
SELECT k, n, docs, middle FROM m WHERE docs >= 3""")
def running_text(spark: SparkSession, d: str) -> DataFrame:
    """Lines that repeat over documents, digits masked, with the upper median of their place.

    The median comes from counts per place, so a line that is a third of all rows is never gathered.
    """
    k = lines(spark, d).select("doc_id", "li", F.regexp_replace(F.trim("t", F.lit(" \t\r")), "[0-9]+", "#").alias("k")).where("k <> ''")
    docs = k.groupBy("k").agg(F.countDistinct("doc_id").alias("docs"), F.count("*").alias("n")).where("docs >= 3")
    at = k.groupBy("k", "li").agg(F.count("*").alias("m"))
    run = F.sum("m").over(Window.partitionBy("k").orderBy("li"))
    middle = at.withColumn("run", run).join(docs, "k").where(F.col("run") > F.floor(F.col("n") / 2)).groupBy("k").agg(F.min("li").alias("middle"))
    return docs.join(middle, "k").select("k", "n", "docs", "middle")


@query(sql(N) + "SELECT volume, coalesce(max(y1) FILTER (WHERE y1 < 100), 60) AS header, coalesce(min(y0) FILTER (WHERE y0 > 650), 730) AS footer FROM n GROUP BY 1")
def band_edges(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).groupBy("volume").agg(F.coalesce(F.max(F.when(F.col("y1") < 100, F.col("y1"))), F.lit(60.0)).alias("header"), F.coalesce(F.min(F.when(F.col("y0") > 650, F.col("y0"))), F.lit(730.0)).alias("footer"))


@query(sql(N) + """, k AS (SELECT volume, x0, count(*) AS n, sum(count(*)) OVER (PARTITION BY volume) AS total, row_number() OVER (PARTITION BY volume ORDER BY count(*) DESC, x0) AS rn FROM n WHERE x0 IS NOT NULL GROUP BY 1, 2)
SELECT volume, x0, n, n * 2 > total AS holds FROM k WHERE rn = 1""")
def mode_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The most common left edge of each volume; it holds for the volume if more than half of its boxes have it."""
    k = nodes(spark, d).where("x0 is not null").groupBy("volume", "x0").agg(F.count("*").alias("n"))
    w = Window.partitionBy("volume")
    return k.withColumns({"total": F.sum("n").over(w), "rn": F.row_number().over(w.orderBy(F.desc("n"), "x0"))}).where("rn = 1").select("volume", "x0", "n", (F.col("n") * 2 > F.col("total")).alias("holds"))


@query(sql(N) + "SELECT volume, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM n WHERE x0 IS NOT NULL GROUP BY 1, 2")
def bbox_agg(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("x0 is not null").groupBy("volume", "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


LATTICE = "CASE WHEN ys >= 3 AND xs >= 2 AND w > 60 AND h > 25 THEN 'table' WHEN n >= 25 AND w > 80 AND h > 60 THEN 'figure' ELSE 'none' END"


@query(sql(N) + f"""SELECT volume, page, node_type, {LATTICE} AS kind FROM (SELECT volume, page, node_type, count(*) AS n, count(DISTINCT round(y0)) AS ys, count(DISTINCT round(x0)) AS xs, max(x1) - min(x0) AS w, max(y1) - min(y0) AS h FROM n WHERE x0 IS NOT NULL GROUP BY 1, 2, 3)""")
def lattice_classify(spark: SparkSession, d: str) -> DataFrame:
    """What the boxes of one type make up on a page: a table (three levels and two columns), a figure (25 boxes), or neither."""
    k = nodes(spark, d).where("x0 is not null").groupBy("volume", "page", "node_type").agg(F.count("*").alias("n"), F.countDistinct(F.round("y0")).alias("ys"), F.countDistinct(F.round("x0")).alias("xs"), (F.max("x1") - F.min("x0")).alias("w"), (F.max("y1") - F.min("y0")).alias("h"))
    return k.select("volume", "page", "node_type", F.expr(LATTICE).alias("kind"))


@query(sql(N) + """, k AS (SELECT node_type, modality, heading IS NULL AS bare, rid, row_number() OVER (PARTITION BY node_type, modality, heading IS NULL ORDER BY rid) AS k FROM n)
SELECT node_type, modality, bare, count(*) AS n, min(rid) AS sample_a, min(rid) FILTER (WHERE k = 2) AS sample_b FROM k GROUP BY 1, 2, 3 ORDER BY n DESC, node_type, modality, bare LIMIT 24""")
def signature_profile(spark: SparkSession, d: str) -> DataFrame:
    """The 24 most frequent signatures of nodes with their first two samples."""
    sign = ["node_type", "modality", "bare"]
    k = nodes(spark, d).select("node_type", "modality", F.col("heading").isNull().alias("bare"), "rid")
    counts = k.groupBy(*sign).agg(F.count("*").alias("n"), F.min("rid").alias("sample_a"))
    second = k.withColumn("k", F.row_number().over(Window.partitionBy(*sign).orderBy("rid"))).where("k = 2").select(*(F.col(c).alias(f"s_{c}") for c in sign), F.col("rid").alias("sample_b"))
    both = counts.join(second, F.expr(" and ".join(f"{c} <=> s_{c}" for c in sign)), "left")
    return both.select(*sign, "n", "sample_a", "sample_b").orderBy(F.desc("n"), "node_type", F.asc_nulls_last("modality"), "bare").limit(24)


FLAT = "trim(regexp_replace(coalesce(text, ''), '[ \\n\\r\\t]+', ' ', 'g'))"


def _flat(c: str = "text"):
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[ \\n\\r\\t]+", " "))


@query(sql(G) + f"SELECT table_id, r, string_agg({FLAT}, ' | ' ORDER BY c) AS line FROM g GROUP BY 1, 2")
def table_text(spark: SparkSession, d: str) -> DataFrame:
    """The text of each table row in order of columns; a row is bounded, a table is not."""
    row = F.array_sort(F.collect_list(F.struct("c", _flat().alias("t"))))
    return cells(spark, d).groupBy("table_id", "r").agg(F.array_join(F.transform(row, lambda x: x["t"]), " | ").alias("line"))


#: Rows of a table that are shown.
MOST_ROWS = 25


@query(sql(G) + f""", w AS (SELECT table_id, max(c + colspan) AS ncols, count(DISTINCT r) AS total FROM g GROUP BY 1), rw AS (SELECT table_id, r, row_number() OVER (PARTITION BY table_id ORDER BY r) AS nth FROM (SELECT DISTINCT table_id, r FROM g)),
f AS (SELECT rw.table_id, rw.r, rw.nth, unnest(range(ncols)) AS c FROM rw JOIN w USING (table_id) WHERE nth <= {MOST_ROWS})
SELECT f.table_id, 2 * f.nth AS ord, '| ' || string_agg(coalesce({FLAT}, ''), ' | ' ORDER BY f.c) || ' |' AS line FROM f LEFT JOIN g ON g.table_id = f.table_id AND g.r = f.r AND g.c = f.c GROUP BY 1, 2
UNION ALL SELECT table_id, 3, '|' || repeat('---|', CAST(ncols AS BIGINT)) FROM w UNION ALL SELECT table_id, 1000, '... ' || (total - {MOST_ROWS}) || ' further rows' FROM w WHERE total > {MOST_ROWS}""")
def render_table(spark: SparkSession, d: str) -> DataFrame:
    """The Markdown lines of every table in order of `ord`: absent cells blank, a rule under the first row, at most MOST_ROWS rows and then how many more there are."""
    g = cells(spark, d)
    shape = g.groupBy("table_id").agg(F.max(F.col("c") + F.col("colspan")).alias("ncols"), F.countDistinct("r").alias("total"))
    rows = g.groupBy("table_id", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", _flat().alias("t")))).alias("m")).withColumn("nth", F.row_number().over(Window.partitionBy("table_id").orderBy("r"))).where(F.col("nth") <= MOST_ROWS)
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.col("ncols") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))), " | ")
    shown = rows.join(shape, "table_id").select("table_id", (2 * F.col("nth")).cast("bigint").alias("ord"), F.concat(F.lit("| "), line, F.lit(" |")).alias("line"))
    rule = shape.select("table_id", F.lit(3).cast("bigint").alias("ord"), F.concat(F.lit("|"), F.expr("repeat('---|', ncols)")).alias("line"))
    more = shape.where(F.col("total") > MOST_ROWS).select("table_id", F.lit(1000).cast("bigint").alias("ord"), F.concat(F.lit("... "), (F.col("total") - MOST_ROWS).cast("string"), F.lit(" further rows")).alias("line"))
    return shown.unionByName(rule).unionByName(more)


@query(sql(G) + "SELECT regexp_replace(table_id, '#[0-9]+$', '') AS base, count(DISTINCT table_id) AS parts, count(*) AS cells, count(DISTINCT (table_id, r)) AS nrows FROM g GROUP BY 1")
def table_runs(spark: SparkSession, d: str) -> DataFrame:
    per = cells(spark, d).groupBy("table_id", "r").agg(F.count("*").alias("k"))
    return per.groupBy(F.regexp_replace("table_id", "#[0-9]+$", "").alias("base")).agg(F.countDistinct("table_id").alias("parts"), F.sum("k").alias("cells"), F.count("*").alias("nrows"))


@query(sql(E) + "SELECT kind, count(*) AS refs, count(dst) AS resolved, round(count(dst) * 1.0 / count(*), 6) AS rate FROM e GROUP BY 1")
def resolution_rate(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).groupBy("kind").agg(F.count("*").alias("refs"), F.count("dst").alias("resolved"), F.round(F.count("dst") / F.count("*"), 6).alias("rate"))


@query(sql(E) + "SELECT reason, count(*) AS n FROM e WHERE dst IS NULL GROUP BY 1 ORDER BY n DESC, reason NULLS FIRST LIMIT 6")
def residual_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The six most frequent reasons of unresolved refs."""
    return edges(spark, d).where("dst is null").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("reason")).limit(6)


@query(sql(N) + """, x AS (SELECT key, unnest(string_split(lower(heading), '')) AS ch, 1 AS a, 0 AS b FROM n WHERE heading IS NOT NULL AND body IS NOT NULL AND heading <> '' AND body <> ''
UNION ALL SELECT key, unnest(string_split(lower(body), '')), 0, 1 FROM n WHERE heading IS NOT NULL AND body IS NOT NULL AND heading <> '' AND body <> ''),
y AS (SELECT key, ch, sum(a) AS a, sum(b) AS b FROM x GROUP BY 1, 2)
SELECT key, CAST(sum(greatest(a - b, 0)) AS BIGINT) AS lost, CAST(sum(a) AS BIGINT) AS total FROM y GROUP BY 1""")
def char_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Characters of each heading, as a bag, that its body doesn't cover."""
    n = nodes(spark, d).where("heading <> '' and body <> ''")

    def bag(c: str, a: int) -> DataFrame:
        return n.select("key", F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"(?s)."), F.lit(0))).alias("ch"), F.lit(a).alias("a"), F.lit(1 - a).alias("b"))

    y = bag("heading", 1).unionByName(bag("body", 0)).groupBy("key", "ch").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return y.groupBy("key").agg(F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("lost"), F.sum("a").alias("total"))


PRINTED = "concat(length(key), ':', key, ',', coalesce(length(heading), -1), ':', coalesce(heading, ''), ',', coalesce(length(body), -1), ':', coalesce(body, ''))"


@query(sql(N) + f""", h AS (SELECT node_type, sha256({PRINTED}) AS h FROM n) SELECT node_type, count(*) AS n, {" || '-' || ".join(f"CAST(sum(CAST('0x' || substr(h, {i}, 15) AS BIGINT)) AS VARCHAR)" for i in (1, 16, 31, 46))} AS digest FROM h GROUP BY 1""")
def content_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each type's content that doesn't depend on the order of rows: the sums of four 60-bit parts of each row's SHA-256, whose fields are printed with their lengths."""
    h = nodes(spark, d).select("node_type", F.sha2(F.expr(PRINTED), 256).alias("h"))
    parts = [F.sum(F.conv(F.substring("h", i, 15), 16, 10).cast("decimal(20,0)")).cast("string") for i in (1, 16, 31, 46)]
    return h.groupBy("node_type").agg(F.count("*").alias("n"), F.concat_ws("-", *parts).alias("digest"))


@query(sql(N, E, C) + """SELECT (SELECT count(*) FROM n) AS nodes, (SELECT max(page) FROM n) AS pages, (SELECT count(*) FROM e) AS refs, (SELECT count(*) FROM e WHERE dst IS NULL) AS unresolved,
(SELECT count(*) FROM c) AS pairs, (SELECT max(depth) FROM c) AS height, (SELECT CAST(sum(length(body)) AS BIGINT) FROM n) AS chars""")
def facts(spark: SparkSession, d: str) -> DataFrame:
    a = nodes(spark, d).agg(F.count("*").alias("nodes"), F.max("page").alias("pages"), F.sum(F.length("body")).alias("chars"))
    b = edges(spark, d).agg(F.count("*").alias("refs"), F.count_if(F.col("dst").isNull()).alias("unresolved"))
    return a.crossJoin(b).crossJoin(links(spark, d).agg(F.count("*").alias("pairs"), F.max("depth").alias("height")))  # one row each


GATES = {"refs resolved": ("e", "dst IS NOT NULL", 0.9), "refs with a kind": ("e", "kind IS NOT NULL", 0.99), "leaves with modality": ("n", "node_type NOT IN ('sentence', 'clause') OR body IS NULL OR modality IS NOT NULL", 0.95), "articles with heading": ("n", "node_type <> 'article' OR heading IS NOT NULL", 0.99)}


@query(sql(N, E) + " UNION ALL ".join(f"SELECT '{k}' AS gate, count(*) FILTER (WHERE {c}) AS good, count(*) AS total, count(*) FILTER (WHERE {c}) >= {f} * count(*) AS passed FROM {t}" for k, (t, c, f) in GATES.items()))
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    """Ratio gates with their floors."""
    found = None
    for t, df in (("n", nodes(spark, d)), ("e", edges(spark, d))):
        mine = [(k, c, f) for k, (x, c, f) in GATES.items() if x == t]
        one = df.agg(F.count("*").alias("total"), *[F.count_if(F.expr(c)).alias(f"g{i}") for i, (_, c, _) in enumerate(mine)])
        rows = one.select("total", F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), F.col(f"g{i}").alias("good"), F.lit(f).alias("floor")) for i, (k, _, f) in enumerate(mine)])).alias("g"))
        rows = rows.select("g.gate", "g.good", "total", (F.col("g.good") >= F.col("g.floor") * F.col("total")).alias("passed"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query(sql(N) + "SELECT modality, count(*) AS n, round(count(*) * 1.0 / (SELECT count(modality) FROM n), 6) AS share FROM n WHERE modality IS NOT NULL GROUP BY 1")
def modality_report(spark: SparkSession, d: str) -> DataFrame:
    k = nodes(spark, d).where("modality is not null").groupBy("modality").agg(F.count("*").alias("n"))
    return k.crossJoin(k.agg(F.sum("n").alias("total"))).select("modality", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))  # the total is one row


@query(sql(N) + "SELECT volume, split_part(key, '/', 2) AS division, number, arg_max(key, rid) AS key FROM n WHERE number IS NOT NULL GROUP BY 1, 2, 3")
def number_index(spark: SparkSession, d: str) -> DataFrame:
    """Number to node per volume and division; the last in document order wins."""
    return nodes(spark, d).where("number is not null").groupBy("volume", F.split_part("key", F.lit("/"), F.lit(2)).alias("division"), "number").agg(F.max_by("key", "rid").alias("key"))


@query(sql(D) + "SELECT lower(trim(regexp_extract(body, '^(.{2,60}?) +means\\b', 1))) AS term, min(id) AS id FROM d WHERE regexp_matches(body, '^.{2,60}? +means\\b') GROUP BY 1")
def term_index(spark: SparkSession, d: str) -> DataFrame:
    term = F.lower(F.trim(F.regexp_extract("body", r"^(.{2,60}?) +means\b", 1)))
    return definitions(spark, d).where(F.col("body").rlike(r"^.{2,60}? +means\b")).groupBy(term.alias("term")).agg(F.min("id").alias("id"))


@query(sql(G) + """, t AS (SELECT table_id, r, c, trim(unnest(string_split_regex(coalesce(text, ''), '[ \\n\\r\\t]+')), '.,;:()[]') AS token FROM g)
SELECT token, count(*) AS n, min(table_id) AS first_table FROM t WHERE length(token) > 2 AND regexp_matches(token, '[0-9]') GROUP BY 1""")
def std_index(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of the cells that name something by a number, with the first table that has them."""
    t = cells(spark, d).select("table_id", F.explode(F.split(F.coalesce("text", F.lit("")), "[ \\n\\r\\t]+")).alias("raw")).select("table_id", F.trim("raw", F.lit(".,;:()[]")).alias("token"))
    return t.where("length(token) > 2 and token rlike '[0-9]'").groupBy("token").agg(F.count("*").alias("n"), F.min("table_id").alias("first_table"))


@query(sql(N) + "SELECT volume, upper(regexp_replace(designator, '[-. ]', '', 'g')) AS norm, arg_min(key, rid) AS key, count(*) AS n FROM n WHERE designator IS NOT NULL GROUP BY 1, 2")
def norm_index(spark: SparkSession, d: str) -> DataFrame:
    """Normalised designator to node; the first in document order wins."""
    return nodes(spark, d).where("designator is not null").groupBy("volume", F.upper(F.regexp_replace("designator", "[-. ]", "")).alias("norm")).agg(F.min_by("key", "rid").alias("key"), F.count("*").alias("n"))


@query(sql(N, E) + """, l AS (SELECT key, unnest(range(len(a))) AS line_no, unnest(a) AS t FROM (SELECT key, string_split(body, chr(10)) AS a FROM n WHERE body IS NOT NULL)),
o AS (SELECT key, line_no, sum(length(t) + 1) OVER (PARTITION BY key ORDER BY line_no) - length(t) - 1 AS lo, sum(length(t) + 1) OVER (PARTITION BY key ORDER BY line_no) - 1 AS hi FROM l)
SELECT e.ref_id, o.line_no FROM e LEFT JOIN o ON o.key = e.src AND e.s >= o.lo AND e.s < o.hi WHERE e.chunk = '*'""")
def offset_to_line(spark: SparkSession, d: str) -> DataFrame:
    """The line of the body in which a ref begins; none on a separator or beyond the text."""
    l = nodes(spark, d).where("body is not null").select("key", F.posexplode(F.split("body", "\n")).alias("line_no", "t"))  # noqa: E741
    end = F.sum(F.length("t") + 1).over(Window.partitionBy("key").orderBy("line_no")) - 1
    o = l.withColumn("hi", end).select(F.col("key").alias("src"), "line_no", (F.col("hi") - F.length("t")).alias("lo"), "hi")
    e = edges(spark, d).where("chunk = '*'").select("ref_id", "src", "s")
    return e.alias("e").join(o.alias("o"), (F.col("e.src") == F.col("o.src")) & (F.col("s") >= F.col("lo")) & (F.col("s") < F.col("hi")), "left").select("ref_id", "line_no")


@query(sql(N, G) + """SELECT id AS owner, 'h' AS chunk, length(heading) AS chars FROM n WHERE heading IS NOT NULL UNION ALL SELECT id, '*', length(body) FROM n WHERE body IS NOT NULL
UNION ALL SELECT table_id, 'g' || c, CAST(sum(length(text)) AS BIGINT) FROM g WHERE text IS NOT NULL GROUP BY 1, 2""")
def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    """One list of the three origins of text: headings, bodies, table columns."""
    n = nodes(spark, d)
    part = lambda c, tag: n.where(F.col(c).isNotNull()).select(F.col("id").alias("owner"), F.lit(tag).alias("chunk"), F.length(c).cast("bigint").alias("chars"))
    g = cells(spark, d).where("text is not null").groupBy(F.col("table_id").alias("owner"), F.concat(F.lit("g"), F.col("c").cast("string")).alias("chunk")).agg(F.sum(F.length("text")).alias("chars"))
    return part("heading", "h").unionByName(part("body", "*")).unionByName(g)


@query(sql(N) + "SELECT key, designator || CASE WHEN k > 1 THEN '#' || k ELSE '' END AS name FROM (SELECT key, designator, row_number() OVER (PARTITION BY volume, node_type, designator ORDER BY rid) AS k FROM n WHERE designator IS NOT NULL)")
def designator_suffix(spark: SparkSession, d: str) -> DataFrame:
    """Reused designators get a running suffix in document order."""
    k = F.row_number().over(Window.partitionBy("volume", "node_type", "designator").orderBy("rid"))
    return nodes(spark, d).where("designator is not null").withColumn("k", k).select("key", F.concat("designator", F.when(F.col("k") > 1, F.concat(F.lit("#"), F.col("k").cast("string"))).otherwise("")).alias("name"))


@query(sql(N) + "SELECT volume, page, min(rid) AS rid, count(*) AS n FROM n WHERE contains(body, 'shall') GROUP BY 1, 2")
def page_first_match(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where(F.col("body").contains("shall")).groupBy("volume", "page").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))


@query(sql(N, E) + """, x AS (SELECT e.ref_id, strpos(n.body, e.text) AS a, strpos(n.body, rtrim(e.text, '.,;:')) AS b, strpos(n.body, split_part(e.text, ' ', 1)) AS w FROM e JOIN n ON n.key = e.src WHERE e.text IS NOT NULL AND e.text <> '' AND n.body IS NOT NULL)
SELECT ref_id, CASE WHEN a > 0 THEN 1 WHEN b > 0 THEN 2 WHEN w > 0 THEN 3 ELSE 0 END AS tier, CASE WHEN a > 0 THEN a WHEN b > 0 THEN b ELSE w END AS place FROM x""")
def probe_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Where a ref's text stands in its source: whole, without end punctuation, or by its first word."""
    n = nodes(spark, d).where("body is not null").select(F.col("key").alias("src"), "body")
    x = edges(spark, d).where("text <> ''").join(n, "src").select("ref_id", F.expr("position(text, body)").alias("a"), F.expr("position(rtrim('.,;:', text), body)").alias("b"), F.expr("position(split_part(text, ' ', 1), body)").alias("w"))
    return x.select("ref_id", F.expr("CASE WHEN a > 0 THEN 1 WHEN b > 0 THEN 2 WHEN w > 0 THEN 3 ELSE 0 END").alias("tier"), F.expr("CASE WHEN a > 0 THEN a WHEN b > 0 THEN b ELSE w END").alias("place"))


@query(sql(N) + "SELECT volume, min(page) AS page FROM (SELECT volume, page FROM n WHERE x0 < 40 GROUP BY 1, 2 HAVING count(*) >= 3) GROUP BY 1")
def legend_page(spark: SparkSession, d: str) -> DataFrame:
    """The first page of each volume with at least three boxes at the margin."""
    return nodes(spark, d).where("x0 < 40").groupBy("volume", "page").agg(F.count("*").alias("n")).where("n >= 3").groupBy("volume").agg(F.min("page").alias("page"))


#: Numbers that prose may hold without a fact behind them, besides years.
ALLOWED_NUMBERS = ("100", "1000")


@query(f"""WITH m AS (SELECT DISTINCT unnest(regexp_extract_all(t, '[0-9]{{3,}}')) AS num FROM (SELECT body AS t FROM node UNION ALL SELECT heading FROM node UNION ALL SELECT text FROM cell)), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9]{{3,}}')) AS num FROM documents)
SELECT num FROM w WHERE num NOT IN (SELECT num FROM m) AND num NOT IN {ALLOWED_NUMBERS} AND NOT regexp_full_match(num, '(19|20)[0-9]{{2}}')""")
def doc_number_drift(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of three and more digits in the documents that stand in no node or cell and aren't allowed: years, and ALLOWED_NUMBERS."""
    nums = lambda t, c: table(spark, d, t).select(F.explode(F.regexp_extract_all(c, F.lit("[0-9]{3,}"), F.lit(0))).alias("num")).distinct()
    facts = nums("node", "body").unionByName(nums("node", "heading")).unionByName(nums("cell", "text"))
    return nums("documents", "text").join(facts, "num", "left_anti").where(~F.col("num").isin(*ALLOWED_NUMBERS) & ~F.col("num").rlike("^(19|20)[0-9]{2}$"))


MANIFEST = """fd AS (SELECT DISTINCT lower(trim(node_id)) AS path FROM documents WHERE node_id IS NOT NULL), mf AS (SELECT key AS path, 'sha256' AS alg FROM n UNION ALL SELECT key, 'sha512' FROM n WHERE coalesce(body, heading, '') <> '')"""


@query(sql(N, MANIFEST) + "SELECT path, (SELECT count(*) FROM mf WHERE mf.path = fd.path) AS other_rows FROM fd WHERE (path, 'sha512') NOT IN (SELECT path, alg FROM mf)")
def fetch_unhashed(spark: SparkSession, d: str) -> DataFrame:
    """Fetched paths (the node ids of documents) without a sha512 row in the manifest, and how many rows of another digest they have.

    The manifest has a sha256 row for each live node, and a sha512 row where the node has content.
    """
    fetched = table(spark, d, "documents").where("node_id is not null").select(F.lower(F.trim("node_id")).alias("path")).distinct()
    n = nodes(spark, d).select(F.col("key").alias("path"), F.coalesce("body", "heading", F.lit("")).alias("t"))
    missing = fetched.join(n.where("t <> ''"), "path", "left_anti")
    return missing.join(n.withColumn("row", F.lit(1)), "path", "left").groupBy("path").agg(F.count("row").alias("other_rows"))


@query(sql(N, D, E) + """, vo AS (SELECT DISTINCT volume FROM n) SELECT 'object' AS side, d.key, 'v' || vo.volume || '/' || lower(trim(d.blob)) AS missing FROM d, vo WHERE d.blob IS NOT NULL AND 'v' || vo.volume || '/' || lower(trim(d.blob)) NOT IN (SELECT key FROM n)
UNION ALL SELECT 'result', src, dst FROM (SELECT DISTINCT src, dst FROM e WHERE kind = 'term' AND dst IS NOT NULL) WHERE dst NOT IN (SELECT key FROM d)""")
def provenance_refs(spark: SparkSession, d: str) -> DataFrame:
    """Both ends of derivations that don't exist: source texts of definitions missing in a volume, and definitions that term edges lead to."""
    volumes = nodes(spark, d).select("volume").distinct()
    homes = definitions(spark, d).where("blob is not null").select("key", F.lower(F.trim("blob")).alias("home")).distinct().withColumn("one", F.lit(1)).join(volumes.withColumn("one", F.lit(1)), "one")
    objects = homes.select("key", F.concat(F.lit("v"), F.col("volume").cast("string"), F.lit("/"), "home").alias("missing")).join(nodes(spark, d).select(F.col("key").alias("missing")), "missing", "left_anti")
    results = edges(spark, d).where("kind = 'term' and dst is not null").select(F.col("src").alias("key"), F.col("dst").alias("missing")).distinct().join(definitions(spark, d).select(F.col("key").alias("missing")), "missing", "left_anti")
    return objects.select(F.lit("object").alias("side"), "key", "missing").unionByName(results.select(F.lit("result").alias("side"), "key", "missing"))


#: Patterns of sources that may be ignored, and those that are declared nevertheless; ** crosses slashes, * and ? don't.
IGNORED, DECLARED = ("code/**", "bulletin/*", "minutes/**", "ruling/20??-*"), ("code/volume-?", "guide/*")


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression for the whole path."""
    out = ""
    for part in re.split(r"(\*\*|\*|\?)", glob):
        out += {"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(part, re.sub(r"([.\\+^$()\[\]{}|])", r"\\\1", part))
    return f"^{out}$"


def _any_glob(globs: tuple[str, ...]) -> str:
    return "|".join(f"(?:{glob_pattern(g)})" for g in globs)


@query(f"SELECT source, count(*) AS n, regexp_matches(lower(source), '{_any_glob(IGNORED)}') AS ignored, regexp_matches(lower(source), '{_any_glob(DECLARED)}') AS declared FROM documents WHERE source IS NOT NULL GROUP BY 1")
def glob_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sources with whether a pattern ignores them and whether one declares them; those ignored and not declared are the unknown ones."""
    s = F.lower("source")
    counts = table(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    return counts.select("source", "n", s.rlike(_any_glob(IGNORED)).alias("ignored"), s.rlike(_any_glob(DECLARED)).alias("declared"))


ACTIONS = "CASE WHEN text IS NULL THEN 'none' WHEN text LIKE 'INDEX/%' THEN 'launch' WHEN text LIKE 'Table %' THEN 'table' WHEN text LIKE 'Note %' THEN 'note' WHEN regexp_like(text, '^[0-9]') THEN 'goto' ELSE 'word' END"


#: Volumes that links may lead out of their own into.
LINKABLE = (1, 2)


@query(sql(N, E) + f"""SELECT action, allowed, count(*) AS n FROM (SELECT CASE WHEN e.dst IS NULL AND regexp_matches(coalesce(e.text, ''), '(?i)^file:|[.](pdf|docx?)$') THEN 'file' WHEN e.dst IS NULL THEN 'none' WHEN t.key IS NULL THEN 'launch' WHEN t.volume <> s.volume THEN 'remote' ELSE 'goto' END AS action,
  CASE WHEN e.dst IS NULL THEN NOT regexp_matches(coalesce(e.text, ''), '(?i)^file:|[.](pdf|docx?)$') WHEN t.key IS NULL THEN false WHEN t.volume <> s.volume THEN t.volume IN {LINKABLE} ELSE true END AS allowed FROM e JOIN n s ON s.key = e.src LEFT JOIN n t ON t.key = e.dst) GROUP BY 1, 2""")
def dead_file_links(spark: SparkSession, d: str) -> DataFrame:
    """Links by what they do when followed, and whether that is allowed: goto inside the volume, remote into a volume of the allow-list, no target at all; not to files, and not launch (a target outside of the graph)."""
    n = nodes(spark, d)
    e = edges(spark, d).join(n.select(F.col("key").alias("src"), F.col("volume").alias("sv")), "src").join(n.select(F.col("key").alias("dst"), F.col("volume").alias("tv")), "dst", "left")
    file = F.coalesce("text", F.lit("")).rlike("(?i)^file:|[.](pdf|docx?)$")
    none = F.col("dst").isNull()
    action = F.when(none & file, "file").when(none, "none").when(F.col("tv").isNull(), "launch").when(F.col("tv") != F.col("sv"), "remote").otherwise("goto")
    allowed = F.when(none, ~file).when(F.col("tv").isNull(), False).when(F.col("tv") != F.col("sv"), F.col("tv").isin(*LINKABLE)).otherwise(True)
    return e.select(action.alias("action"), allowed.alias("allowed")).groupBy("action", "allowed").agg(F.count("*").alias("n"))


FOLDED = "regexp_replace(lower({}), '[^0-9a-z]+', '', 'g')"


@query(sql(N) + f"""SELECT volume, count(*) AS lines, count(*) FILTER (WHERE contains(hay, needle) OR contains(hay, substr(needle, 1, length(needle) // 2))) AS captured FROM (
SELECT k.volume, {FOLDED.format("coalesce(p.heading, '') || ' ' || coalesce(p.body, '')")} AS hay, {FOLDED.format("k.heading")} AS needle FROM n k JOIN n p ON p.key = k.up WHERE length(k.heading) >= 4) WHERE needle <> '' GROUP BY 1""")
def text_capture(spark: SparkSession, d: str) -> DataFrame:
    """Headings that stand, whole or by their first half, in the text of their parent."""
    fold = lambda c: F.regexp_replace(F.lower(c), "[^0-9a-z]+", "")
    n = nodes(spark, d)
    p = n.select(F.col("key").alias("up"), fold(F.concat_ws(" ", F.coalesce("heading", F.lit("")), F.coalesce("body", F.lit("")))).alias("hay"))
    x = n.where("length(heading) >= 4").select("volume", "up", fold("heading").alias("needle")).where("needle <> ''").join(p, "up")
    half = F.expr("substr(needle, 1, length(needle) div 2)")
    return x.groupBy("volume").agg(F.count("*").alias("lines"), F.count_if(F.col("hay").contains(F.col("needle")) | F.col("hay").contains(half)).alias("captured"))


@query(sql(N, G) + """, b AS (SELECT DISTINCT lower(trim(table_id)) AS key FROM g), t AS (SELECT key FROM n WHERE node_type = 'table')
SELECT coalesce(t.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'declared only' ELSE 'built only' END AS side FROM t FULL JOIN b ON b.key = t.key WHERE t.key IS NULL OR b.key IS NULL""")
def two_way_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Tables declared as nodes without cells, and cells of tables that no node declares."""
    t = nodes(spark, d).where("node_type = 'table'").select("key", F.lit(True).alias("t"))
    b = cells(spark, d).select(F.lower(F.trim("table_id")).alias("key")).distinct().withColumn("b", F.lit(True))
    return t.join(b, "key", "full").where("t is null or b is null").select("key", F.when(F.col("b").isNull(), "declared only").otherwise("built only").alias("side"))


@query(sql(G, E) + """SELECT e.ref_id, g.text FROM e JOIN g ON lower(trim(g.table_id)) = e.dst AND g.c = CAST(substr(e.chunk, 2) AS INTEGER) AND g.r = e.line + 1 WHERE regexp_full_match(e.chunk, 'g[0-9]{1,4}')""")
def cell_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The cell of the cited table at the place that the ref's chunk and line give."""
    g = cells(spark, d).select(F.lower(F.trim("table_id")).alias("dst"), "r", "c", F.col("text").alias("cell_text"))
    e = edges(spark, d).where("chunk rlike '^g[0-9]{1,4}$'").select("ref_id", "dst", (F.col("line") + 1).alias("r"), F.expr("cast(substr(chunk, 2) as int)").alias("c"))
    return e.join(g, ["dst", "r", "c"]).select("ref_id", F.col("cell_text").alias("text"))


@query(sql(N) + """SELECT 'digest' AS fault, sha256(text) AS item, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'path', permalink, count(*) FROM n WHERE permalink IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'unsafe', permalink, count(*) FROM n WHERE regexp_matches(permalink, '^/|(^|/)[.][.](/|$)|^$') GROUP BY 2
UNION ALL SELECT 'field', CASE WHEN text IS NULL THEN 'text' WHEN source IS NULL THEN 'source' WHEN n_chars IS NULL THEN 'n_chars' ELSE 'length' END, count(*) FROM documents WHERE text IS NULL OR source IS NULL OR n_chars IS NULL OR n_chars <> length(text) GROUP BY 2""")
def manifest_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Faults for which a release is refused: a digest or a path that occurs more than once, an unsafe path, a required field that is missing or doesn't fit its content."""
    docs, paths = table(spark, d, "documents"), nodes(spark, d).where("permalink is not null").groupBy(F.col("permalink").alias("item")).agg(F.count("*").alias("n"))
    digests = docs.where("text is not null").groupBy(F.sha2("text", 256).alias("item")).agg(F.count("*").alias("n")).where("n > 1")
    bad = F.when(F.col("text").isNull(), "text").when(F.col("source").isNull(), "source").when(F.col("n_chars").isNull(), "n_chars").when(F.col("n_chars") != F.length("text"), "length")
    fields = docs.select(bad.alias("item")).where("item is not null").groupBy("item").agg(F.count("*").alias("n"))
    unsafe = paths.where(F.col("item").rlike("^/|(^|/)[.][.](/|$)|^$"))
    out = None
    for fault, rows in (("digest", digests), ("path", paths.where("n > 1")), ("unsafe", unsafe), ("field", fields)):
        one = rows.select(F.lit(fault).alias("fault"), "item", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(sql(N) + "SELECT permalink, regexp_matches(permalink, '^/|(^|/)[.][.](/|$)|^$|[^A-Za-z0-9._/#~-]') AS unsafe, count(*) AS n FROM n GROUP BY 1, 2")
def manifest_paths(spark: SparkSession, d: str) -> DataFrame:
    """Permalinks with whether they are unsafe as paths: absolute, empty, climbing up, odd characters."""
    return nodes(spark, d).groupBy("permalink").agg(F.count("*").alias("n")).withColumn("unsafe", F.col("permalink").rlike("^/|(^|/)[.][.](/|$)|^$|[^A-Za-z0-9._/#~-]"))


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def events_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.from_json("props", "k int")["k"].alias("k")).agg(F.count("*").alias("n"))


BASE = f"""hs AS (SELECT *, {key_sql("id")} AS key, sha256(coalesce(heading, '') || chr(1) || coalesce(body, '')) AS h, row_number() OVER (PARTITION BY {key_sql("id")} ORDER BY loaded_at, rid, heading NULLS FIRST, body NULLS FIRST) AS first FROM node WHERE {key_sql("id")} IS NOT NULL)"""


@query(sql(N, BASE) + """, b AS (SELECT key, h, node_type FROM hs WHERE first = 1), w AS (SELECT key, sha256(coalesce(heading, '') || chr(1) || coalesce(body, '')) AS h, node_type FROM n)
SELECT coalesce(w.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'untracked' WHEN w.key IS NULL THEN 'removed' ELSE 'modified' END AS drift FROM b FULL JOIN w ON w.key = b.key WHERE coalesce(w.node_type, b.node_type) IN ('article', 'sentence', 'clause', 'subclause', 'table') AND w.h IS DISTINCT FROM b.h""")
def baseline_drift(spark: SparkSession, d: str) -> DataFrame:
    """Live nodes of protected types whose content differs from their first state by hash, is new, or is gone."""
    h = F.sha2(F.concat(F.coalesce("heading", F.lit("")), F.lit("\x01"), F.coalesce("body", F.lit(""))), 256)
    rows = table(spark, d, "node").withColumn("key", id_key("id")).where("key is not null")
    order = F.row_number().over(Window.partitionBy("key").orderBy("loaded_at", "rid", "heading", "body"))
    base = rows.withColumn("first", order).where("first = 1").select("key", h.alias("bh"), F.col("node_type").alias("bt"))
    now = nodes(spark, d).select("key", h.alias("wh"), F.col("node_type").alias("wt"))
    both = now.join(base, "key", "full").where(F.coalesce("wt", "bt").isin("article", "sentence", "clause", "subclause", "table") & ~F.col("wh").eqNullSafe(F.col("bh")))
    return both.select("key", F.when(F.col("bh").isNull(), "untracked").when(F.col("wh").isNull(), "removed").otherwise("modified").alias("drift"))
