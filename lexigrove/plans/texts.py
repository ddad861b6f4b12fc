"""Queries over text functions, rule tables and key lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions import text as T
from lexigrove.functions.ids import id_key, trimmed
from lexigrove.functions.rules import LINE_ROLE_SQL, MODALITY, MODALITY_RENDERED, first_match, first_match_sql, line_role
from lexigrove.plans.graph import OWNED, owned_tables
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import C, D, E, G, N, WS, cells, definitions, edges, key_sql, links, nodes, sql
from lexigrove.sources.tables import table

R = Registry()
query = R.query


@query(sql(N) + f"SELECT key, {first_match_sql('body', MODALITY, 'statement')} AS modality FROM n WHERE body IS NOT NULL")
def modality_classify(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("body is not null").select("key", first_match(F.col("body"), MODALITY, "statement").alias("modality"))


@query(sql(N) + f"SELECT coalesce(modality, 'none') AS stored, {first_match_sql('body', MODALITY_RENDERED, 'statement')} AS rendered, count(*) AS n FROM n WHERE body IS NOT NULL GROUP BY 1, 2")
def modality_render(spark: SparkSession, d: str) -> DataFrame:
    """The modality that rendering infers against the stored one."""
    return nodes(spark, d).where("body is not null").groupBy(F.coalesce("modality", F.lit("none")).alias("stored"), first_match(F.col("body"), MODALITY_RENDERED, "statement").alias("rendered")).agg(F.count("*").alias("n"))


# Lines as printed: a heading is in black, the head of a section of an act in bold Times, all else plain.
PRINTED = f"""pl AS (SELECT key, CASE WHEN node_type = 'act_section' THEN 'Times-Bold' WHEN coalesce(heading, '') <> '' THEN 'Arial-Black' ELSE 'Times' END AS font, coalesce(x0, 0) AS x, concat_ws(' ', nullif(designator, ''), coalesce(nullif(heading, ''), nullif(body, ''))) AS t FROM n)"""


@query(sql(N, PRINTED) + f"SELECT key, {LINE_ROLE_SQL} AS role FROM pl")
def role_classify(spark: SparkSession, d: str) -> DataFrame:
    """The role of each line by font, place and text: one of nine, by the first rule that holds."""
    font = F.when(F.col("node_type") == "act_section", "Times-Bold").when(F.coalesce("heading", F.lit("")) != "", "Arial-Black").otherwise("Times")
    blank = F.lit("")
    text = F.concat_ws(" ", F.nullif("designator", blank), F.coalesce(F.nullif("heading", blank), F.nullif("body", blank)))
    printed = nodes(spark, d).select("key", font.alias("font"), F.coalesce("x0", F.lit(0.0)).alias("x"), text.alias("t"))
    return printed.select("key", line_role(F.col("font"), F.col("x"), F.col("t")).alias("role"))


@query(sql(N) + "SELECT key, upper(regexp_replace(designator, '[-.\\s]', '', 'g')) AS norm FROM n WHERE designator IS NOT NULL")
def normdes(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("designator is not null").select("key", T.normdes("designator").alias("norm"))


@query(sql(E) + """SELECT ref_id, printed, regexp_replace(regexp_replace(rtrim(trim(printed), '.'), '([0-9])-[.]([A-Za-z0-9/]+)$', '\\1.-\\2'), '([0-9])[.][.]-([A-Za-z0-9/]+)$', '\\1.-\\2') AS repaired FROM (SELECT ref_id, regexp_replace(text, '^(Table|Figure) ', '') AS printed FROM e WHERE kind = 'cap_ref' AND text IS NOT NULL)""")
def figure_designator(spark: SparkSession, d: str) -> DataFrame:
    """The designators of captions without their last full stop, point and hyphen in the right order."""
    printed = edges(spark, d).where("kind = 'cap_ref' and text is not null").select("ref_id", F.regexp_replace("text", "^(Table|Figure) ", "").alias("printed"))
    return printed.select("ref_id", "printed", T.repaired_designator("printed").alias("repaired"))


CANON_SQL = "trim(regexp_replace(" + "replace(" * len(T.PRINT_FORMS) + "nfc_normalize({})" + "".join(f", chr({ord(k)}), '{v if v != chr(39) else chr(39) * 2}')" for k, v in T.PRINT_FORMS.items()) + ", '[ \\n\\r\\t\\x0b\\x0c]+', ' ', 'g'))"


@query(sql(N) + f"SELECT key, {CANON_SQL.format('heading')} AS canon FROM n WHERE heading IS NOT NULL")
def canon_text(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("heading is not null").select("key", T.canon_text("heading").alias("canon"))


@query(sql(N) + f"SELECT k.key, contains(lower({CANON_SQL.format('p.heading')}), lower(split_part({CANON_SQL.format('k.heading')}, ' ', 1))) AS inside FROM n k JOIN n p ON p.key = k.up WHERE k.heading IS NOT NULL AND p.heading IS NOT NULL")
def canon_contains(spark: SparkSession, d: str) -> DataFrame:
    """Whether the first word of a heading stands in the heading above it, both in canonical form."""
    n = nodes(spark, d).where("heading is not null").select("key", "up", F.lower(T.canon_text("heading")).alias("h"))
    p = n.select(F.col("key").alias("up"), F.col("h").alias("hay"))
    return n.join(p, "up").select("key", F.col("hay").contains(F.split_part("h", F.lit(" "), F.lit(1))).alias("inside"))


@query(sql(N) + "SELECT key, length(regexp_replace(body, '[\\s\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}\\x0b]+', '', 'g')) AS chars FROM n WHERE body IS NOT NULL")
def squash(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("body is not null").select("key", F.length(T.squash("body")).alias("chars"))


@query(sql(D) + "SELECT key, trim(regexp_replace(regexp_replace(strip_accents(lower(replace(term, chr(8217), chr(39)))), '-', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM d WHERE term IS NOT NULL")
def term_norm(spark: SparkSession, d: str) -> DataFrame:
    return definitions(spark, d).where("term is not null").select("key", T.term_norm("term").alias("norm"))


@query(sql(D) + "SELECT key, trim(regexp_replace(lower(term), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM d WHERE term IS NOT NULL")
def slug(spark: SparkSession, d: str) -> DataFrame:
    return definitions(spark, d).where("term is not null").select("key", T.slug("term").alias("slug"))


@query(sql(N) + """, s AS (SELECT rid, trim(regexp_replace(lower(heading), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM n WHERE heading IS NOT NULL AND heading <> ''), k AS (SELECT rid, s, row_number() OVER (PARTITION BY s ORDER BY rid) - 1 AS k FROM s WHERE s <> '')
SELECT rid, s || CASE WHEN k > 0 THEN '~' || k ELSE '' END AS slug FROM k""")
def slug_unique(spark: SparkSession, d: str) -> DataFrame:
    """Slugs made unique in document order by a running suffix."""
    s = nodes(spark, d).where("heading <> ''").select("rid", T.slug("heading").alias("s")).where("s <> ''")
    k = s.withColumn("k", F.row_number().over(Window.partitionBy("s").orderBy("rid")) - 1)
    return k.select("rid", F.concat("s", F.when(F.col("k") > 0, F.concat(F.lit("~"), F.col("k").cast("string"))).otherwise("")).alias("slug"))


def _singular_sql(c: str) -> str:
    rules = ", ".join(f"CASE WHEN ends_with({c}, '{s}') AND length(list_extract(string_split({c}, ' '), -1)) - {len(s)} >= 3 THEN left({c}, length({c}) - {len(s)}) || '{n}' END" for s, n in (("ies", "y"), ("ses", "s"), ("es", ""), ("s", ""), ("es", "e")))
    return f"[{rules}]"


@query(sql(E) + f", t AS (SELECT DISTINCT lower(text) AS t FROM e WHERE kind = 'term' AND text IS NOT NULL) SELECT DISTINCT t, s FROM (SELECT t, unnest({_singular_sql('t')}) AS s FROM t) WHERE s IS NOT NULL AND s <> t")
def singulars(spark: SparkSession, d: str) -> DataFrame:
    t = edges(spark, d).where("kind = 'term' and text is not null").select(F.lower("text").alias("t")).distinct()
    return t.select("t", F.explode(T.singulars("t")).alias("s"))


@query(sql(E, D) + """, t AS (SELECT DISTINCT lower(text) AS t FROM e WHERE kind = 'term' AND text IS NOT NULL),
v AS (SELECT t, 1 AS p, t AS k FROM t UNION ALL SELECT t, 2, regexp_replace(t, 's$', '') FROM t UNION ALL SELECT t, 3, t || 's' FROM t UNION ALL SELECT t, 4, regexp_replace(t, 'ies$', 'y') FROM t)
SELECT t, min(p) AS tier, arg_min(d.key, (p, d.key)) AS key FROM v JOIN d ON d.norm = v.k GROUP BY 1""")
def term_variants(spark: SparkSession, d: str) -> DataFrame:
    """Printed terms to definitions: as they are, without s, with s, ies as y."""
    t = edges(spark, d).where("kind = 'term' and text is not null").select(F.lower("text").alias("t")).distinct()
    forms = F.array(F.col("t"), F.regexp_replace("t", "s$", ""), F.concat("t", F.lit("s")), F.regexp_replace("t", "ies$", "y"))
    v = t.select("t", F.posexplode(forms).alias("p", "norm"))
    hit = v.join(definitions(spark, d).select("norm", "key"), "norm").groupBy("t").agg(F.min(F.struct(F.col("p") + 1, "key")).alias("m"))
    return hit.select("t", F.col("m.col1").alias("tier"), F.col("m.key").alias("key"))


@query(sql(E, D) + f""", t AS (SELECT DISTINCT lower(text) AS t FROM e WHERE kind = 'term' AND text IS NOT NULL),
v AS (SELECT t, 0 AS p, t AS k FROM t UNION ALL SELECT t, 1, unnest({_singular_sql('t')}) FROM t), h AS (SELECT t, min(p) AS p, arg_min(d.key, (p, d.key)) AS key FROM v JOIN d ON d.norm = v.k GROUP BY 1)
SELECT e.src, coalesce(h.key, e.dst) AS dst, CASE WHEN h.key IS NULL THEN 'kept' WHEN h.p = 0 THEN 'exact' ELSE 'singular' END AS how, count(*) AS n FROM e LEFT JOIN h ON h.t = lower(e.text) WHERE e.kind = 'term' GROUP BY 1, 2, 3""")
def term_rewire(spark: SparkSession, d: str) -> DataFrame:
    """Term edges led to the definition of their printed term: exact, else by a singular, else as stored."""
    e = edges(spark, d).where("kind = 'term'").withColumn("t", F.lower("text"))
    t = e.where("t is not null").select("t").distinct()
    v = t.select("t", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("p"), F.col("t").alias("norm"))), F.transform(T.singulars("t"), lambda x: F.struct(F.lit(1).alias("p"), x.alias("norm"))))).alias("v")).select("t", "v.p", "v.norm")
    h = v.join(definitions(spark, d).select("norm", "key"), "norm").groupBy("t").agg(F.min(F.struct("p", "key")).alias("m")).select("t", "m.p", "m.key")
    how = F.when(F.col("key").isNull(), "kept").when(F.col("p") == 0, "exact").otherwise("singular")
    return e.join(h, "t", "left").groupBy("src", F.coalesce("key", "dst").alias("dst"), how.alias("how")).agg(F.count("*").alias("n"))


_SEG = "CASE WHEN regexp_full_match(x, '\\([0-9]+\\)') THEN 's' || x[2:-2] WHEN regexp_full_match(x, '\\([a-z]\\)') THEN 'c-' || x[2:-2] WHEN regexp_full_match(x, '\\([ivxlc]+\\)') THEN 'sc-' || x[2:-2] ELSE regexp_replace(x, '[^A-Za-z0-9._-]', '-', 'g') END"


@query(sql(N) + f"SELECT id, p AS link, replace(p, '/', '__') AS anchor, p = permalink AS stored FROM (SELECT id, permalink, array_to_string(list_transform(string_split(id, '/'), lambda x: {_SEG}), '/') AS p FROM n)")
def permalink(spark: SparkSession, d: str) -> DataFrame:
    """Permalinks and anchors of all ids, and whether the stored one agrees."""
    return nodes(spark, d).select("id", T.permalink("id").alias("link"), T.anchor("id").alias("anchor"), (T.permalink("id") == F.col("permalink")).alias("stored"))


@query(sql(N) + "SELECT permalink, count(DISTINCT id) AS ids FROM n GROUP BY 1 HAVING count(DISTINCT id) > 1")
def permalink_unique(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).groupBy("permalink").agg(F.countDistinct("id").alias("ids")).where("ids > 1")


ESCAPED = "replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"
UNESCAPED = "replace(replace(replace(replace(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', chr(39)), '&#39;', chr(39)), '&nbsp;', chr(160)), '&deg;', chr(176)), '&amp;', '&')"


@query(f"SELECT text, {ESCAPED} AS escaped, {UNESCAPED} AS plain, text AS back FROM (SELECT DISTINCT text FROM cell WHERE text IS NOT NULL)")
def html_escape(spark: SparkSession, d: str) -> DataFrame:
    """Texts of cells escaped, with their entities resolved, and escaped and resolved again."""
    t = table(spark, d, "cell").where("text is not null").select("text").distinct().withColumn("escaped", T.html_escape("text"))
    return t.select("text", "escaped", T.html_unescape("text").alias("plain"), T.html_unescape("escaped").alias("back"))


LINK = "(?:https?://|www[.])[^\\s<>\"]+|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"


@query(f"""WITH t AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, rtrim(unnest(regexp_extract_all(text, '{LINK}')), '.,;:)') AS hit FROM t)
SELECT doc_id, count(*) AS links, min(CASE WHEN contains(hit, '@') AND NOT contains(hit, '/') THEN 'mailto:' || hit WHEN starts_with(hit, 'www.') THEN 'https://' || hit ELSE hit END) AS first FROM h GROUP BY 1 UNION ALL SELECT NULL, count(*), NULL FROM h""")
def url_links(spark: SparkSession, d: str) -> DataFrame:
    """Links and addresses in documents with the scheme they lack, per document, and in all."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", "text").distinct()
    h = t.select("doc_id", F.explode(T.links("text")).alias("link"))
    per = h.groupBy("doc_id").agg(F.count("*").alias("links"), F.min("link").alias("first"))
    return per.unionByName(h.agg(F.count("*").alias("links")).select(F.lit(None).cast("bigint").alias("doc_id"), "links", F.lit(None).cast("string").alias("first")))


@query(sql(N) + "SELECT key, list_position([" + ", ".join(f"'{r}'" for r in T.ROMAN) + "], number) AS value FROM n WHERE node_type = 'subclause' AND number IS NOT NULL")
def roman(spark: SparkSession, d: str) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(r) for r in T.ROMAN]), F.col("number"))
    return nodes(spark, d).where("node_type = 'subclause' and number is not null").select("key", F.nullif(place, F.lit(0)).alias("value"))


@query(sql(N) + "SELECT key, ascii(number) - 96 AS value, chr(ascii(number)) AS letter FROM n WHERE node_type IN ('clause', 'act_clause') AND length(number) = 1")
def letter_ordinal(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("node_type in ('clause', 'act_clause') and length(number) = 1").select("key", (F.ascii("number") - 96).alias("value"), F.char(F.ascii("number")).alias("letter"))


@query()
def tokenize(spark: SparkSession, d: str) -> DataFrame:
    """Stems of all headings and bodies with the number of nodes that have them; the stemmer has its own tests."""
    n = nodes(spark, d).select("key", F.explode(F.array_distinct(T.stems(F.concat_ws(" ", "heading", "body")))).alias("stem"))
    return n.groupBy("stem").agg(F.count("*").alias("nodes"))


@query("SELECT qid, array_to_string(list_transform(list_filter(regexp_extract_all(lower(q), '[0-9]+(?:[.][0-9]+)+|[a-z0-9]+'), lambda x: length(x) > 2), lambda x: '\"' || x || '\"'), ' OR ') AS match FROM evalset WHERE q IS NOT NULL")
def query_terms(spark: SparkSession, d: str) -> DataFrame:
    """Questions as disjunctions of their quoted words and dotted numbers."""
    words = F.filter(F.regexp_extract_all(F.lower("q"), F.lit("[0-9]+(?:[.][0-9]+)+|[a-z0-9]+"), F.lit(0)), lambda x: F.length(x) > 2)
    return table(spark, d, "evalset").where("q is not null").select("qid", F.array_join(F.transform(words, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), " OR ").alias("match"))


@query("SELECT DISTINCT qid, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(q), '[a-z]+'), lambda x: length(x) > 2 AND NOT list_contains([" + ", ".join(f"'{w}'" for w in T.STOP) + "], x)))), ' ') AS words FROM evalset WHERE q IS NOT NULL")
def content_words(spark: SparkSession, d: str) -> DataFrame:
    words = F.filter(F.regexp_extract_all(F.lower("q"), F.lit("[a-z]+"), F.lit(0)), lambda x: F.length(x) > 2)
    kept = F.sort_array(F.array_except(words, F.array(*[F.lit(w) for w in T.STOP])))
    return table(spark, d, "evalset").where("q is not null").select("qid", F.array_join(kept, " ").alias("words")).distinct()


@query(sql(N) + """SELECT key, CASE WHEN heading IS NOT NULL AND trim(heading) <> '' THEN heading WHEN length(s) <= 80 AND NOT starts_with(s, '(') AND NOT regexp_matches(s, '[.;:]$') THEN s END AS heading
FROM (SELECT key, heading, split_part(coalesce(body, ''), chr(10), 1) AS s FROM n)""")
def infer_heading(spark: SparkSession, d: str) -> DataFrame:
    """A node's heading, or the first line of its body where that looks like one."""
    s = F.split_part(F.coalesce("body", F.lit("")), F.lit("\n"), F.lit(1))
    good = (F.length("s") <= 80) & ~F.col("s").startswith("(") & ~F.col("s").rlike("[.;:]$")
    return nodes(spark, d).withColumn("s", s).select("key", F.when(F.col("heading").isNotNull() & (F.trim("heading") != ""), F.col("heading")).when(good, F.col("s")).alias("heading"))


PROJECTED = f"""pb AS (SELECT key, CASE WHEN length(s) > 600 AND node_type IN ('article', 'sentence') AND key IN (SELECT owner FROM owned WHERE how = 'edge') THEN trim(left(s, 600), {WS}) ELSE s END AS body
FROM (SELECT key, node_type, trim(body, {WS}) AS s FROM n WHERE body IS NOT NULL))"""


@query(sql(N, C, E, OWNED, PROJECTED) + "SELECT key, body FROM pb")
def project_body(spark: SparkSession, d: str) -> DataFrame:
    """Bodies, of which only those of an article or sentence that owns a table are cut: its cells stand for the tail."""
    owners = owned_tables(spark, d).where("how = 'edge'").select(F.col("owner").alias("key")).distinct().withColumn("owns", F.lit(True))
    b = nodes(spark, d).where("body is not null").select("key", "node_type", trimmed("body").alias("s")).join(owners, "key", "left")
    long = (F.length("s") > 600) & F.col("node_type").isin("article", "sentence") & F.col("owns")
    return b.select("key", F.when(long, trimmed(F.left("s", F.lit(600)))).otherwise(F.col("s")).alias("body"))


# Types of node that a trail names, and the length of an article's text after its trail.
TRAIL = ("division", "part", "section", "subsection", "appendix", "supplementary_standard", "act")
ARTICLE_CHARS = 1400


ARTICLES = f"""a AS (SELECT key FROM n WHERE node_type = 'article'),
tr AS (SELECT c.descendant AS key, string_agg(h.line, ' > ' ORDER BY c.depth DESC, h.rid) AS trail FROM c JOIN (SELECT key, rid, trim(concat_ws(' ', nullif(designator, ''), nullif(heading, '')), {WS}) AS line FROM n WHERE node_type IN {TRAIL}) h ON h.key = c.ancestor WHERE c.depth > 0 AND h.line <> '' GROUP BY 1),
sg AS (SELECT c.ancestor AS key, string_agg(s.seg, ' ' ORDER BY c.depth, s.rid) AS own FROM c JOIN (SELECT n.key, n.rid, trim(concat_ws(' ', nullif(n.designator, ''), nullif(n.heading, ''), nullif(pb.body, '')), {WS}) AS seg FROM n LEFT JOIN pb USING (key)) s ON s.key = c.descendant WHERE s.seg <> '' GROUP BY 1),
ce AS (SELECT o.owner AS key, string_agg(x.t, ' ' ORDER BY x.key, x.r, x.c, x.t) AS cells FROM owned o JOIN (SELECT {key_sql("table_id")} AS key, r, c, trim(text, {WS}) AS t FROM g) x ON x.key = o.bound WHERE x.t <> '' GROUP BY 1),
atx AS (SELECT a.key AS article, coalesce(tr.trail || chr(10), '') || left(concat_ws(' ', sg.own, ce.cells), {ARTICLE_CHARS}) AS text FROM a LEFT JOIN tr USING (key) LEFT JOIN sg USING (key) LEFT JOIN ce USING (key))"""


@query(sql(N, C, E, G, OWNED, PROJECTED, ARTICLES) + "SELECT article, text FROM atx")
def article_text(spark: SparkSession, d: str) -> DataFrame:
    """The text by which an article is found: its trail, and up to 1,400 characters of designators, headings and projected bodies of its subtree, then the cells of its tables."""
    n, c = nodes(spark, d), links(spark, d)
    a = n.where("node_type = 'article'").select("key")
    filled = lambda *cs: trimmed(F.concat_ws(" ", *[F.nullif(x, F.lit("")) for x in cs]))
    longest = F.lit(ARTICLE_CHARS)

    def gathered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
        # Each piece has a character and a space, so more than half as many pieces as characters are never seen.
        nth = F.row_number().over(Window.partitionBy("key").orderBy(*order))
        few = rows.withColumn("line", F.left("line", longest)).withColumn("nth", nth).where(F.col("nth") <= ARTICLE_CHARS // 2 + 1)
        return few.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "line"))), lambda x: x["line"]), " ").alias(name))

    heads = n.where(F.col("node_type").isin(*TRAIL)).select(F.col("key").alias("ancestor"), "rid", filled("designator", "heading").alias("line")).where("line <> ''")
    up = c.where("depth > 0").select(F.col("descendant").alias("key"), "ancestor", "depth").join(a, "key", "left_semi").join(heads, "ancestor")
    trail = up.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("up"), "rid", "line"))), lambda x: x["line"]), " > ").alias("trail"))
    pieces = n.join(project_body(spark, d).select("key", F.col("body").alias("safe")), "key", "left").select(F.col("key").alias("descendant"), "rid", filled("designator", "heading", "safe").alias("line")).where("line <> ''")
    own = gathered(c.withColumnRenamed("ancestor", "key").join(a, "key", "left_semi").join(pieces, "descendant"), ["depth", "rid"], "own")
    filling = cells(spark, d).select(id_key("table_id").alias("bound"), "r", "c", trimmed("text").alias("line")).where("line <> ''")
    inside = gathered(owned_tables(spark, d).withColumnRenamed("owner", "key").join(a, "key", "left_semi").join(filling, "bound"), ["bound", "r", "c", "line"], "cells")
    text = F.concat(F.coalesce(F.concat("trail", F.lit("\n")), F.lit("")), F.left(F.concat_ws(" ", "own", "cells"), longest))
    return a.join(trail, "key", "left").join(own, "key", "left").join(inside, "key", "left").select(F.col("key").alias("article"), text.alias("text"))


@query(sql(N) + "SELECT node_type, CAST(sum(length(body) // 4) AS BIGINT) AS tokens FROM n WHERE body IS NOT NULL GROUP BY 1")
def token_budget(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("body is not null").groupBy("node_type").agg(F.sum(F.floor(F.length("body") / 4)).alias("tokens"))


MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"


@query(sql(G) + f""", t AS (SELECT DISTINCT regexp_extract(text, '([0-9]{{1,2}} (?:{MONTH}) [0-9]{{4}})', 1) AS a, regexp_extract(text, '((?:{MONTH}) [0-9]{{1,2}}, [0-9]{{4}})', 1) AS b FROM g WHERE text IS NOT NULL)
SELECT a || b AS phrase, CAST(coalesce(try_strptime(nullif(a, ''), '%d %B %Y'), try_strptime(nullif(b, ''), '%B %d, %Y')) AS DATE) AS day FROM t WHERE a <> '' OR b <> ''""")
def date_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Dates printed as "16 January 2025" or "January 16, 2025"."""
    t = cells(spark, d).where("text is not null").select(F.regexp_extract("text", f"([0-9]{{1,2}} (?:{MONTH}) [0-9]{{4}})", 1).alias("a"), F.regexp_extract("text", f"((?:{MONTH}) [0-9]{{1,2}}, [0-9]{{4}})", 1).alias("b")).distinct().where("a <> '' or b <> ''")
    day = F.coalesce(F.try_to_timestamp(F.nullif("a", F.lit("")), F.lit("d MMMM yyyy")), F.try_to_timestamp(F.nullif("b", F.lit("")), F.lit("MMMM d, yyyy"))).cast("date")
    return t.select(F.concat("a", "b").alias("phrase"), day.alias("day"))


@query("SELECT strftime(to_timestamp(epoch(ts) // 86400 * 86400) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def build_date(spark: SparkSession, d: str) -> DataFrame:
    """Epoch seconds to printed days."""
    seconds = F.floor(F.unix_timestamp("ts") / 86400) * 86400
    return table(spark, d, "events").groupBy(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size || ' weeks' WHEN 1 THEN p_size || ' Days' WHEN 2 THEN p_size || ' weeks+' ELSE 'soon' END AS effort FROM part), f AS (SELECT *, regexp_replace(split_part(lower(effort), ' ', 1), '[^0-9.]', '', 'g') AS n FROM t)
SELECT p_partkey, effort, round(coalesce(TRY_CAST(nullif(n, '') AS DOUBLE), 1) / CASE WHEN contains(lower(effort), 'day') THEN 5 ELSE 1 END, 4) AS weeks FROM f""")
def effort_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Printed efforts in weeks: the figures of the first word (1 without any), five days to a week."""
    effort = F.expr("CASE p_size % 4 WHEN 0 THEN concat(p_size, ' weeks') WHEN 1 THEN concat(p_size, ' Days') WHEN 2 THEN concat(p_size, ' weeks+') ELSE 'soon' END")
    return table(spark, d, "part").select("p_partkey", effort.alias("effort")).withColumn("weeks", F.round(T.weeks("effort"), 4))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(CAST(l_quantity AS DECIMAL(18, 2)) / 4, 1) AS DOUBLE) AS q FROM lineitem")
def rd_bround(spark: SparkSession, d: str) -> DataFrame:
    """Rounding half to even."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.bround(F.col("l_quantity").cast("decimal(18,2)") / 4, 1).cast("double").alias("q"))


# Lookups by printed designator, in tiers.
@query(sql(N, E) + """, q AS (SELECT ref_id, split_part(src, '/', 1) AS vol, split_part(src, '/', 2) AS division, regexp_extract(text, '^([0-9]+(?:[.][0-9]+)*)', 1) AS num FROM e WHERE kind = 'code_ref' AND regexp_matches(text, '^[0-9]+[.]')),
b AS (SELECT split_part(key, '/', 1) AS vol, split_part(key, '/', 2) AS division, number, min(key) AS key FROM n WHERE number IS NOT NULL AND node_type IN ('part', 'section', 'subsection', 'article') GROUP BY 1, 2, 3),
p AS (SELECT q.*, unnest(range(1, len(string_split(num, '.')) + 1)) AS k FROM q), w AS (SELECT *, array_to_string(string_split(num, '.')[1:k], '.') AS want, len(string_split(num, '.')) - k AS dropped FROM p WHERE k >= 2 OR k = len(string_split(num, '.'))),
h AS (SELECT w.ref_id, CASE WHEN dropped = 0 AND b.division = w.division THEN 0 WHEN dropped = 0 THEN 1 ELSE 1 + dropped END AS tier, (CASE WHEN b.division = w.division THEN 0 ELSE 1 END, b.key) AS pick, b.key FROM w JOIN b ON b.vol = w.vol AND b.number = w.want WHERE dropped = 0 OR b.division = w.division)
SELECT q.ref_id, x.tier, x.key FROM q LEFT JOIN (SELECT ref_id, min(tier) AS tier, arg_min(key, (tier, pick)) AS key FROM h GROUP BY 1) x USING (ref_id)""")
def resolve_code(spark: SparkSession, d: str) -> DataFrame:
    """Printed numbers to nodes: exact in the own division, exact in another, else the nearest ancestor in the own; null when none.

    All candidates are exploded with their tier and met by one equi-join.
    """
    step = lambda c, i: F.split_part(c, F.lit("/"), F.lit(i))
    num = F.regexp_extract("text", "^([0-9]+(?:[.][0-9]+)*)", 1)
    q = edges(spark, d).where("kind = 'code_ref' and text rlike '^[0-9]+[.]'").select("ref_id", step("src", 1).alias("vol"), step("src", 2).alias("division"), F.split(num, "[.]").alias("a"))
    b = nodes(spark, d).where("number is not null and node_type in ('part', 'section', 'subsection', 'article')").groupBy(step("key", 1).alias("vol"), step("key", 2).alias("other"), F.col("number").alias("want")).agg(F.min("key").alias("key"))
    w = q.select("*", F.explode(F.sequence(F.lit(1), F.size("a"))).alias("k")).where("k >= 2 or k = size(a)").withColumns({"want": F.array_join(F.expr("slice(a, 1, k)"), "."), "dropped": F.size("a") - F.col("k")})
    own = F.col("other") == F.col("division")
    h = w.join(b, ["vol", "want"]).where((F.col("dropped") == 0) | own)
    tier = F.when((F.col("dropped") == 0) & own, 0).when(F.col("dropped") == 0, 1).otherwise(1 + F.col("dropped"))
    best = h.groupBy("ref_id").agg(F.min(F.struct(tier.alias("tier"), F.when(own, 0).otherwise(1).alias("o"), "key")).alias("m"))
    return q.select("ref_id").join(best, "ref_id", "left").select("ref_id", "m.tier", "m.key")


@query(sql(N, E) + """, q AS (SELECT ref_id, split_part(src, '/', 1) AS vol, split_part(src, '/', 2) AS division, upper(regexp_replace(regexp_replace(text, '^Table ', ''), '[-.\\s]', '', 'g')) AS des FROM e WHERE kind = 'cap_ref' AND text LIKE 'Table %'),
b AS (SELECT split_part(key, '/', 1) AS vol, split_part(key, '/', 2) AS division, upper(regexp_replace(designator, '[-.\\s]', '', 'g')) AS des, min(key) AS key FROM n WHERE node_type = 'table' GROUP BY 1, 2, 3)
SELECT q.ref_id, arg_min(b.key, (CASE WHEN b.division = q.division THEN 0 ELSE 1 END, b.key)) AS key FROM q LEFT JOIN b ON b.vol = q.vol AND b.des = q.des GROUP BY 1""")
def resolve_caption(spark: SparkSession, d: str) -> DataFrame:
    """Cited tables by normalised designator, in the own division first."""
    step = lambda c, i: F.split_part(c, F.lit("/"), F.lit(i))
    q = edges(spark, d).where("kind = 'cap_ref' and text like 'Table %'").select("ref_id", step("src", 1).alias("vol"), step("src", 2).alias("division"), F.upper(F.regexp_replace(F.regexp_replace("text", "^Table ", ""), r"[-.\s]", "")).alias("des"))
    b = nodes(spark, d).where("node_type = 'table'").groupBy(step("key", 1).alias("vol"), step("key", 2).alias("other"), T.normdes("designator").alias("des")).agg(F.min("key").alias("key"))
    own = F.when(F.col("other") == F.col("division"), 0).otherwise(1)
    return q.join(b, ["vol", "des"], "left").groupBy("ref_id").agg(F.min(F.when(F.col("key").isNotNull(), F.struct(own.alias("o"), "key"))).alias("m")).select("ref_id", "m.key")


@query(sql(N, E) + """, b AS (SELECT split_part(id, '/', 1) AS vol, split_part(id, '/', 2) AS name, upper(regexp_replace(split_part(id, '/', 2), '[-.\\s]', '', 'g')) AS norm, key FROM n WHERE node_type = 'supplementary_standard'),
q AS (SELECT DISTINCT split_part(upper(src), '/', 1) AS vol, text FROM e WHERE kind IN ('supp', 'std') AND text <> '' UNION SELECT vol, left(name, length(name) - 1) FROM b WHERE length(name) > 4 UNION SELECT vol, replace(name, '-', ' ') FROM b),
h AS (SELECT q.vol, q.text, 1 AS tier, b.key FROM q JOIN b ON b.vol = q.vol AND b.name = q.text UNION ALL SELECT q.vol, q.text, 2, b.key FROM q JOIN b ON b.vol = q.vol AND b.norm = upper(regexp_replace(q.text, '[-.\\s]', '', 'g'))
 UNION ALL SELECT q.vol, q.text, 3, min(b.key) FROM q JOIN b ON b.vol = q.vol AND starts_with(b.norm, upper(regexp_replace(q.text, '[-.\\s]', '', 'g'))) GROUP BY 1, 2 HAVING count(*) = 1)
SELECT q.vol, q.text, min(tier) AS tier, arg_min(key, (tier, key)) AS key FROM q LEFT JOIN h USING (vol, text) GROUP BY 1, 2""")
def resolve_std_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Standards by name: as printed, else without points, hyphens and blanks, else by a beginning that only one name has; null when none.

    Asked are all printed references, and each name without its last sign and with blanks for hyphens.
    """
    step = lambda c, i: F.split_part(c, F.lit("/"), F.lit(i))
    b = nodes(spark, d).where("node_type = 'supplementary_standard'").select(step("id", 1).alias("vol"), step("id", 2).alias("name"), "key").withColumn("norm", T.normdes("name"))
    printed = edges(spark, d).where("kind in ('supp', 'std') and text <> ''").select(step(F.upper("src"), 1).alias("vol"), "text")
    q = printed.unionByName(b.where("length(name) > 4").select("vol", F.expr("left(name, length(name) - 1)").alias("text"))).unionByName(b.select("vol", F.replace("name", F.lit("-"), F.lit(" ")).alias("text"))).distinct().withColumn("norm", T.normdes("text"))
    exact = q.join(b.select("vol", F.col("name").alias("text"), "key"), ["vol", "text"]).select("vol", "text", F.lit(1).alias("tier"), "key")
    same = q.join(b.select("vol", "norm", "key"), ["vol", "norm"]).select("vol", "text", F.lit(2).alias("tier"), "key")
    starts = b.select("vol", "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("norm")), lambda i: F.substring("norm", F.lit(1), i))).alias("norm"))
    only = q.join(starts, ["vol", "norm"]).groupBy("vol", "text").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1").select("vol", "text", F.lit(3).alias("tier"), "key")
    best = exact.unionByName(same).unionByName(only).groupBy("vol", "text").agg(F.min(F.struct("tier", "key")).alias("m"))
    return q.select("vol", "text").join(best, ["vol", "text"], "left").select("vol", "text", "m.tier", "m.key")


@query(sql(N, E) + """, q AS (SELECT ref_id, split_part(src, '/', 1) AS vol, regexp_extract(text, '^([0-9.]*[0-9])', 1) AS num, regexp_extract(text, '\\(([0-9]+)\\)', 1) AS s, regexp_extract(text, '\\(([a-z])\\)', 1) AS c FROM e WHERE kind = 'code_ref' AND regexp_matches(text, '^[0-9.]*[0-9][.]?\\([0-9]+\\)')),
a AS (SELECT split_part(key, '/', 1) AS vol, number, min(key) AS key FROM n WHERE node_type = 'article' GROUP BY 1, 2),
x AS (SELECT q.*, a.key AS article, a.key || '/(' || s || ')' AS sentence, a.key || '/(' || s || ')/(' || c || ')' AS clause FROM q JOIN a ON a.vol = q.vol AND a.number = q.num)
SELECT ref_id, coalesce(c.key, s.key, x.article) AS key FROM x LEFT JOIN n s ON s.key = x.sentence LEFT JOIN n c ON c.key = x.clause""")
def resolve_deepen(spark: SparkSession, d: str) -> DataFrame:
    """A cited article deepened to its sentence and clause where those exist."""
    step = lambda c, i: F.split_part(c, F.lit("/"), F.lit(i))
    q = edges(spark, d).where(r"kind = 'code_ref' and text rlike '^[0-9.]*[0-9][.]?\\([0-9]+\\)'").select("ref_id", step("src", 1).alias("vol"), F.regexp_extract("text", "^([0-9.]*[0-9])", 1).alias("number"), F.regexp_extract("text", r"\(([0-9]+)\)", 1).alias("s"), F.regexp_extract("text", r"\(([a-z])\)", 1).alias("c"))
    n = nodes(spark, d)
    a = n.where("node_type = 'article'").groupBy(step("key", 1).alias("vol"), "number").agg(F.min("key").alias("article"))
    x = q.join(a, ["vol", "number"]).withColumn("sentence", F.concat("article", F.lit("/("), "s", F.lit(")"))).withColumn("clause", F.concat("sentence", F.lit("/("), "c", F.lit(")")))
    keys = n.select("key")
    x = x.join(keys.withColumnRenamed("key", "sentence").withColumn("has_s", F.lit(True)), "sentence", "left").join(keys.withColumnRenamed("key", "clause").withColumn("has_c", F.lit(True)), "clause", "left")
    return x.select("ref_id", F.when(F.col("has_c"), F.col("clause")).when(F.col("has_s"), F.col("sentence")).otherwise(F.col("article")).alias("key"))


NOTES = """nt AS (SELECT split_part(key, '/', 1) AS vol, key, upper(regexp_replace(substr(key, length(split_part(key, '/', 1)) + length(split_part(key, '/', 2)) + 3), '[-./\\s]', '', 'g')) AS name FROM n WHERE split_part(key, '/', 2) = 'appa' AND split_part(key, '/', 3) <> ''),
nq AS (SELECT ref_id, split_part(src, '/', 1) AS vol, string_split(regexp_extract(text, 'A-([0-9.]*[0-9])', 1), '.') AS comps, regexp_extract(text, 'A-[0-9.]*[0-9][.]?((?:\\([0-9a-z]+\\))*)', 1) AS tail FROM e WHERE kind = 'note' AND regexp_matches(text, 'A-[0-9]')),
nk AS (SELECT *, unnest(range(1, len(comps) + 1)) AS k FROM nq), ns AS (SELECT *, 'A' || array_to_string(comps[1:k], '') AS stem, len(comps) - k AS dropped FROM nk)"""


@query(sql(N, E, NOTES) + """, h AS (SELECT ns.ref_id, dropped * 4 + 1 AS tier, min(nt.key) AS key FROM ns JOIN nt ON nt.vol = ns.vol AND nt.name = stem || CASE WHEN dropped = 0 THEN upper(tail) ELSE '' END GROUP BY 1, 2
 UNION ALL SELECT ns.ref_id, dropped * 4 + 2, min(nt.key) FROM ns JOIN nt ON nt.vol = ns.vol AND nt.name = stem GROUP BY 1, 2
 UNION ALL SELECT ns.ref_id, dropped * 4 + 3, min(nt.key) FROM ns JOIN nt ON nt.vol = ns.vol AND starts_with(nt.name, stem) GROUP BY 1, 2 HAVING count(*) = 1
 UNION ALL SELECT ns.ref_id, 4, arg_min(nt.key, (length(nt.name), nt.key)) FROM ns JOIN nt ON nt.vol = ns.vol AND starts_with(nt.name, stem) WHERE dropped = 0 GROUP BY 1)
SELECT nq.ref_id, min(tier) AS tier, arg_min(key, tier) AS key FROM nq LEFT JOIN h USING (ref_id) GROUP BY 1""")
def resolve_note_backoff(spark: SparkSession, d: str) -> DataFrame:
    """Cited notes to those of the volume's appendix, dropping number components from the end.

    At each length: the name with its tail of brackets, the bare stem, a name that alone begins so, and at full length the shortest that does; the first that is found counts. tier: 4 for each component dropped, plus the way.
    """
    vol = lambda c: F.split_part(c, F.lit("/"), F.lit(1))
    flat = lambda c: F.upper(F.regexp_replace(c, r"[-./\s]", ""))
    names = nodes(spark, d).where("split_part(key, '/', 2) = 'appa' and split_part(key, '/', 3) <> ''").select(vol("key").alias("vol"), "key", flat(F.expr("substr(key, length(split_part(key, '/', 1)) + length(split_part(key, '/', 2)) + 3)")).alias("name"))
    q = edges(spark, d).where("kind = 'note' and text rlike 'A-[0-9]'").select("ref_id", vol("src").alias("vol"), F.split(F.regexp_extract("text", "A-([0-9.]*[0-9])", 1), "[.]").alias("comps"), F.regexp_extract("text", r"A-[0-9.]*[0-9][.]?((?:\([0-9a-z]+\))*)", 1).alias("tail"))
    s = q.select("*", F.explode(F.sequence(F.lit(1), F.size("comps"))).alias("k")).select("ref_id", "vol", "tail", F.concat(F.lit("A"), F.array_join(F.expr("slice(comps, 1, k)"), "")).alias("stem"), (F.size("comps") - F.col("k")).alias("dropped"))
    tier = lambda way: (F.col("dropped") * 4 + way).cast("bigint").alias("tier")
    whole = s.withColumn("name", F.concat("stem", F.when(F.col("dropped") == 0, F.upper("tail")).otherwise(""))).join(names, ["vol", "name"]).groupBy("ref_id", tier(1)).agg(F.min("key").alias("key"))
    bare = s.withColumn("name", F.col("stem")).join(names, ["vol", "name"]).groupBy("ref_id", tier(2)).agg(F.min("key").alias("key"))
    starts = names.select("vol", "key", "name", F.explode(F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.substring("name", F.lit(1), i))).alias("stem"))
    # Names per beginning are counted once, so a beginning that many refs ask for meets one row.
    per = starts.groupBy("vol", "stem").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min(F.struct(F.length("name").alias("len"), "key")).alias("short"))
    met = s.join(per, ["vol", "stem"])
    only = met.where("n = 1").select("ref_id", tier(3), "key").distinct()
    short = met.where("dropped = 0").select("ref_id", F.lit(4).cast("bigint").alias("tier"), F.col("short.key").alias("key")).distinct()
    best = whole.unionByName(bare).unionByName(only).unionByName(short).groupBy("ref_id").agg(F.min(F.struct("tier", "key")).alias("m"))
    return q.select("ref_id").join(best, "ref_id", "left").select("ref_id", "m.tier", "m.key")


@query(sql(N, E) + """, f AS (SELECT e.dst AS tbl, e.src, s.rid, s.node_type FROM e JOIN n s ON s.key = e.src WHERE e.kind = 'cap_ref')
SELECT t.key AS tbl, arg_min(f.src, (CASE WHEN f.node_type IN ('article', 'sentence', 'clause') THEN 0 ELSE 1 END, f.rid)) AS forms_part_of, count(*) AS cites FROM n t JOIN f ON f.tbl = t.key WHERE t.node_type = 'table' GROUP BY 1""")
def forms_part_of(spark: SparkSession, d: str) -> DataFrame:
    """The provision a table forms part of: the first that cites it, provisions before other nodes."""
    n = nodes(spark, d)
    src = n.select(F.col("key").alias("src"), "rid", F.when(F.col("node_type").isin("article", "sentence", "clause"), 0).otherwise(1).alias("o"))
    f = edges(spark, d).where("kind = 'cap_ref'").join(src, "src").join(n.where("node_type = 'table'").select(F.col("key").alias("dst")), "dst", "left_semi")
    return f.groupBy(F.col("dst").alias("tbl")).agg(F.min(F.struct("o", "rid", "src")).alias("m"), F.count("*").alias("cites")).select("tbl", F.col("m.src").alias("forms_part_of"), "cites")
