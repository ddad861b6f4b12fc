"""Queries with window semantics: order, clusters, islands, sequences, first and last wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key
from lexigrove.functions.text import ROMAN
from lexigrove.operators import walks
from lexigrove.operators import windows as op
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import C, D, E, N, definitions, edges, key_sql, links, nodes, sql
from lexigrove.sources.tables import table

R = Registry()
query = R.query

LINES = """l AS (SELECT doc_id, unnest(range(len(a))) AS li, unnest(a) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL))"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, li, t): every line of every document."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("li", "t"))


@query(sql(LINES) + "SELECT doc_id, li, trim(t, concat(' ', chr(9), chr(13))) AS t FROM l")
def lines_of(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).withColumn("t", F.trim("t", F.lit(" \t\r")))


@query(sql(N) + """SELECT key, row_number() OVER (PARTITION BY volume, page ORDER BY floor(y0 / 60), round(y0, 1), x0, rid) AS place FROM n WHERE y0 IS NOT NULL""")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("volume", "page").orderBy(F.floor(F.col("y0") / 60), F.round("y0", 1), "x0", "rid")
    return nodes(spark, d).where("y0 is not null").select("key", F.row_number().over(w).alias("place"))


@query(sql(N) + """, j AS (SELECT *, CASE WHEN y0 - lag(y0) OVER (PARTITION BY volume, page ORDER BY y0, rid) > 60 THEN 1 ELSE 0 END AS jump FROM n WHERE y0 IS NOT NULL),
k AS (SELECT *, sum(jump) OVER (PARTITION BY volume, page ORDER BY y0, rid) AS cluster FROM j)
SELECT volume, page, cluster, count(*) AS n, min(y0) AS top, max(y0) AS bottom FROM k GROUP BY 1, 2, 3""")
def gap_cluster(spark: SparkSession, d: str) -> DataFrame:
    found = op.gap_clusters(nodes(spark, d).where("y0 is not null"), ["volume", "page"], "y0", 60, "rid")
    return found.groupBy("volume", "page", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("y0").alias("top"), F.max("y0").alias("bottom"))


@query()
def gap_cluster_start(spark: SparkSession, d: str) -> DataFrame:
    boxes = nodes(spark, d).where("y0 is not null").select("volume", "page", "rid", "y0")
    return op.gap_clusters_from_start(boxes, ["volume", "page"], "y0", 100, "rid").groupBy("volume", "page", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("y0").alias("top"), F.max("y0").alias("bottom"))


@query(sql(N, C, """lv AS (SELECT n.key, n.volume, n.rid, x.raw FROM n JOIN (SELECT descendant AS key, max(depth) AS raw FROM c GROUP BY 1) x USING (key))""", """s AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY rid) - 1 AS i FROM lv)""", """o AS (SELECT volume, i, key, CAST(0 AS BIGINT) AS level FROM s WHERE i = 0
UNION ALL SELECT s.volume, s.i, s.key, least(CAST(s.raw AS BIGINT), o.level + 1) FROM o JOIN s ON s.volume = o.volume AND s.i = o.i + 1)""", recursive=True) + "SELECT key, level FROM o")
def outline_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels of an outline in which none exceeds the one before by more than one; the oracle walks row by row."""
    raw = links(spark, d).groupBy(F.col("descendant").alias("key")).agg(F.max("depth").alias("raw"))
    return nodes(spark, d).join(raw, "key").select("key", op.clamped_levels(F.col("raw"), F.col("rid"), F.col("volume")).cast("bigint").alias("level"))


@query(sql(N) + """, f AS (SELECT volume, page, arg_min(number, rid) AS number FROM n WHERE page IS NOT NULL AND regexp_full_match(number, '[0-9A-Z.]*[0-9]{1,6}') GROUP BY 1, 2),
l AS (SELECT volume, page, regexp_extract(number, '^(.*?)[0-9]+$', 1) AS prefix, CAST(regexp_extract(number, '([0-9]+)$', 1) AS INTEGER) AS num FROM f),
r AS (SELECT *, page - num AS shift, page - row_number() OVER (PARTITION BY volume, prefix, page - num ORDER BY page) AS run FROM l)
SELECT volume, prefix, min(page) AS first, max(page) AS last, min(num) AS from_num, count(*) AS n FROM r GROUP BY volume, prefix, shift, run""")
def label_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of page labels: pages one after the other whose first number has the same prefix and goes up by one."""
    first = nodes(spark, d).where("page is not null and number rlike '^[0-9A-Z.]*[0-9]{1,6}$'").groupBy("volume", "page").agg(F.min_by("number", "rid").alias("number"))
    label = first.select("volume", "page", F.regexp_extract("number", "^(.*?)[0-9]+$", 1).alias("prefix"), F.regexp_extract("number", "([0-9]+)$", 1).cast("int").alias("num")).withColumn("shift", F.col("page") - F.col("num"))
    run = F.col("page") - F.row_number().over(Window.partitionBy("volume", "prefix", "shift").orderBy("page"))
    return label.withColumn("run", run).groupBy("volume", "prefix", "shift", "run").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.min("num").alias("from_num"), F.count("*").alias("n")).drop("shift", "run")


@query(sql(N) + """, p AS (SELECT volume, page, arg_min(key, rid) FILTER (WHERE node_type = 'part') AS own FROM n GROUP BY 1, 2),
f AS (SELECT volume, page, last_value(own IGNORE NULLS) OVER (PARTITION BY volume ORDER BY page ROWS UNBOUNDED PRECEDING) AS container FROM p),
r AS (SELECT *, CASE WHEN page - lag(page) OVER (PARTITION BY volume, container ORDER BY page) <= 3 THEN 0 ELSE 1 END AS new FROM f WHERE container IS NOT NULL),
s AS (SELECT *, sum(new) OVER (PARTITION BY volume, container ORDER BY page) AS run FROM r)
SELECT volume, container, min(page) AS first, max(page) AS last, count(*) AS n FROM s GROUP BY volume, container, run""")
def container_spans(spark: SparkSession, d: str) -> DataFrame:
    """Page spans of the parts: a page without a part of its own belongs to the one before; gaps up to three pages merge."""
    pages = nodes(spark, d).groupBy("volume", "page").agg(F.min_by("key", F.when(F.col("node_type") == "part", F.col("rid"))).alias("own"), F.count_if(F.col("node_type") == "part").alias("k"))
    pages = pages.withColumn("container", op.carry_forward(F.when(F.col("k") > 0, F.col("own")), ["volume"], ["page"])).where("container is not null")
    return op.islands(pages, ["volume", "container"], "page", 3)


@query(sql(N) + """, p AS (SELECT DISTINCT volume, page FROM n WHERE node_type = 'table'), r AS (SELECT *, page - row_number() OVER (PARTITION BY volume ORDER BY page) AS run FROM p),
b AS (SELECT volume, min(page) AS first, max(page) AS last FROM r GROUP BY volume, run)
SELECT volume, first, last, lead(first) OVER (PARTITION BY volume ORDER BY first) - 1 AS reach FROM b""")
def page_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of pages with tables; a block reaches to the page before the next one."""
    blocks = op.islands(nodes(spark, d).where("node_type = 'table' and page is not null"), ["volume"], "page")
    return blocks.select("volume", "first", "last", (F.lead("first").over(Window.partitionBy("volume").orderBy("first")) - 1).alias("reach"))


@query("""WITH p AS (SELECT regexp_replace(table_id, '#[0-9]+$', '') AS base, page, max(c + coalesce(colspan, 1)) AS ncols FROM cell WHERE table_id IS NOT NULL AND page IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN page - lag(page) OVER w <= 1 AND ncols = lag(ncols) OVER w THEN 0 ELSE 1 END AS new FROM p WINDOW w AS (PARTITION BY base ORDER BY page)),
s AS (SELECT *, sum(new) OVER (PARTITION BY base ORDER BY page) AS run FROM r)
SELECT base, run, min(page) AS first, max(page) AS last, max(ncols) AS ncols FROM s GROUP BY 1, 2""")
def stitch_runs(spark: SparkSession, d: str) -> DataFrame:
    """Parts of one table on neighbouring pages with as many columns make one run."""
    p = table(spark, d, "cell").where("table_id is not null and page is not null").groupBy(F.regexp_replace("table_id", "#[0-9]+$", "").alias("base"), "page").agg(F.max(F.col("c") + F.coalesce("colspan", F.lit(1))).alias("ncols"))
    w = Window.partitionBy("base").orderBy("page")
    new = F.when((F.col("page") - F.lag("page").over(w) <= 1) & (F.col("ncols") == F.lag("ncols").over(w)), 0).otherwise(1)
    return p.withColumn("new", new).withColumn("run", F.sum("new").over(w)).groupBy("base", "run").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.max("ncols").alias("ncols"))


@query(sql(LINES) + """, x AS (SELECT doc_id, t, concat_ws(' ', lead(t, 1) OVER w, lead(t, 2) OVER w, lead(t, 3) OVER w) AS ahead FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY li))
SELECT doc_id, count(*) FILTER (WHERE contains(ahead, 'shall')) AS valid, count(*) AS lines FROM x WHERE regexp_matches(t, '[A-Za-z]') AND length(t) < 60 GROUP BY 1""")
def lookahead_context(spark: SparkSession, d: str) -> DataFrame:
    """Short lines (captions) of which one of the next three lines states a rule."""
    w = Window.partitionBy("doc_id").orderBy("li")
    x = lines(spark, d).withColumn("ahead", F.concat_ws(" ", *[F.lead("t", k).over(w) for k in (1, 2, 3)]))
    return x.where("t rlike '[A-Za-z]' and length(t) < 60").groupBy("doc_id").agg(F.count_if(F.col("ahead").contains("shall")).alias("valid"), F.count(F.lit(1)).alias("lines"))


PLACE = f"""CASE WHEN node_type IN ('section', 'subsection', 'article') AND regexp_matches(number, '[0-9]{{1,6}}$') THEN CAST(regexp_extract(number, '([0-9]{{1,6}})$', 1) AS INTEGER) WHEN node_type = 'sentence' AND regexp_matches(number, '^[0-9]{{1,6}}([.][0-9]+)?$') THEN CAST(regexp_extract(number, '^([0-9]{{1,6}})', 1) AS INTEGER)
  WHEN node_type = 'clause' AND regexp_matches(number, '^[a-z]([.][0-9]+)?$') THEN CAST(ascii(number) - 96 AS INTEGER) WHEN node_type = 'subclause' THEN CAST(nullif({{roman}}, 0) AS INTEGER) END"""


@query(sql(N) + f""", k AS (SELECT up, node_type, {PLACE.replace("{roman}", "list_position([" + ", ".join(f"'{r}'" for r in ROMAN) + "], number)")} AS k, body FROM n WHERE up IS NOT NULL),
one AS (SELECT up, any_value(node_type) AS node_type, max(k) AS top, bool_or(coalesce(regexp_matches(body, 'Reserved|REPEALED|Repealed'), false)) AS excused FROM k GROUP BY 1 HAVING count(*) >= 2 AND count(DISTINCT node_type) = 1 AND max(k) IS NOT NULL)
SELECT up, node_type, want, excused FROM (SELECT up, node_type, excused, unnest(range(1, top + 1)) AS want FROM one) w WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.up = w.up AND k.k = w.want)""")
def numbering_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Numbers missing from 1 to the largest under each parent whose children are of one kind; excused where a child says reserved or repealed."""
    place = F.expr(PLACE.replace("{roman}", f"array_position(array({', '.join(repr(r) for r in ROMAN)}), number)").replace("regexp_matches(", "regexp_like("))
    k = nodes(spark, d).where("up is not null").select("up", "node_type", place.alias("want"), "body")
    excused = F.bool_or(F.coalesce(F.col("body").rlike("Reserved|REPEALED|Repealed"), F.lit(False)))
    one = k.groupBy("up").agg(F.count("*").alias("n"), F.countDistinct("node_type").alias("kinds"), F.min("node_type").alias("node_type"), F.max("want").alias("top"), excused.alias("excused")).where("n >= 2 and kinds = 1 and top is not null")
    return one.select("up", "node_type", "excused", F.explode(F.sequence(F.lit(1), "top")).alias("want")).join(k.select("up", "want"), ["up", "want"], "left_anti")


FOLD = "regexp_replace(lower(coalesce(heading, '')), '[^a-z0-9]', '', 'g')"


@query(sql(N) + f""", x AS (SELECT rid, {FOLD} AS k, lead({FOLD}) OVER (PARTITION BY volume ORDER BY rid) AS nk, lead(rid) OVER (PARTITION BY volume ORDER BY rid) AS next_rid FROM n WHERE node_type = 'index_entry')
SELECT rid, next_rid FROM x WHERE nk < k""")
def collation_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring index entries out of order."""
    w = Window.partitionBy("volume").orderBy("rid")
    k = F.regexp_replace(F.lower(F.coalesce("heading", F.lit(""))), "[^a-z0-9]", "")
    x = nodes(spark, d).where("node_type = 'index_entry'").withColumn("k", k)
    return x.withColumns({"nk": F.lead("k").over(w), "next_rid": F.lead("rid").over(w)}).where("nk < k").select("rid", "next_rid")


@query(sql(N) + "SELECT volume, max(page) FILTER (WHERE node_type IN ('article', 'section', 'act_section')) AS structural, max(page) AS last, max(page) - max(page) FILTER (WHERE node_type IN ('article', 'section', 'act_section')) AS trailing FROM n GROUP BY 1")
def trailing_run(spark: SparkSession, d: str) -> DataFrame:
    s = F.max(F.when(F.col("node_type").isin("article", "section", "act_section"), F.col("page")))
    return nodes(spark, d).groupBy("volume").agg(s.alias("structural"), F.max("page").alias("last"), (F.max("page") - s).alias("trailing"))


@query()
def lnds_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Definitions of each text that make a longest alphabetical chain in order of their offset."""
    rows = definitions(spark, d).where("blob is not null and norm is not null").select("blob", "body_offset", "norm", "id")
    return op.boundary_chain(rows, "blob", "body_offset", "norm")


BLOB = "b AS (SELECT blob, string_agg(body, ' ' ORDER BY body_offset, id) AS t FROM d WHERE blob IS NOT NULL AND body IS NOT NULL GROUP BY 1)"
# How a definition begins, in codes (a capitalised term of up to six words, a qualifier in brackets) and in acts (a quoted term), and its least length.
CODE_BOUNDARY = r"[A-Z][A-Za-z0-9\x{2019}-]*(?:[ -][A-Za-z0-9\x{2019}-]+){0,5}?(?:[ \n]*\([^)]{1,40}\))?[ \n]+means\b"
ACT_BOUNDARY = r"[\x{201c}\"][^\x{201d}\"]{2,60}[\x{201d}\"][ \n]*,?[ \n]*means\b"
BOUNDARY = f"(?:{CODE_BOUNDARY}|{ACT_BOUNDARY})"
LEAST = 12


def _pieces(spark: SparkSession, d: str, before: str) -> DataFrame:
    """(blob, a): the pieces of each blob's text, cut at the boundaries with `before` in front."""
    texts = definitions(spark, d).where("blob is not null and body is not null").groupBy("blob").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("body_offset", "id", "body"))), lambda x: x["body"]), " ").alias("t"))
    pieces = F.split(F.regexp_replace("t", f"{before}({BOUNDARY})", "$1\x01$2"), "\x01")
    return texts.select("blob", F.filter(F.transform(pieces, lambda x: F.trim(x)), lambda x: F.length(x) >= LEAST).alias("a"))


@query(sql(D, BLOB) + f""", a AS (SELECT blob, list_filter(string_split(regexp_replace(t, '(^|[^A-Za-z])({BOUNDARY})', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: length(trim(x)) >= {LEAST}) AS a FROM b)
SELECT blob, unnest(range(len(a))) AS ord, trim(unnest(a)) AS piece FROM a""")
def split_definitions(spark: SparkSession, d: str) -> DataFrame:
    """The text of each blob cut where the next definition begins."""
    return _pieces(spark, d, "(^|[^A-Za-z])").select("blob", F.posexplode("a").alias("ord", "piece"))


@query(sql(D, BLOB) + f""", a AS (SELECT blob, list_filter(string_split(regexp_replace(t, '([.;)][ \\n\\t]{{1,5}})({BOUNDARY})', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: length(trim(x)) >= {LEAST}) AS a FROM b)
SELECT blob, unnest(range(len(a))) AS ord, trim(unnest(a)) AS piece FROM a""")
def resplit(spark: SparkSession, d: str) -> DataFrame:
    """The second pass: a boundary counts only where a full stop, semicolon or closing bracket stands within six characters before it."""
    return _pieces(spark, d, r"([.;)][ \n\t]{1,5})").select("blob", F.posexplode("a").alias("ord", "piece"))


@query(sql(D) + f"SELECT marks, count(*) AS definitions, marks <= 1 AS holds, min(key) AS sample FROM (SELECT key, len(regexp_extract_all(body, '(?:^|[^A-Za-z]){BOUNDARY}')) AS marks FROM d WHERE body IS NOT NULL) GROUP BY 1")
def definition_multi(spark: SparkSession, d: str) -> DataFrame:
    """How many boundaries definitions hold; more than one means that a definition holds another."""
    n = F.size(F.regexp_extract_all("body", F.lit(f"(?:^|[^A-Za-z]){BOUNDARY}"), F.lit(0)))
    return definitions(spark, d).where("body is not null").select("key", n.alias("marks")).groupBy("marks").agg(F.count("*").alias("definitions"), F.min("key").alias("sample")).withColumn("holds", F.col("marks") <= 1)


@query("SELECT qid, lower(trim(q)) AS k FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(q)) ORDER BY qid, added_at) AS rn FROM evalset WHERE q IS NOT NULL) WHERE rn = 1")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """The first record of each question; the smallest id wins by a partial aggregate, so a hot question isn't gathered."""
    return table(spark, d, "evalset").where("q is not null").groupBy(F.lower(F.trim("q")).alias("k")).agg(F.min("qid").alias("qid"))


@query(sql(E) + "SELECT src, dst, k FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS k FROM (SELECT DISTINCT src, dst FROM e WHERE dst IS NOT NULL)) WHERE k <= 12")
def links_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first twelve links of each node, the number that a rendered page shows."""
    e = edges(spark, d).where("dst is not null").select("src", "dst").distinct()
    return e.withColumn("k", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).where("k <= 12")


@query("SELECT id, rid, epoch_us(loaded_at) AS loaded_us, epoch_us(deleted_at) AS deleted_us FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, deleted_at ASC NULLS FIRST, rid) AS rn FROM node) WHERE rn = 1")
def upsert_last(spark: SparkSession, d: str) -> DataFrame:
    """Insert-or-replace: the last state of each id."""
    w = Window.partitionBy("id").orderBy(F.desc("loaded_at"), F.asc_nulls_first("deleted_at"), "rid")
    return table(spark, d, "node").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("id", "rid", F.unix_micros("loaded_at").alias("loaded_us"), F.unix_micros("deleted_at").alias("deleted_us"))


@query(sql(N) + "SELECT number, arg_min(key, rid) AS key FROM n WHERE number IS NOT NULL GROUP BY 1")
def first_wins_map(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("number is not null").groupBy("number").agg(F.min_by("key", "rid").alias("key"))


@query(sql(N, E) + """, p AS (SELECT number, min(page) AS page FROM n WHERE node_type IN ('section', 'subsection', 'article') GROUP BY 1) SELECT e.ref_id, p.page FROM e JOIN p ON p.number = rtrim(e.text, '.')""")
def page_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Printed number to the first page that carries it."""
    first = nodes(spark, d).where("node_type in ('section', 'subsection', 'article')").groupBy("number").agg(F.min("page").alias("page"))
    return edges(spark, d).select("ref_id", F.rtrim("text", F.lit(".")).alias("number")).join(first, "number").select("ref_id", "page")


@query(sql(N, """k AS (SELECT up, key, number, row_number() OVER (PARTITION BY up ORDER BY rid, key) AS i, regexp_full_match(number, '[0-9]+[.][0-9]+') AS ins FROM n WHERE node_type = 'sentence' AND regexp_full_match(number, '[0-9]{1,6}([.][0-9]+)?') AND up IS NOT NULL),
w AS (SELECT up, i, key, number, 1 AS expected, ins OR number = '1' AS ok, CASE WHEN NOT ins AND number = '1' THEN 2 ELSE 1 END AS next FROM k WHERE i = 1
 UNION ALL SELECT k.up, k.i, k.key, k.number, w.next, k.ins OR k.number = CAST(w.next AS VARCHAR), CASE WHEN NOT k.ins AND k.number = CAST(w.next AS VARCHAR) THEN w.next + 1 ELSE w.next END FROM w JOIN k ON k.up = w.up AND k.i = w.i + 1)""", recursive=True)
 + "SELECT key, number, expected, ok FROM w")
def marker_sequence(spark: SparkSession, d: str) -> DataFrame:
    """A marker holds where it is the next number under its parent or a decimal insertion; one that doesn't hold leaves the next number as it is."""
    k = nodes(spark, d).where("node_type = 'sentence' and number rlike '^[0-9]{1,6}([.][0-9]+)?$' and up is not null").select("up", "rid", "key", "number")
    return walks.ordered_fold(k, "up", ["rid", "key"], walks.accepted_markers, "key string, number string, expected int, ok boolean")


@query(sql(N) + "SELECT key, number, split_part(number, '.', 1) = split_part(key, '/', 3) AS own FROM n WHERE node_type IN ('section', 'subsection', 'article') AND number IS NOT NULL AND split_part(key, '/', 2) IN ('a', 'b', 'c')")
def part_guard(spark: SparkSession, d: str) -> DataFrame:
    """Whether the number of a head begins with the number of its part; one that doesn't is text, no head."""
    n = nodes(spark, d).where("node_type in ('section', 'subsection', 'article') and number is not null")
    step = lambda i: F.split_part("key", F.lit("/"), F.lit(i))
    return n.where(step(2).isin("a", "b", "c")).select("key", "number", (F.split_part("number", F.lit("."), F.lit(1)) == step(3)).alias("own"))


@query(f"SELECT {key_sql('dst')} AS dst, count(*) AS n, epoch_us(min(seen_at)) AS first_us, epoch_us(max(seen_at)) AS last_us FROM (SELECT DISTINCT ref_id, dst, seen_at FROM ref) GROUP BY 1")
def ref_activity(spark: SparkSession, d: str) -> DataFrame:
    """How often and when each target was cited; a hot target is combined before the shuffle."""
    return table(spark, d, "ref").select("ref_id", "dst", "seen_at").distinct().groupBy(id_key("dst").alias("dst")).agg(F.count(F.lit(1)).alias("n"), F.unix_micros(F.min("seen_at")).alias("first_us"), F.unix_micros(F.max("seen_at")).alias("last_us"))
