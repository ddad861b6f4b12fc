"""Context bundles in long form: what a reader of a node needs, by section, cut to a budget and rendered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions.ids import id_key, trimmed
from lexigrove.functions.rules import MODALITY_RENDERED, first_match, first_match_sql
from lexigrove.operators import graph as op
from lexigrove.plans.aggregates import table_text
from lexigrove.plans.graph import OWNED, owned_tables
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import C, D, E, G, N, WS, definitions, edges, key_sql, links, nodes, sql

R = Registry()
query = R.query

SECTIONS = ["anchor", "ancestors", "text", "terms", "cites", "notes", "tables", "standards", "amendments", "cited_by", "unresolved"]
LEAF = ("sentence", "clause", "subclause", "act_subsection", "act_clause", "act_subclause")
# The label of each kind that a bundle follows; dependencies above which a node is delivered by reference; rows of an own table
# that are always kept, shown at most, and shown at most of a hub; characters of a flat body, a term, a cited text, a note, a figure; places that cite.
LABELS = {"code_ref": "cites", "note": "explanatory note", "std": "referenced standard", "cap_ref": "table/figure caption", "act_ref": "Building Code Act", "supp": "supplementary standard"}
HUB, MUST_ROWS, MOST_ROWS, HUB_ROWS = 50, 15, 25, 10
FLAT, TERM, CITE, NOTE, FIGURE, CITED_BY = 600, 400, 400, 700, 600, 40
#: Lines of classes up to MUST are never dropped; of the others the last class goes first, within a class the last line.
MUST = 8
BUDGET = 1_000
#: A definition longer than this is the clause that contains one.
BLOB_CHARS = 1_500
MARK = r"O[.] Reg[.](?: [0-9]+/[0-9]+)?"


def _grid_sql(most: str) -> str:
    return f"string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE nth <= {most}) || CASE WHEN max(total) > {most} THEN chr(10) || '... ' || (max(total) - {most}) || ' further rows' ELSE '' END"


TITLE = "concat_ws(' ', coalesce(n.designator, n.id), n.heading)"
BUNDLE = f"""sc AS (SELECT ancestor AS anchor, descendant AS src, depth FROM c WHERE ancestor IN (SELECT key FROM n)),
og AS (SELECT DISTINCT sc.anchor, e.src, e.kind, e.dst, e.text FROM sc JOIN e ON e.src = sc.src WHERE e.dst IS NOT NULL),
dp AS (SELECT DISTINCT anchor, dst FROM og), hb AS (SELECT anchor FROM dp GROUP BY 1 HAVING count(*) > {HUB}),
rw AS (SELECT key, line, row_number() OVER (PARTITION BY key ORDER BY r, line) AS nth, count(*) OVER (PARTITION BY key) AS total FROM (SELECT {key_sql("table_id")} AS key, r, string_agg(trim(regexp_replace(coalesce(text, ''), '[ \\n\\r\\t]+', ' ', 'g')), ' | ' ORDER BY c) AS line FROM g GROUP BY table_id, r)),
gr AS (SELECT key, {_grid_sql(str(MOST_ROWS))} AS grid, {_grid_sql(str(HUB_ROWS))} AS hub_grid, string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE nth <= {MUST_ROWS}) AS must,
  string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE nth > {MUST_ROWS} AND nth <= {MOST_ROWS}) || CASE WHEN max(total) > {MOST_ROWS} THEN chr(10) || '... ' || (max(total) - {MOST_ROWS}) || ' further rows' ELSE '' END AS more FROM rw GROUP BY key),
ot AS (SELECT o.owner AS anchor, n.key, n.rid, {TITLE} AS title FROM owned o JOIN n ON n.key = o.bound WHERE o.owner IN (SELECT key FROM n)),
fo AS (SELECT og.anchor, og.dst, min(og.kind) AS kind, min(og.text) AS text FROM og WHERE og.kind IN ({", ".join(f"'{k}'" for k in LABELS)}) AND og.anchor NOT IN (SELECT anchor FROM hb)
  AND (og.anchor, og.dst) NOT IN (SELECT anchor, src FROM sc) AND (og.anchor, og.dst) NOT IN (SELECT anchor, key FROM ot) GROUP BY 1, 2),
fx AS (SELECT fo.*, n.rid, n.node_type, {TITLE} AS title, coalesce(n.body, '') AS body, CASE fo.kind {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())} END AS via,
  CASE WHEN fo.kind = 'note' THEN 'notes' WHEN fo.kind IN ('std', 'supp') THEN 'standards' WHEN n.node_type IN ('table', 'figure') THEN 'tables' ELSE 'cites' END AS section FROM fo JOIN n ON n.key = fo.dst),
flat AS (SELECT key, node_type, rid, trim(coalesce(body, ''), {WS}) AS body, CASE WHEN length(trim(coalesce(body, ''), {WS})) > {FLAT} AND node_type IN ('article', 'sentence') AND key IN (SELECT owner FROM owned WHERE how = 'edge') THEN trim(left(trim(body, {WS}), {FLAT}), {WS}) || ' ... [further characters: the table below]' ELSE trim(coalesce(body, ''), {WS}) END AS shown, heading FROM n),
ln AS (SELECT n.key AS anchor, 1 AS class, 'anchor' AS section, n.rid AS ord, n.key AS item, {TITLE} AS line FROM n
 UNION ALL SELECT c.descendant, 2, 'ancestors', -c.depth, n.key, {TITLE} FROM c JOIN n ON n.key = c.ancestor WHERE c.depth > 0 AND c.descendant IN (SELECT key FROM n)
 UNION ALL SELECT sc.anchor, 3, 'text', f.rid, f.key, concat_ws(' ', nullif(f.heading, ''), nullif(f.shown, '')) || CASE WHEN f.body = '' OR f.node_type NOT IN {LEAF} OR m = 'statement' THEN '' ELSE ' [' || m || ']' END
   FROM sc JOIN (SELECT *, {first_match_sql("body", MODALITY_RENDERED, "statement")} AS m FROM flat WHERE body <> '' OR coalesce(heading, '') <> '') f ON f.key = sc.src
 UNION ALL SELECT og.anchor, 4, 'terms', row_number() OVER (PARTITION BY og.anchor ORDER BY og.dst), og.dst, d.term || ': ' || left(coalesce(d.body, ''), {TERM}) FROM (SELECT DISTINCT anchor, dst FROM og WHERE kind = 'term') og JOIN d ON d.key = og.dst
 UNION ALL SELECT ot.anchor, 5, 'tables', ot.rid, ot.key, title || coalesce(chr(10) || CASE WHEN ot.anchor IN (SELECT anchor FROM hb) THEN hub_grid ELSE must END, '') FROM ot LEFT JOIN gr USING (key)
 UNION ALL SELECT ot.anchor, 9, 'tables', -ot.rid, ot.key, more FROM ot JOIN gr USING (key) WHERE more IS NOT NULL AND ot.anchor NOT IN (SELECT anchor FROM hb)
 UNION ALL SELECT x.anchor, 6, 'amendments', x.rid, x.key, x.id || ': ' || x.mark FROM (SELECT sc.anchor, n.key, n.rid, n.id, unnest(regexp_extract_all(n.body, '{MARK}')) AS mark FROM sc JOIN n ON n.key = sc.src WHERE n.body LIKE '%O. Reg.%') x
 UNION ALL SELECT sc.anchor, 7, 'unresolved', e.ref_id, NULL, '"' || coalesce(e.text, '') || '" (' || coalesce(e.kind, '') || ') - ' || coalesce(e.reason, '') FROM sc JOIN e ON e.src = sc.src WHERE e.dst IS NULL
 UNION ALL SELECT hb.anchor, 8, 'anchor', 0, NULL, 'delivered by reference: more than {HUB} dependencies' FROM hb
 UNION ALL SELECT anchor, CASE section WHEN 'notes' THEN 10 WHEN 'cites' THEN 11 WHEN 'tables' THEN 12 ELSE 13 END, section, rid, dst, CASE section WHEN 'notes' THEN title || ': ' || left(body, {NOTE}) WHEN 'cites' THEN title || ' (' || via || '): ' || left(body, {CITE})
   WHEN 'tables' THEN title || ' (' || via || ')' || CASE WHEN gr.grid IS NOT NULL THEN chr(10) || gr.grid WHEN body <> '' THEN chr(10) || left(body, {FIGURE}) ELSE '' END ELSE coalesce(nullif(fx.text, ''), title) END FROM fx LEFT JOIN gr ON gr.key = fx.dst
 UNION ALL SELECT anchor, 14, 'cited_by', rid, key, title FROM (SELECT x.anchor, n.key, n.rid, {TITLE} AS title, row_number() OVER (PARTITION BY x.anchor ORDER BY n.rid, n.key) AS k FROM (SELECT DISTINCT sc.anchor, e.src FROM sc JOIN e ON e.dst = sc.src) x JOIN n ON n.key = x.src WHERE n.node_type NOT IN ('table', 'figure')) WHERE k <= {CITED_BY}),
bl AS (SELECT anchor, class, section, ord, item, line, 1 + length(line) // 4 AS size FROM (SELECT DISTINCT * FROM ln)),
kept AS (SELECT * FROM (SELECT *, sum(size) OVER (PARTITION BY anchor ORDER BY class, ord, line ROWS UNBOUNDED PRECEDING) AS running FROM bl) WHERE running <= {BUDGET} OR class <= {MUST})"""
WHOLE = (N, C, E, D, G, OWNED, BUNDLE)


def grids(spark: SparkSession, d: str) -> DataFrame:
    """(key, grid, hub_grid, must, more): the rows of each table as text, cut at the row limits with the number of rows left out."""
    # Rows of a table beyond the limit are only counted, so a very long table is never gathered.
    rows = table_text(spark, d).select(id_key("table_id").alias("key"), "r", "line")
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("total"))
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("r", "line"))).where(F.col("nth") <= MOST_ROWS)
    lines = first.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "line"))), lambda x: x["line"]).alias("a")).join(counted, "key")
    more = lambda n: F.when(F.col("total") > n, F.concat(F.lit("\n... "), (F.col("total") - n).cast("string"), F.lit(" further rows"))).otherwise("")
    cut = lambda n: F.array_join(F.slice("a", 1, n), "\n")
    rest = F.when(F.size("a") > MUST_ROWS, F.concat(F.array_join(F.slice("a", MUST_ROWS + 1, MOST_ROWS), "\n"), more(MOST_ROWS)))
    return lines.select("key", F.concat(cut(MOST_ROWS), more(MOST_ROWS)).alias("grid"), F.concat(cut(HUB_ROWS), more(HUB_ROWS)).alias("hub_grid"), cut(MUST_ROWS).alias("must"), rest.alias("more"))


def _reached(scope: DataFrame, e: DataFrame, n: DataFrame, own: DataFrame, hubs: DataFrame, hops: int) -> DataFrame:
    """(anchor, dst, kind, text): what edges of labelled kinds lead to from the subtree of anchors that are no hubs; further hops go on from cited provisions."""
    followed = e.where(F.col("kind").isin(*LABELS) & F.col("dst").isNotNull()).select("src", "dst", "kind", "text")
    seen = scope.select("anchor", F.col("src").alias("dst")).unionByName(own.select("anchor", F.col("key").alias("dst")))
    frontier, found = scope.select("anchor", "src").join(hubs, "anchor", "left_anti"), []
    types = n.select(F.col("key").alias("dst"), "node_type")
    for _ in range(hops):
        step = frontier.join(followed, "src").groupBy("anchor", "dst").agg(F.min("kind").alias("kind"), F.min("text").alias("text")).join(seen, ["anchor", "dst"], "left_anti")
        found.append(step)
        seen = seen.unionByName(step.select("anchor", "dst"))
        frontier = step.where(~F.col("kind").isin("note", "std", "supp")).join(types, "dst").where("node_type not in ('table', 'figure')").select("anchor", F.col("dst").alias("src"))
    return reduce(DataFrame.unionByName, found) if found else scope.select("anchor", F.col("src").alias("dst"), F.lit("").alias("kind"), F.lit("").alias("text")).where("false")


def bundle_lines(spark: SparkSession, d: str, anchor: Column | None = None, hops: int = 1) -> DataFrame:
    """(anchor, class, section, ord, item, line, size) of the bundles of all live nodes, or of one anchor.

    All eleven sections: the anchor, its ancestors, the text of its subtree (bodies that a table replaces are cut, leaves carry their modality),
    terms, cited provisions, notes, tables and figures with their rows, standards, amendments, what cites it, unresolved references. A node with more than
    HUB dependencies is delivered by reference: what it cites is not expanded. size is in approximate tokens, item the id that a line stands for.
    """
    n, e, c = nodes(spark, d), edges(spark, d), links(spark, d)
    only = lambda df, name: df if anchor is None else df.where(F.col(name) == anchor)
    title = F.concat_ws(" ", F.coalesce("designator", "id"), "heading").alias("title")
    named = n.select("key", "rid", "node_type", title, F.coalesce("body", F.lit("")).alias("body"))
    a = only(named.withColumn("anchor", F.col("key")), "anchor")
    keys = a.select("anchor")
    scope = only(c, "ancestor").select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("src")).join(keys, "anchor", "left_semi")
    out = scope.join(e.where("dst is not null").select("src", "kind", "dst"), "src")
    hubs = out.select("anchor", "dst").distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("deps")).where(F.col("deps") > HUB).select("anchor")
    own = only(owned_tables(spark, d), "owner").select(F.col("owner").alias("anchor"), F.col("bound").alias("key")).join(keys, "anchor", "left_semi").join(named, "key")
    grid = grids(spark, d)

    def part(class_: Column | int, section: Column | str, rows: DataFrame, line: Column, order: Column | str = "rid", item: Column | str | None = "key") -> DataFrame:
        c_, s_ = (F.lit(x) if isinstance(x, (int, str)) else x for x in (class_, section))
        o_, i_ = F.col(order) if isinstance(order, str) else order, F.lit(None).cast("string") if item is None else F.col(item) if isinstance(item, str) else item
        return rows.select("anchor", c_.alias("class"), s_.alias("section"), o_.cast("bigint").alias("ord"), i_.alias("item"), line.alias("line"))

    above = only(c.where("depth > 0"), "descendant").select(F.col("descendant").alias("anchor"), F.col("ancestor").alias("key"), "depth").join(keys, "anchor", "left_semi").join(named, "key")
    owners = owned_tables(spark, d).where("how = 'edge'").select(F.col("owner").alias("key"), F.lit(True).alias("owns")).distinct()
    flat = n.select("key", "id", "rid", "node_type", "heading", trimmed(F.coalesce("body", F.lit(""))).alias("body")).where("body <> '' or coalesce(heading, '') <> ''").join(owners, "key", "left")
    cut_ = (F.length("body") > FLAT) & F.col("node_type").isin("article", "sentence") & F.col("owns")
    shown = F.when(cut_, F.concat(trimmed(F.left("body", F.lit(FLAT))), F.lit(" ... [further characters: the table below]"))).otherwise(F.col("body"))
    mode = first_match(F.col("body"), MODALITY_RENDERED, "statement")
    tag = F.when((F.col("body") == "") | ~F.col("node_type").isin(*LEAF) | (mode == "statement"), "").otherwise(F.concat(F.lit(" ["), mode, F.lit("]")))
    text = flat.select(F.col("key").alias("src"), "id", "rid", "body", F.concat(F.concat_ws(" ", F.nullif("heading", F.lit("")), F.nullif(shown, F.lit(""))), tag).alias("line"))
    bodies = scope.join(text, "src")
    marks = bodies.where(F.col("body").contains("O. Reg.")).select("anchor", "rid", "id", F.col("src").alias("key"), F.explode(F.regexp_extract_all("body", F.lit(MARK), F.lit(0))).alias("mark"))
    meant = definitions(spark, d).select(F.col("key").alias("dst"), "term", F.coalesce("body", F.lit("")).alias("body"))
    terms = out.where("kind = 'term'").select("anchor", "dst").distinct().join(meant, "dst").withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy("dst")))
    open_ = scope.join(e.where("dst is null").select("src", "ref_id", "kind", "reason", "text"), "src")
    cited = _reached(scope, e, n, own, hubs, hops).join(named.withColumnRenamed("key", "dst"), "dst").join(grid.select(F.col("key").alias("dst"), "grid"), "dst", "left")
    via = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])[F.col("kind")]
    section = F.when(F.col("kind") == "note", "notes").when(F.col("kind").isin("std", "supp"), "standards").when(F.col("node_type").isin("table", "figure"), "tables").otherwise("cites")
    class_ = F.when(section == "notes", 10).when(section == "cites", 11).when(section == "tables", 12).otherwise(13)
    rows_ = F.when(F.col("grid").isNotNull(), F.concat(F.lit("\n"), "grid")).when(F.col("body") != "", F.concat(F.lit("\n"), F.left("body", F.lit(FIGURE)))).otherwise("")
    line = (
        F.when(section == "notes", F.concat("title", F.lit(": "), F.left("body", F.lit(NOTE))))
        .when(section == "cites", F.concat("title", F.lit(" ("), via, F.lit("): "), F.left("body", F.lit(CITE))))
        .when(section == "tables", F.concat("title", F.lit(" ("), via, F.lit(")"), rows_))
        .otherwise(F.coalesce(F.nullif("text", F.lit("")), "title"))
    )
    into = scope.withColumnRenamed("src", "dst").join(e.select("src", "dst").distinct(), "dst").select("anchor", F.col("src").alias("key")).distinct().join(named.where("node_type not in ('table', 'figure')"), "key")
    into = into.withColumn("k", F.row_number().over(Window.partitionBy("anchor").orderBy("rid", "key"))).where(F.col("k") <= CITED_BY)
    mine = own.join(grid, "key", "left").join(hubs.withColumn("hub", F.lit(True)), "anchor", "left")
    blank = F.lit("")
    parts = [
        part(1, "anchor", a, F.col("title")),
        part(2, "ancestors", above, F.col("title"), -F.col("depth")),
        part(3, "text", bodies, F.col("line"), item="src"),
        part(4, "terms", terms, F.concat("term", F.lit(": "), F.left("body", F.lit(TERM))), "nth", "dst"),
        part(5, "tables", mine, F.concat("title", F.coalesce(F.concat(F.lit("\n"), F.when(F.col("hub"), F.col("hub_grid")).otherwise(F.col("must"))), blank))),
        part(6, "amendments", marks, F.concat("id", F.lit(": "), "mark")),
        part(7, "unresolved", open_, F.concat(F.lit('"'), F.coalesce("text", blank), F.lit('" ('), F.coalesce("kind", blank), F.lit(") - "), F.coalesce("reason", blank)), "ref_id", None),
        part(8, "anchor", hubs, F.lit(f"delivered by reference: more than {HUB} dependencies"), F.lit(0), None),
        part(9, "tables", mine.where("more is not null and hub is null"), F.col("more"), -F.col("rid")),
        part(class_, section, cited, line, item="dst"),
        part(14, "cited_by", into, F.col("title")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct().withColumn("size", (1 + F.floor(F.length("line") / 4)).cast("bigint"))


def trimmed_lines(spark: SparkSession, d: str, anchor: Column | None = None, budget: int = BUDGET, hops: int = 1) -> DataFrame:
    """The lines that stay when the last in order are dropped until the rest fits the budget: cited_by first, then standards, tables that aren't its own, cites, notes, and last the rows of own tables beyond MUST_ROWS, a table at a time."""
    return op.within_budget(bundle_lines(spark, d, anchor, hops), "anchor", ["class", "ord", "line"], budget, MUST, "class")


@query(sql(*WHOLE) + "SELECT anchor, section, count(*) AS lines, sum(size) AS tokens FROM bl GROUP BY 1, 2")
def context_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Lines and tokens of each section of the bundle of every live node."""
    return bundle_lines(spark, d).groupBy("anchor", "section").agg(F.count(F.lit(1)).alias("lines"), F.sum("size").alias("tokens"))


@query(sql(*WHOLE) + "SELECT anchor, class, ord, item, line, running FROM kept")
def bundle_trim(spark: SparkSession, d: str) -> DataFrame:
    return trimmed_lines(spark, d).select("anchor", "class", "ord", "item", "line", "running")


@query(sql(*WHOLE) + f"SELECT anchor, string_agg('[' || section || '] ' || line, chr(10) ORDER BY list_position({SECTIONS}, section), class, ord, line) AS markdown FROM kept GROUP BY 1")
def bundle_markdown(spark: SparkSession, d: str, anchor: Column | None = None, budget: int = BUDGET, hops: int = 1) -> DataFrame:
    """The rendered bundle of each live node, or of one anchor, in the order of SECTIONS."""
    place = F.array_position(F.array(*[F.lit(x) for x in SECTIONS]), F.col("section"))
    lines = F.sort_array(F.collect_list(F.struct(place.alias("place"), "class", "ord", "line", "section")))
    return trimmed_lines(spark, d, anchor, budget, hops).groupBy("anchor").agg(F.array_join(F.transform(lines, lambda x: F.concat(F.lit("["), x["section"], F.lit("] "), x["line"])), "\n").alias("markdown"))


@query(sql(*WHOLE) + f""", ar AS (SELECT key FROM n WHERE node_type = 'article'), tg AS (SELECT DISTINCT anchor, dst FROM dp WHERE anchor IN (SELECT key FROM ar)), ok AS (SELECT * FROM tg WHERE anchor NOT IN (SELECT anchor FROM hb))
SELECT (SELECT count(DISTINCT anchor) FROM tg) AS targets, (SELECT count(*) FROM hb WHERE anchor IN (SELECT key FROM ar)) AS hubs, (SELECT count(*) FROM ok) AS wanted,
  (SELECT count(*) FROM ok WHERE (anchor, dst) IN (SELECT anchor, item FROM bl WHERE item IS NOT NULL)) AS c1, (SELECT count(*) FROM ok WHERE (anchor, dst) IN (SELECT anchor, item FROM kept WHERE item IS NOT NULL)) AS c2,
  (SELECT count(*) FROM kept JOIN d ON d.key = kept.item WHERE section = 'terms' AND anchor IN (SELECT anchor FROM ok)) AS terms, (SELECT count(*) FROM kept JOIN d ON d.key = kept.item WHERE section = 'terms' AND anchor IN (SELECT anchor FROM ok) AND length(coalesce(d.body, '')) <= {BLOB_CHARS}) AS c3""")
def bundle_completeness(spark: SparkSession, d: str) -> DataFrame:
    """C1: dependencies of articles that a bundle reaches, C2: that the budget delivers, C3: delivered terms with a definition of their own; hubs are counted apart."""
    articles = nodes(spark, d).where("node_type = 'article'").select(F.col("key").alias("anchor"))
    out = links(spark, d).select(F.col("ancestor").alias("anchor"), F.col("descendant").alias("src")).join(articles, "anchor", "left_semi").join(edges(spark, d).where("dst is not null").select("src", "dst"), "src").select("anchor", "dst").distinct()
    deps = out.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    ok = out.join(deps.where(F.col("n") <= HUB), "anchor", "left_semi")
    item = lambda df, name: df.where("item is not null").select("anchor", F.col("item").alias("dst"), F.lit(1).alias(name)).distinct()
    kept = trimmed_lines(spark, d)
    met = ok.join(item(bundle_lines(spark, d), "in1"), ["anchor", "dst"], "left").join(item(kept, "in2"), ["anchor", "dst"], "left").agg(F.count(F.lit(1)).alias("wanted"), F.count("in1").alias("c1"), F.count("in2").alias("c2"))
    texts = definitions(spark, d).select(F.col("key").alias("item"), F.length(F.coalesce("body", F.lit(""))).alias("chars"))
    terms = kept.where("section = 'terms'").join(ok.select("anchor").distinct(), "anchor", "left_semi").join(texts, "item").agg(F.count(F.lit(1)).alias("terms"), F.count_if(F.col("chars") <= BLOB_CHARS).alias("c3"))
    size = deps.agg(F.count(F.lit(1)).alias("targets"), F.count_if(F.col("n") > HUB).alias("hubs"))
    return size.crossJoin(met).crossJoin(terms)  # one row each
