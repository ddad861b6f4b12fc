"""Queries of the build: walks over ordered nodes, links, emitters, sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import permalink as permalink_of
from lexigrove.operators import walks
from lexigrove.operators.windows import carry_forward
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import D, E, G, N, cells, definitions, edges, nodes, sql
from lexigrove.session import scratch
from lexigrove.sources import jsonl, manifest, sinks
from lexigrove.sources.tables import table
from lexigrove.streaming import maintain

R = Registry()
query = R.query

OPENERS = ("act", "appendix", "supplementary_standard", "index")


def printed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Nodes as printed lines: the marker, the indent, the heading, whether a part of the volume opens there, whether it is inside a table; not their parent, and their type only for the last two."""
    opens = F.col("node_type").isin(*OPENERS)
    prefix = F.when(F.col("node_type") == "appendix", "a-").when(F.col("node_type").isin("act", "supplementary_standard"), "")
    return nodes(spark, d).where("volume is not null").select(
        "volume", "rid", "key", F.concat(F.lit("v"), F.col("volume").cast("string")).alias("volume_key"), F.col("designator").alias("marker"), F.nullif("heading", F.lit("")).alias("label"), "x0", "page",
        opens.alias("opens"), F.when(opens, prefix).alias("prefix"), F.col("node_type").isin("table", "figure").alias("region"), (F.size(F.split("key", "/s")) - 1).alias("level"), F.col("node_type").startswith("index").alias("indexed"), F.split_part("key", F.lit("/"), F.lit(2)).alias("home"),
    )


def _agreed(walked: DataFrame) -> DataFrame:
    return walked.withColumn("agrees", F.col("derived").eqNullSafe(F.col("key")))


@query()
def tree_walk(spark: SparkSession, d: str) -> DataFrame:
    """The division tree of every volume from its lines alone, against the stored ids; a state machine, so without SQL."""
    lines = printed_lines(spark, d).where("not indexed or opens")
    return _agreed(walks.ordered_fold(lines, "volume", ["rid"], walks.division_walk, "key string, derived string, level string, host string").where("derived is not null"))


def _rooted(spark: SparkSession, d: str) -> DataFrame:
    return walks.ordered_fold(printed_lines(spark, d).where("not indexed or opens"), "volume", ["rid"], walks.rooted_walk, "key string, derived string, level string, heading string")


@query()
def tree_walk_v2(spark: SparkSession, d: str) -> DataFrame:
    """The same for appendices and supplementary standards, whose heads are notes and numbers."""
    own = nodes(spark, d).where("node_type in ('appendix', 'supplementary_standard')").select(F.col("key").alias("root"))
    return _agreed(_rooted(spark, d).where("derived is not null").withColumn("root", F.substring_index("derived", "/", 2)).join(own, "root", "left_semi").drop("heading"))


@query()
def pending_label(spark: SparkSession, d: str) -> DataFrame:
    """The walk of the Acts: sections, subsections and clauses with the marginal note that became their heading."""
    own = nodes(spark, d).where("node_type = 'act'").select(F.col("key").alias("root"))
    return _agreed(_rooted(spark, d).where("derived is not null").withColumn("root", F.substring_index("derived", "/", 2)).join(own, "root", "left_semi"))


@query()
def index_tree(spark: SparkSession, d: str) -> DataFrame:
    """The index tree of every volume from the levels of its entries."""
    return _agreed(walks.ordered_fold(printed_lines(spark, d).where("indexed"), "volume", ["rid"], walks.index_walk, "key string, derived string, above string"))


@query(sql(N) + """SELECT key, page, last_value(CASE WHEN node_type = 'division' THEN key END IGNORE NULLS) OVER (PARTITION BY volume ORDER BY rid ROWS UNBOUNDED PRECEDING) AS division FROM n WHERE node_type IN ('division', 'part', 'section')""")
def master_toc(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d).where("node_type in ('division', 'part', 'section')")
    return n.select("key", "page", carry_forward(F.when(F.col("node_type") == "division", F.col("key")), ["volume"], ["rid"]).alias("division"))


MARK = r"O[.] Reg[.] [0-9]+/[0-9]+"
URI = "(?:https?://|www[.])[^\\s<>\"]+|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"


@query(sql(N, E, D, f"mk AS (SELECT DISTINCT volume, page, rid, key, unnest(regexp_extract_all(body, '{MARK}')) AS mark FROM n WHERE body LIKE '%O. Reg.%'), lg AS (SELECT volume, mark, arg_min(key, rid) AS target FROM mk GROUP BY 1, 2)",
  "mt AS (SELECT volume, page, key, last_value(CASE WHEN node_type = 'division' THEN key END IGNORE NULLS) OVER (PARTITION BY volume ORDER BY rid ROWS UNBOUNDED PRECEDING) AS division FROM n WHERE node_type IN ('division', 'part', 'section'))")
 + f"""SELECT s.volume, s.page, e.dst AS target, CASE WHEN e.chunk LIKE 'g%' THEN 'cell' WHEN e.chunk = 'h' THEN 'heading' ELSE 'ref' END AS why, s.key AS src FROM e JOIN n s ON s.key = e.src WHERE e.dst IN (SELECT key FROM n) AND coalesce(e.kind, '') <> 'term' AND e.chunk IS NOT NULL
UNION ALL SELECT s.volume, s.page, e.dst, 'term', s.key FROM e JOIN n s ON s.key = e.src WHERE e.kind = 'term' AND e.dst IN (SELECT key FROM d)
UNION ALL SELECT k.volume, k.page, p.key, 'toc', k.key FROM n k JOIN n p ON p.key = k.up WHERE k.node_type IN ('index_entry', 'index_subentry', 'section')
UNION ALL SELECT mk.volume, mk.page, lg.target, 'amendment', mk.key FROM mk JOIN lg ON lg.volume = mk.volume AND lg.mark = mk.mark WHERE lg.target <> mk.key
UNION ALL SELECT volume, page, key, 'master', division FROM mt WHERE division IS NOT NULL AND division <> key
UNION ALL SELECT volume, page, rtrim(unnest(regexp_extract_all(body, '{URI}')), '.,;:)'), 'uri', key FROM n WHERE body IS NOT NULL""")
def links_all(spark: SparkSession, d: str) -> DataFrame:
    """Link records of all origins: references in bodies, headings and cells, terms, contents, amendments (to the first place that names the regulation), the master contents, addresses."""
    n = nodes(spark, d)
    at = n.select(F.col("key").alias("src"), "volume", "page")
    e = edges(spark, d).join(at, "src").withColumn("target", F.col("dst"))
    keys = n.select(F.col("key").alias("dst"))
    other = e.where("coalesce(kind, '') <> 'term'").join(keys, "dst", "left_semi").where("chunk is not null")
    origin = F.when(F.col("chunk").startswith("g"), "cell").when(F.col("chunk") == "h", "heading").otherwise("ref")
    terms = e.where("kind = 'term'").join(definitions(spark, d).select(F.col("key").alias("dst")), "dst", "left_semi")
    toc = n.where("node_type in ('index_entry', 'index_subentry', 'section')").join(n.select(F.col("key").alias("target")), F.col("up") == F.col("target"))
    marks = n.where(F.col("body").contains("O. Reg.")).select("volume", "page", "rid", F.col("key").alias("src"), F.explode(F.regexp_extract_all("body", F.lit(MARK), F.lit(0))).alias("mark")).distinct()
    legend = marks.groupBy("volume", "mark").agg(F.min_by("src", "rid").alias("target"))
    amended = marks.join(legend, ["volume", "mark"]).where("target <> src")
    heads = n.where("node_type in ('division', 'part', 'section')")
    master = heads.withColumn("src", carry_forward(F.when(F.col("node_type") == "division", F.col("key")), ["volume"], ["rid"])).where("src <> key").withColumn("target", F.col("key"))
    uris = n.where("body is not null").select("volume", "page", F.col("key").alias("src"), F.explode(F.regexp_extract_all("body", F.lit(URI), F.lit(0))).alias("hit")).withColumn("target", F.rtrim("hit", F.lit(".,;:)")))
    found = None
    for rows, why in ((other, origin), (terms, F.lit("term")), (toc.withColumn("src", F.col("key")), F.lit("toc")), (amended, F.lit("amendment")), (master, F.lit("master")), (uris, F.lit("uri"))):
        one = rows.select("volume", "page", "target", why.alias("why"), "src")
        found = one if found is None else found.unionByName(one)
    return found


@query(sql(N, E) + "SELECT e.ref_id, CASE WHEN t.key IS NULL THEN 'none' WHEN t.volume = s.volume THEN 'same' ELSE 'remote' END AS route FROM e JOIN n s ON s.key = e.src LEFT JOIN n t ON t.key = e.dst")
def links_crossvol(spark: SparkSession, d: str) -> DataFrame:
    """Links inside a volume, into another, and without a target."""
    n = nodes(spark, d)
    e = edges(spark, d).join(n.select(F.col("key").alias("src"), F.col("volume").alias("sv")), "src").join(n.select(F.col("key").alias("dst"), F.col("volume").alias("tv")), "dst", "left")
    return e.select("ref_id", F.when(F.col("tv").isNull(), "none").when(F.col("tv") == F.col("sv"), "same").otherwise("remote").alias("route"))


# One page a part of a division, an act, an appendix and so on.
ROOT = "CASE WHEN split_part(key, '/', 2) IN ('a', 'b', 'c') AND split_part(key, '/', 3) <> '' THEN concat_ws('-', split_part(key, '/', 1), split_part(key, '/', 2), split_part(key, '/', 3)) ELSE concat_ws('-', split_part(key, '/', 1), split_part(key, '/', 2)) END"
LEVEL = "least(6, greatest(1, length(key) - length(replace(key, '/', ''))))"
FRONT = "concat('id: ', key, chr(10), 'title: ', coalesce(nullif(heading, ''), key), chr(10), 'volume: ', coalesce(volume, 0), chr(10), 'page: ', coalesce(page, 0))"
BLOCK = "CASE WHEN coalesce(heading, '') <> '' THEN concat(repeat('#', level), ' ', coalesce(nullif(designator, '') || ' ', ''), heading, CASE WHEN coalesce(body, '') <> '' THEN concat(chr(10), body) ELSE '' END) ELSE concat('- ', coalesce(nullif(designator, '') || ' ', ''), coalesce(body, '')) END"
PAGES = f"""pg AS (SELECT *, {ROOT} AS root, CAST({LEVEL} AS INTEGER) AS level FROM n),
fr AS (SELECT root, count(*) AS nodes, arg_min({FRONT}, (rid, key)) AS front, arg_min(coalesce(nullif(heading, ''), key), (rid, key)) AS title FROM pg GROUP BY 1)"""


def _pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(nodes with the root of their page and their level, one row a page with its front matter, title and number of nodes)."""
    pages = nodes(spark, d).withColumns({"root": F.expr(ROOT), "level": F.expr(LEVEL).cast("int")})
    first = F.struct("rid", "key")
    return pages, pages.groupBy("root").agg(F.count("*").alias("nodes"), F.min_by(F.expr(FRONT), first).alias("front"), F.min_by(F.coalesce(F.nullif("heading", F.lit("")), "key"), first).alias("title"))


def _written(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """(root, line): pages of lines (root, zone, ord, line) written a folder a page, as read back."""
    folder = scratch(spark, name)
    sinks.write_pages(lines, folder, "root", ["zone", "ord"], "line")
    return spark.read.schema("value string, root string").option("lineSep", "\n").text(folder).select("root", F.col("value").alias("line"))


@query(sql(N, PAGES) + f"SELECT root, unnest(string_split(line, chr(10))) AS line FROM (SELECT root, concat('---', chr(10), front, chr(10), 'nodes: ', nodes, chr(10), '---') AS line FROM fr UNION ALL SELECT root, {BLOCK} FROM pg)")
def emit_markdown(spark: SparkSession, d: str) -> DataFrame:
    """A Markdown page with front matter for each part, act, appendix and index, written and read back; its order is that of zone and place."""
    pages, front = _pages(spark, d)
    head = front.select("root", F.lit(0).alias("zone"), F.lit(0).cast("bigint").alias("ord"), F.concat(F.lit("---\n"), "front", F.lit("\nnodes: "), F.col("nodes").cast("string"), F.lit("\n---")).alias("line"))
    return _written(spark, head.unionByName(pages.select("root", F.lit(1).alias("zone"), F.col("rid").alias("ord"), F.expr(BLOCK).alias("line"))), "markdown")


ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"
ANCHOR = "replace(key, '/', '__')"
SECTION = f"""concat('<section id="', {ANCHOR}, '">', CASE WHEN coalesce(heading, '') <> '' THEN concat('<h', level, '>', {ESC.format("concat_ws(' ', nullif(designator, ''), heading)")}, '</h', level, '>') ELSE '' END, CASE WHEN coalesce(body, '') <> '' THEN concat('<p>', {ESC.format("body")}, '</p>') ELSE '' END, '</section>')"""
ENTRY = f"""concat('<li><a href="#', {ANCHOR}, '">', {ESC.format("concat_ws(' ', nullif(designator, ''), heading)")}, '</a></li>')"""
NAV = "coalesce(heading, '') <> '' AND node_type IN ('part', 'section', 'subsection', 'act_section', 'note', 'index_entry')"
HTML_HEAD = f"concat('<!doctype html><html lang=\"en\"><head><meta charset=\"utf-8\"><title>', {ESC.format('title')}, '</title></head><body><a href=\"index.html\">Contents</a>')"
ITEM = f"concat('<li><a href=\"', root, '.html\">', {ESC.format('title')}, '</a> ', nodes, '</li>')"


@query(sql(N, PAGES) + f"""SELECT root, unnest(string_split(line, chr(10))) AS line FROM (SELECT root, {HTML_HEAD} AS line FROM fr UNION ALL SELECT root, '<nav><ul>' FROM fr UNION ALL SELECT root, {ENTRY} FROM pg WHERE {NAV} UNION ALL SELECT root, '</ul></nav><main>' FROM fr UNION ALL SELECT root, {SECTION} FROM pg UNION ALL SELECT root, '</main></body></html>' FROM fr
 UNION ALL SELECT 'index', '<!doctype html><html lang="en"><body><main><ul>' UNION ALL SELECT 'index', {ITEM} FROM fr UNION ALL SELECT 'index', '</ul></main></body></html>')""")
def emit_html(spark: SparkSession, d: str) -> DataFrame:
    """An HTML page for each of the same roots with a list of its headings and a section a node, and an index page of all; written and read back."""
    pages, front = _pages(spark, d)

    def part(rows: DataFrame, zone: int, line: str, order: str = "cast(0 as bigint)") -> DataFrame:
        return rows.select("root", F.lit(zone).alias("zone"), F.expr(order).alias("ord"), F.expr(line).alias("line"))

    whole = spark.range(1).select(F.lit("index").alias("root"))
    parts = [
        part(front, 0, HTML_HEAD), part(front, 1, "'<nav><ul>'"), part(pages.where(NAV), 2, ENTRY, "rid"), part(front, 3, "'</ul></nav><main>'"), part(pages, 4, SECTION, "rid"), part(front, 5, "'</main></body></html>'"),
        part(whole, 0, "'<!doctype html><html lang=\"en\"><body><main><ul>'"), part(front.withColumn("line", F.expr(ITEM)).withColumn("root", F.lit("index")), 1, "line"), part(whole, 2, "'</ul></main></body></html>'"),
    ]
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    return _written(spark, lines, "html")


@query(sql(N, E, G, D) + "SELECT 'node' AS name, count(*) AS rows FROM n UNION ALL SELECT 'ref', count(*) FROM e UNION ALL SELECT 'cell', count(*) FROM g UNION ALL SELECT 'definition', count(*) FROM d")
def emit_tables(spark: SparkSession, d: str) -> DataFrame:
    """The clean tables written to the shared folder and counted as read back."""
    folder = scratch(spark, "tables")
    sinks.write_tables({"node": nodes(spark, d).withColumn("link", permalink_of("id")), "ref": edges(spark, d), "cell": cells(spark, d), "definition": definitions(spark, d)}, folder, {"node": ["volume"]})
    found = None
    for name in ("node", "ref", "cell", "definition"):
        one = spark.read.parquet(f"{folder}/{name}.parquet").agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        found = one if found is None else found.unionByName(one)
    return found


@query(sql(D) + "SELECT id, term, blob, body_offset FROM d")
def scan_jsonl_meta(spark: SparkSession, d: str) -> DataFrame:
    """Definitions written as JSON lines with a header, and read without it."""
    folder = scratch(spark, "jsonl")
    jsonl.write_jsonl(definitions(spark, d).select("id", "term", "blob", "body_offset"), folder, ["id"], {"generated": "definitions"})
    return jsonl.read_jsonl(spark, f"{folder}/*", "generated string, id string, term string, blob string, body_offset int").drop("generated")


@query()
def manifest_verify(spark: SparkSession, d: str, declared: DataFrame | None = None) -> DataFrame:
    """All parquet files of the directory against the given manifest, else the one that the first run wrote to the shared folder."""
    return manifest.verify(manifest.declared_manifest(spark, d) if declared is None else declared, manifest.directory_manifest(spark, d))


@query("SELECT term, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY 1")
def stream_index_maintenance(spark: SparkSession, d: str) -> DataFrame:
    """The index that a stream over the documents keeps, batch by batch."""
    folder = scratch(spark, "index")
    schema = table(spark, d, "documents").schema
    maintain.maintain_index(spark, f"{d}/documents.parquet*", schema, folder, "doc_id", "text")
    return maintain.current_index(spark, folder)


@query("SELECT epoch_us(ts) // 3600000000 AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts of events; as a batch the watermark holds nothing back."""
    w = maintain.windowed_counts(table(spark, d, "events"), "ts", ["event_type"], "1 hour", "2 hours")
    return w.select(F.floor(F.unix_seconds("start") / 3600).alias("hour"), "event_type", "n")


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
k AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM k GROUP BY user_id, k""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = maintain.sessions(table(spark, d, "events"), "user_id", "ts", "30 minutes")
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("last").alias("last_us"), "n")


@query("SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS total FROM events")
def stream_running(spark: SparkSession, d: str) -> DataFrame:
    return maintain.running_totals(table(spark, d, "events"), "user_id", "ts", "event_id", "value").select("event_id", "user_id", "total")


@query("SELECT n_regionkey, n_name, o_year, orders, rank() OVER (PARTITION BY n_regionkey, o_year ORDER BY orders DESC) AS place FROM (SELECT n_regionkey, n_name, year(o_orderdate) AS o_year, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3)")
def orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    """A plain star join: orders per nation and year with their rank in the region."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("o_year"))
    per = o.groupBy("c_custkey", "o_year").agg(F.count("*").alias("k"))
    x = per.join(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey").join(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), "n_nationkey")
    x = x.groupBy("n_regionkey", "n_name", "o_year").agg(F.sum("k").alias("orders"))
    return x.withColumn("place", F.rank().over(Window.partitionBy("n_regionkey", "o_year").orderBy(F.desc("orders"))))


@query("""WITH s AS (SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS quantity FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())) SELECT l_returnflag, l_linestatus, n, CAST(quantity AS BIGINT) AS quantity FROM s""")
def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Roll-up over two levels."""
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
