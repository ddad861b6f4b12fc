"""Queries over boxes on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.operators import geometry as op
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import G, N, cells, nodes, sql
from lexigrove.sources.tables import table

R = Registry()
query = R.query

B = "b AS (SELECT rid, key, volume, page, node_type, designator, heading, up, x0, y0, x1, y1 FROM n WHERE x0 IS NOT NULL)"
OVER = "greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)"
AREA = "(({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0))"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where("x0 is not null").select("rid", "key", "volume", "page", "node_type", "designator", "heading", "up", "x0", "y0", "x1", "y1")


@query(sql(N, B) + f"SELECT a.rid AS a, b.rid AS b FROM b a JOIN b ON a.volume = b.volume AND a.page = b.page AND a.rid < b.rid WHERE {OVER} > 0 AND {OVER} >= 0.55 * least({AREA.format('a')}, {AREA.format('b')})")
def box_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of boxes of which one lies to 55 % in the other."""
    found = op.candidate_pairs(boxes(spark, d))
    common = op.overlap_area("a", "b")
    return found.where((common > 0) & (common >= 0.55 * F.least(op.area("a"), op.area("b")))).select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b"))


@query(sql(N, B) + """SELECT a.rid, min(b.rid) AS holder FROM b a JOIN b ON a.volume = b.volume AND a.page = b.page AND a.rid <> b.rid
WHERE (a.x0 + a.x1) / 2 BETWEEN b.x0 - 2 AND b.x1 + 2 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 - 2 AND b.y1 + 2 GROUP BY 1""")
def point_in_cell(spark: SparkSession, d: str) -> DataFrame:
    """The first box that holds another's centre, two points of slack."""
    b = boxes(spark, d)
    points = b.select("volume", "page", "rid", ((F.col("x0") + F.col("x1")) / 2).alias("px"), ((F.col("y0") + F.col("y1")) / 2).alias("py")).withColumns({"bx": F.floor(F.col("px") / op.GRID).cast("int"), "by": F.floor(F.col("py") / op.GRID).cast("int")})
    holders = op.grid(b, 2.0).select("volume", "page", F.col("rid").alias("holder"), "x0", "y0", "x1", "y1", "bx", "by")
    hit = points.join(holders, ["volume", "page", "bx", "by"]).where((F.col("rid") != F.col("holder")) & F.col("px").between(F.col("x0") - 2, F.col("x1") + 2) & F.col("py").between(F.col("y0") - 2, F.col("y1") + 2))
    return hit.groupBy("rid").agg(F.min("holder").alias("holder"))


@query(sql(N) + """, p AS (SELECT volume, key, page AS lo, coalesce(lead(page) OVER (PARTITION BY volume ORDER BY page, rid) - 1, 1000000) AS hi FROM n WHERE node_type = 'part')
SELECT n.rid, min(p.key) AS part FROM n JOIN p ON p.volume = n.volume AND n.page BETWEEN p.lo AND p.hi GROUP BY 1""")
def page_part(spark: SparkSession, d: str) -> DataFrame:
    """Stabbing join: the part whose page span holds a node's page; equi-join on volume, then the range."""
    n = nodes(spark, d)
    hi = F.coalesce(F.lead("page").over(Window.partitionBy("volume").orderBy("page", "rid")) - 1, F.lit(1_000_000))
    p = n.where("node_type = 'part'").select("volume", F.col("key").alias("part"), F.col("page").alias("lo"), hi.alias("hi"))
    return n.select("rid", "volume", "page").join(p, "volume").where(F.col("page").between(F.col("lo"), F.col("hi"))).groupBy("rid").agg(F.min("part").alias("part"))


@query(sql(N, B) + """, h AS (SELECT * FROM b WHERE heading IS NOT NULL), t AS (SELECT * FROM b WHERE node_type = 'table')
SELECT t.rid, coalesce(arg_max(h.rid, (h.y0, h.rid)) FILTER (WHERE h.y0 < t.y0 + 6), arg_min(h.rid, (h.y0, h.rid))) AS caption FROM t JOIN h ON h.volume = t.volume AND h.page = t.page GROUP BY t.rid, t.y0""")
def asof_caption(spark: SparkSession, d: str) -> DataFrame:
    """Backward as-of join: the last heading above a table on its page, else the first on the page."""
    b = boxes(spark, d)
    h = b.where("heading is not null").select("volume", "page", F.col("rid").alias("h"), F.col("y0").alias("hy"))
    x = b.where("node_type = 'table'").select("volume", "page", "rid", "y0").join(h, ["volume", "page"])
    above = F.max(F.when(F.col("hy") < F.col("y0") + 6, F.struct("hy", "h")))
    return x.groupBy("rid").agg(above.alias("a"), F.min(F.struct("hy", "h")).alias("f")).select("rid", F.coalesce("a.h", "f.h").alias("caption"))


@query(sql(N, B) + """, h AS (SELECT * FROM b WHERE heading IS NOT NULL), t AS (SELECT * FROM b WHERE node_type = 'table')
SELECT t.rid, coalesce(arg_min(h.rid, (h.y0, h.rid)) FILTER (WHERE h.y0 >= t.y1), arg_max(h.rid, (h.y0, h.rid)) FILTER (WHERE h.y0 < t.y0)) AS caption FROM t JOIN h ON h.volume = t.volume AND h.page = t.page GROUP BY t.rid""")
def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Forward as-of join: the first heading below, else the last above."""
    b = boxes(spark, d)
    h = b.where("heading is not null").select("volume", "page", F.col("rid").alias("h"), F.col("y0").alias("hy"))
    x = b.where("node_type = 'table'").select("volume", "page", "rid", "y0", "y1").join(h, ["volume", "page"])
    below, above = F.min(F.when(F.col("hy") >= F.col("y1"), F.struct("hy", "h"))), F.max(F.when(F.col("hy") < F.col("y0"), F.struct("hy", "h")))
    return x.groupBy("rid").agg(below.alias("b"), above.alias("a")).select("rid", F.coalesce("b.h", "a.h").alias("caption"))


@query(sql(N, B) + """SELECT m.rid, arg_min(p.rid, (abs(p.y0 - m.y0), p.x0, p.rid)) AS provision FROM b m JOIN b p ON p.volume = m.volume AND p.page = m.page AND p.rid <> m.rid
WHERE m.x0 < 60 AND p.x0 > m.x0 AND p.y0 - m.y0 > -30 AND p.y0 - m.y0 < 10 GROUP BY 1""")
def nearest_provision(spark: SparkSession, d: str) -> DataFrame:
    """Nearest neighbour of a marginal mark: the closest box to its right within a band."""
    b = boxes(spark, d)
    p = b.select("volume", "page", F.col("rid").alias("p"), F.col("x0").alias("px"), F.col("y0").alias("py"))
    dy = F.col("py") - F.col("y0")
    x = b.where("x0 < 60").join(p, ["volume", "page"]).where((F.col("p") != F.col("rid")) & (F.col("px") > F.col("x0")) & (dy > -30) & (dy < 10))
    return x.groupBy("rid").agg(F.min(F.struct(F.abs(dy).alias("d"), "px", "p")).alias("m")).select("rid", F.col("m.p").alias("provision"))


@query(sql(N, B) + "SELECT a.rid AS a, b.rid AS b FROM b a JOIN b ON a.volume = b.volume AND a.page = b.page AND a.rid < b.rid AND abs(a.y0 - b.y0) < 8 AND a.x0 > 40 AND b.x0 > 40")
def row_band_join(spark: SparkSession, d: str) -> DataFrame:
    """Boxes on one line of print; bands of eight points and their neighbours make the join an equi-join."""
    b = boxes(spark, d).where("x0 > 40").select("volume", "page", "rid", "y0", F.floor(F.col("y0") / 8).alias("band"))
    right = b.select("volume", "page", F.col("rid").alias("b"), F.col("y0").alias("by"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    return b.join(right, ["volume", "page", "band"]).where((F.col("rid") < F.col("b")) & (F.abs(F.col("y0") - F.col("by")) < 8)).select(F.col("rid").alias("a"), "b")


TOUCH = "a.x0 - 6 <= b.x1 AND b.x0 - 6 <= a.x1 AND a.y0 - 6 <= b.y1 AND b.y0 - 6 <= a.y1"


@query(sql(N, B, f"""p AS (SELECT a.rid AS a, b.rid AS b FROM b a JOIN b ON a.volume = b.volume AND a.page = b.page AND a.rid <> b.rid WHERE {TOUCH})""", "w AS (SELECT rid AS key, rid AS here FROM b UNION SELECT w.key, p.b FROM w JOIN p ON p.a = w.here)", recursive=True) + "SELECT key, min(here) AS component FROM w GROUP BY 1")
def rect_components(spark: SparkSession, d: str) -> DataFrame:
    """Connected components of boxes that touch within six points."""
    b = boxes(spark, d)
    close = lambda lo, hi: (F.col(f"a.{lo}") - 6 <= F.col(f"b.{hi}")) & (F.col(f"b.{lo}") - 6 <= F.col(f"a.{hi}"))
    pairs = op.candidate_pairs(b, 6.0).where(close("x0", "x1") & close("y0", "y1")).select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b"))
    return op.components(b.select(F.col("rid").alias("key")), pairs)


@query()
def overlap_suppress(spark: SparkSession, d: str) -> DataFrame:
    return op.suppress_overlaps(boxes(spark, d)).select("rid", "kept")


@query()
def lattice_cells(spark: SparkSession, d: str) -> DataFrame:
    return op.lattice(boxes(spark, d))


@query(sql(N, B) + f"SELECT a.rid AS a, b.rid AS b FROM b a JOIN b ON a.volume = b.volume AND a.page = b.page AND a.rid < b.rid WHERE a.up IS DISTINCT FROM b.up AND {OVER} > 0.6 * least({AREA.format('a')}, {AREA.format('b')})")
def link_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that lie on each other but belong to different parents."""
    common = op.overlap_area("a", "b")
    found = op.candidate_pairs(boxes(spark, d)).where(~F.col("a.up").eqNullSafe(F.col("b.up")) & (common > 0.6 * F.least(op.area("a"), op.area("b"))))
    return found.select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b"))


@query(sql(G) + """SELECT a.table_id, a.r AS ar, a.c AS ac, b.r AS br, b.c AS bc FROM g a JOIN g b ON a.table_id = b.table_id AND (a.r, a.c) < (b.r, b.c) AND b.r < a.r + a.rowspan AND b.c < a.c + a.colspan AND b.c + b.colspan > a.c""")
def cell_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a table that cover the same place; spans are exploded, so the join is by place."""
    g = cells(spark, d)
    covered = g.select("table_id", "r", "c", F.explode(F.sequence(F.col("r"), F.col("r") + F.col("rowspan") - 1)).alias("pr"), "colspan").select("table_id", "r", "c", "pr", F.explode(F.sequence(F.col("c"), F.col("c") + F.col("colspan") - 1)).alias("pc"))
    a, b = covered.alias("a"), covered.alias("b")
    same = (F.col("a.table_id") == F.col("b.table_id")) & (F.col("a.pr") == F.col("b.pr")) & (F.col("a.pc") == F.col("b.pc"))
    before = (F.col("a.r") < F.col("b.r")) | ((F.col("a.r") == F.col("b.r")) & (F.col("a.c") < F.col("b.c")))
    return a.join(b, same & before).select(F.col("a.table_id").alias("table_id"), F.col("a.r").alias("ar"), F.col("a.c").alias("ac"), F.col("b.r").alias("br"), F.col("b.c").alias("bc")).distinct()


@query(sql(N, B) + "SELECT p.rid, count(*) AS inside FROM b p JOIN b k ON k.up = p.key AND k.page = p.page WHERE k.x0 >= p.x0 - 4 AND k.x1 <= p.x1 + 4 GROUP BY 1")
def rule_segments(spark: SparkSession, d: str) -> DataFrame:
    """Children's boxes that stay within the width of their parent's on the same page."""
    b = boxes(spark, d)
    k = b.select(F.col("up").alias("key"), "page", F.col("x0").alias("k0"), F.col("x1").alias("k1"))
    return b.select("key", "page", "rid", "x0", "x1").join(k, ["key", "page"]).where((F.col("k0") >= F.col("x0") - 4) & (F.col("k1") <= F.col("x1") + 4)).groupBy("rid").agg(F.count("*").alias("inside"))


@query(sql(N, B) + f"""SELECT a.rid, CASE WHEN a.y1 < 80 THEN 'header' WHEN a.y0 > 700 THEN 'footer' WHEN a.node_type = 'table' OR bool_or(b.rid IS NOT NULL AND {OVER} >= 0.55 * {AREA.format('a')}) THEN 'table' ELSE 'body' END AS region
FROM b a LEFT JOIN b ON b.volume = a.volume AND b.page = a.page AND b.node_type = 'table' AND b.rid <> a.rid GROUP BY a.rid, a.y0, a.y1, a.node_type""")
def region_classify(spark: SparkSession, d: str) -> DataFrame:
    """Header, footer, table or body, in this order, for every box."""
    b = boxes(spark, d)
    t = b.where("node_type = 'table'").select("volume", "page", "rid", "x0", "y0", "x1", "y1").alias("b")
    x = b.alias("a").join(t, (F.col("a.volume") == F.col("b.volume")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.rid") != F.col("b.rid")), "left")
    inside = F.coalesce(F.bool_or(F.col("b.rid").isNotNull() & (op.overlap_area("a", "b") >= 0.55 * op.area("a"))), F.lit(False))
    x = x.groupBy(F.col("a.rid").alias("rid"), F.col("a.y0").alias("y0"), F.col("a.y1").alias("y1"), F.col("a.node_type").alias("node_type")).agg(inside.alias("inside"))
    return x.select("rid", F.when(F.col("y1") < 80, "header").when(F.col("y0") > 700, "footer").when((F.col("node_type") == "table") | F.col("inside"), "table").otherwise("body").alias("region"))


@query(sql(N) + """, l AS (SELECT volume, page, regexp_matches(coalesce(heading, body, ''), '[.]{4,}') AS leader, node_type LIKE 'index%' AS narrow FROM n)
SELECT volume, page, count(*) FILTER (WHERE leader) AS leaders, count(*) FILTER (WHERE narrow) AS narrow, count(*) AS n, count(*) FILTER (WHERE leader) >= 2 AND count(*) FILTER (WHERE narrow) >= 10 AS contents, count(*) FILTER (WHERE narrow) >= 10 OR count(*) >= 15 AS guarded FROM l GROUP BY 1, 2""")
def contents_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with their dot leaders and entries in the narrow print of lists: contents with two leaders and ten entries; the guard takes ten entries, or fifteen lines of any kind."""
    leader = F.coalesce("heading", "body", F.lit("")).rlike("[.]{4,}")
    k = nodes(spark, d).groupBy("volume", "page").agg(F.count_if(leader).alias("leaders"), F.count_if(F.col("node_type").like("index%")).alias("narrow"), F.count("*").alias("n"))
    return k.withColumns({"contents": F.expr("leaders >= 2 and narrow >= 10"), "guarded": F.expr("narrow >= 10 or n >= 15")})


@query(sql(N, B) + "SELECT rid, (y1 - y0 <= 3 AND x1 - x0 > y1 - y0) OR (x1 - x0 <= 3 AND y1 - y0 > x1 - x0) AS thin, y1 - y0 <= 3 AND x1 - x0 > y1 - y0 AS horizontal FROM b")
def thin_rules(spark: SparkSession, d: str) -> DataFrame:
    """Whether a box is a rule: at most three points in one direction, and longer in the other."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    flat = (h <= 3) & (w > h)
    return boxes(spark, d).select("rid", (flat | ((w <= 3) & (h > w))).alias("thin"), flat.alias("horizontal"))


#: Pages at the front whose images are no part of the text.
FRONT_PAGES = 20
MICRO = "(x1 - x0 <= 16 AND y1 - y0 <= 16) OR x1 - x0 <= 2 OR y1 - y0 <= 2"


@query(sql(N, B) + f"""SELECT a.rid, CASE WHEN {MICRO.replace("x", "a.x").replace("y", "a.y")} THEN 'micro' WHEN bool_or(b.rid IS NOT NULL AND {OVER} >= 0.55 * {AREA.format('a')}) THEN 'table_cell_graphic' WHEN rtrim(trim(coalesce(a.designator, '')), '.') <> '' THEN 'formal_figure' WHEN a.page <= {FRONT_PAGES} THEN 'front_matter' ELSE 'inline_equation' END AS role
FROM b a LEFT JOIN b ON b.volume = a.volume AND b.page = a.page AND b.node_type = 'table' AND b.rid <> a.rid GROUP BY a.rid, a.x0, a.x1, a.y0, a.y1, a.designator, a.page""")
def raster_roles(spark: SparkSession, d: str) -> DataFrame:
    """Role of each box as if it were an image, the first rule that holds: a fragment, for more than half inside a table, with a designator, at the front, else inline."""
    b = boxes(spark, d)
    t = b.where("node_type = 'table'").select("volume", "page", "rid", "x0", "y0", "x1", "y1").alias("b")
    x = b.alias("a").join(t, (F.col("a.volume") == F.col("b.volume")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.rid") != F.col("b.rid")), "left")
    inside = F.coalesce(F.bool_or(F.col("b.rid").isNotNull() & (op.overlap_area("a", "b") >= 0.55 * op.area("a"))), F.lit(False))
    x = x.groupBy(*(F.col(f"a.{c}").alias(c) for c in ("rid", "x0", "x1", "y0", "y1", "designator", "page"))).agg(inside.alias("inside"))
    named = F.rtrim(F.trim(F.coalesce("designator", F.lit(""))), F.lit(".")) != ""
    return x.select("rid", F.when(F.expr(MICRO), "micro").when(F.col("inside"), "table_cell_graphic").when(named, "formal_figure").when(F.col("page") <= FRONT_PAGES, "front_matter").otherwise("inline_equation").alias("role"))


@query("SELECT out, count(*) AS n FROM (SELECT ((l_orderkey % 256) * (l_partkey % 256) + 255 * (255 - l_partkey % 256) + 127) // 255 AS out FROM lineitem) GROUP BY 1")
def softmask_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Samples with an alpha laid onto white, in integers; samples come from two key columns."""
    c, a = F.col("l_orderkey") % 256, F.col("l_partkey") % 256
    return table(spark, d, "lineitem").select(F.floor((c * a + 255 * (255 - a) + 127) / 255).alias("out")).groupBy("out").agg(F.count("*").alias("n"))


@query(sql(N, B) + "SELECT key, greatest(40, least(760, y0 - 6)) AS y FROM b")
def link_dest(spark: SparkSession, d: str) -> DataFrame:
    return boxes(spark, d).select("key", F.greatest(F.lit(40.0), F.least(F.lit(760.0), F.col("y0") - 6)).alias("y"))


@query(sql(N, B) + "SELECT bx, by_, count(*) AS n FROM (SELECT bx, unnest(range(CAST(floor(y0 / 50) AS BIGINT), CAST(floor(y1 / 50) AS BIGINT) + 1)) AS by_ FROM (SELECT y0, y1, unnest(range(CAST(floor(x0 / 50) AS BIGINT), CAST(floor(x1 / 50) AS BIGINT) + 1)) AS bx FROM b)) GROUP BY 1, 2")
def rect_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Boxes per grid bucket."""
    return op.grid(boxes(spark, d)).groupBy("bx", F.col("by").alias("by_")).agg(F.count("*").alias("n"))


@query(sql(N, B) + """, xs AS (SELECT volume, page, list_sort(list(DISTINCT round(x0, 1))) AS xs FROM b GROUP BY 1, 2),
cs AS (SELECT volume, page, list_reduce(list_transform(xs, lambda x: [x]), lambda a, x: CASE WHEN x[1] - a[-1] > 100 THEN list_concat(a, x) ELSE a END) AS cols FROM xs)
SELECT rid, base, CAST(least(2, greatest(0, round_even((x0 - base) / 10.8, 0))) AS INTEGER) AS level FROM (SELECT b.rid, b.x0, coalesce(list_max(list_filter(cols, lambda c: c <= b.x0 + 2)), cols[1]) AS base FROM b JOIN cs USING (volume, page))""")
def indent_level(spark: SparkSession, d: str) -> DataFrame:
    """The level of each box by its indent from the nearest column base at or left of it; a page's columns begin more than 100 points apart."""
    b = boxes(spark, d)
    xs = b.groupBy("volume", "page").agg(F.array_sort(F.collect_set(F.round("x0", 1))).alias("xs"))
    cols = F.aggregate(F.slice("xs", 2, 1_000_000), F.slice("xs", 1, 1), lambda a, x: F.when(x - F.element_at(a, -1) > 100, F.concat(a, F.array(x))).otherwise(a))
    x = b.join(xs.select("volume", "page", cols.alias("cols")), ["volume", "page"])
    base = F.coalesce(F.array_max(F.filter("cols", lambda c: c <= F.col("x0") + 2)), F.get("cols", F.lit(0)))
    return x.withColumn("base", base).select("rid", "base", F.least(F.lit(2), F.greatest(F.lit(0), F.bround((F.col("x0") - F.col("base")) / 10.8).cast("int"))).alias("level"))


@query(sql(N, B) + """, e AS (SELECT * FROM b WHERE node_type IN ('index_entry', 'index_subentry')), s AS (SELECT *, CASE WHEN y0 - lag(y0) OVER (PARTITION BY volume, page ORDER BY y0, rid) < 14 THEN 0 ELSE 1 END AS new FROM e),
k AS (SELECT *, sum(new) OVER (PARTITION BY volume, page ORDER BY y0, rid) AS row_no FROM s)
SELECT volume, page, row_no, count(*) AS entries, min(rid) AS first, min(x0) AS x0 FROM k GROUP BY 1, 2, 3""")
def toc_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of index pages: entries whose tops lie less than 14 points apart make one row."""
    w = Window.partitionBy("volume", "page").orderBy("y0", "rid")
    e = boxes(spark, d).where("node_type in ('index_entry', 'index_subentry')").withColumn("new", F.when(F.col("y0") - F.lag("y0").over(w) < 14, 0).otherwise(1))
    return e.withColumn("row_no", F.sum("new").over(w)).groupBy("volume", "page", "row_no").agg(F.count("*").alias("entries"), F.min("rid").alias("first"), F.min("x0").alias("x0"))
