"""Queries over the document graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.operators import graph as op
from lexigrove.operators.hierarchy import closure_pairs, hierarchy
from lexigrove.plans.registry import Registry
from lexigrove.plans.views import C, D, E, G, N, cells, definitions, edges, key_sql, links, nodes, sql
from lexigrove.session import exists
from lexigrove.sources.tables import table

R = Registry()
query = R.query

TREE = f"""t0 AS (SELECT {key_sql("id")} AS key, min({key_sql("parent")}) FILTER (WHERE {key_sql("parent")} IN (SELECT {key_sql("id")} FROM node)) AS up FROM node WHERE {key_sql("id")} IS NOT NULL GROUP BY 1),
tree AS (SELECT key, 0 AS depth FROM t0 WHERE up IS NULL UNION ALL SELECT t0.key, tree.depth + 1 FROM t0 JOIN tree ON t0.up = tree.key),
pairs AS (SELECT key AS ancestor, key AS descendant, 0 AS depth FROM tree UNION ALL SELECT t0.up, p.descendant, p.depth + 1 FROM pairs p JOIN t0 ON t0.key = p.ancestor WHERE t0.up IS NOT NULL)"""

LEAF_TYPES = ("sentence", "clause", "subclause")
ANCHOR = "article"


def _anchors(n: DataFrame, anchors: DataFrame | None) -> DataFrame:
    """Live nodes, of the given anchors (key) where there are any."""
    return n if anchors is None else n.join(anchors.select("key").distinct(), "key", "left_semi")


@query(sql(TREE, recursive=True) + "SELECT ancestor, descendant, depth FROM pairs")
def closure(spark: SparkSession, d: str) -> DataFrame:
    return closure_pairs(hierarchy(table(spark, d, "node")))


@query(sql(TREE, recursive=True) + "SELECT key, depth FROM tree")
def node_depth(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy(table(spark, d, "node")).where("state = 'tree'").select("key", "depth")


@query(sql(TREE, recursive=True) + "SELECT (SELECT count(*) FROM pairs) AS pairs, (SELECT sum(depth + 1) FROM tree) AS walked")
def mr_closure(spark: SparkSession, d: str) -> DataFrame:
    """Metamorphic check: as many pairs as steps of all walks to the root."""
    forest = hierarchy(table(spark, d, "node"))
    return closure_pairs(forest).agg(F.count(F.lit(1)).alias("pairs")).crossJoin(forest.where("state = 'tree'").agg(F.sum(F.col("depth") + 1).alias("walked")))


@query(sql(N, C) + """SELECT c.ancestor AS anchor, n.key, c.depth, n.page, n.rid, row_number() OVER (PARTITION BY c.ancestor ORDER BY c.depth, n.page, n.rid) AS ord
FROM c JOIN n ON n.key = c.descendant WHERE c.ancestor IN (SELECT key FROM n)""")
def subtree(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """The subtree of every live node, or of the given anchors (key)."""
    n = nodes(spark, d)
    return op.subtree(links(spark, d), n, _anchors(n, anchors))


@query(sql(C) + "SELECT ancestor, count(*) AS descendants, max(depth) AS height FROM c GROUP BY 1")
def subtree_size(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d).groupBy("ancestor").agg(F.count(F.lit(1)).alias("descendants"), F.max("depth").alias("height"))


@query(sql(C, E) + "SELECT c.ancestor, count(*) AS refs, count(DISTINCT e.kind) AS kinds FROM c JOIN e ON e.src = c.descendant GROUP BY 1")
def closure_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Refs per ancestor: counted per source and kind first, so that the join with the closure carries few rows."""
    per = edges(spark, d).groupBy("src", "kind").agg(F.count(F.lit(1)).alias("n"))
    return links(spark, d).join(per.withColumnRenamed("src", "descendant"), "descendant").groupBy("ancestor").agg(F.sum("n").alias("refs"), F.countDistinct("kind").alias("kinds"))


@query(sql(N, C) + """SELECT c.descendant AS key, c.ancestor, row_number() OVER (PARTITION BY c.descendant ORDER BY c.depth DESC, c.ancestor) AS pos
FROM c WHERE c.descendant IN (SELECT key FROM n)""")
def ancestors(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """The ancestors of every live node, or of the given anchors (key)."""
    return _ancestors(spark, d, _anchors(nodes(spark, d), anchors))


def _ancestors(spark: SparkSession, d: str, a: DataFrame) -> DataFrame:
    n = a.select(F.col("key").alias("descendant"))
    return links(spark, d).join(n, "descendant", "left_semi").select(F.col("descendant").alias("key"), "ancestor", F.row_number().over(Window.partitionBy("descendant").orderBy(F.desc("depth"), "ancestor")).alias("pos"))


@query(sql(N, E) + """, i AS (SELECT dst AS key, src, row_number() OVER (PARTITION BY dst ORDER BY src) AS k FROM (SELECT DISTINCT dst, src FROM e WHERE dst IN (SELECT key FROM n)))
SELECT key, 'parent' AS rel, up AS other FROM n WHERE up IS NOT NULL
UNION ALL SELECT up, 'child', key FROM n WHERE up IN (SELECT key FROM n)
UNION ALL SELECT DISTINCT src, CASE WHEN kind = 'term' THEN 'term' ELSE 'out' END, dst FROM e WHERE dst IS NOT NULL AND src IN (SELECT key FROM n)
UNION ALL SELECT key, 'in', src FROM i WHERE k <= 50""")
def neighbors(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """The neighbours of every live node, or of the given anchors (key)."""
    return _neighbors(spark, d, _anchors(nodes(spark, d), anchors))


def _neighbors(spark: SparkSession, d: str, anchors: DataFrame) -> DataFrame:
    n, e = nodes(spark, d), edges(spark, d)
    a = anchors.select("key", "up")
    keys = a.select("key")
    parent = a.where("up is not null").select("key", F.lit("parent").alias("rel"), F.col("up").alias("other"))
    child = n.select(F.col("key").alias("other"), F.col("up").alias("key")).join(keys, "key", "left_semi").select("key", F.lit("child").alias("rel"), "other")
    out = e.where("dst is not null").select(F.col("src").alias("key"), F.when(F.col("kind") == "term", "term").otherwise("out").alias("rel"), F.col("dst").alias("other")).join(keys, "key", "left_semi").distinct()
    into = e.select(F.col("dst").alias("key"), F.col("src").alias("other")).join(keys, "key", "left_semi").distinct()
    into = into.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("other"))).where("k <= 50").select("key", F.lit("in").alias("rel"), "other")
    return parent.unionByName(child).unionByName(out).unionByName(into)


DEPS = """deps AS (SELECT DISTINCT c.ancestor AS anchor, e.dst FROM c JOIN e ON e.src = c.descendant WHERE e.dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c x WHERE x.ancestor = c.ancestor AND x.descendant = e.dst))"""


@query(sql(N, C, E, DEPS) + "SELECT anchor, count(*) AS deps FROM deps WHERE anchor IN (SELECT key FROM n) GROUP BY 1")
def dep_count(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """The dependencies of every live node that has any, or of the given anchors (key)."""
    return op.dependencies(links(spark, d), edges(spark, d), _anchors(nodes(spark, d), anchors)).groupBy("anchor").agg(F.count(F.lit(1)).alias("deps"))


@query(sql(N, C, E, DEPS) + "SELECT anchor, count(*) AS deps FROM deps WHERE anchor IN (SELECT key FROM n) GROUP BY 1 HAVING count(*) > 50")
def hub_nodes(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """Nodes of any type with more than 50 dependencies."""
    return dep_count(spark, d, anchors).where("deps > 50")


HUBS = "hubs AS (SELECT dst AS key FROM (SELECT DISTINCT src, dst FROM e WHERE dst IS NOT NULL) GROUP BY 1 HAVING count(*) > 50)"


@query(sql(N, C, E, HUBS) + """, st AS (SELECT DISTINCT src, dst FROM e WHERE dst IS NOT NULL AND coalesce(kind, '') NOT IN ('note', 'supp', 'cap_ref')),
z AS (SELECT ancestor AS anchor, descendant AS key FROM c WHERE ancestor IN (SELECT key FROM n WHERE node_type = 'article')),
h1 AS (SELECT DISTINCT z.anchor, st.dst AS key FROM z JOIN st ON st.src = z.key WHERE z.key NOT IN (SELECT key FROM hubs) EXCEPT SELECT anchor, key FROM z),
h2 AS (SELECT DISTINCT h1.anchor, st.dst AS key FROM h1 JOIN st ON st.src = h1.key WHERE h1.key NOT IN (SELECT key FROM hubs) EXCEPT (SELECT anchor, key FROM z UNION SELECT anchor, key FROM h1))
SELECT anchor, key, 1 AS hop FROM h1 UNION ALL SELECT anchor, key, 2 FROM h2""")
def khop_expand(spark: SparkSession, d: str) -> DataFrame:
    """Two hops from each article; hubs (cited from more than 50 places) are reached but not expanded."""
    e = edges(spark, d)
    hubs = e.where("dst is not null").select("src", "dst").distinct().groupBy(F.col("dst").alias("key")).count().where("count > 50")
    steps = e.where(~F.coalesce("kind", F.lit("")).isin("note", "supp", "cap_ref"))
    return op.k_hop(links(spark, d), steps, nodes(spark, d).where("node_type = 'article'"), 2, hubs)


@query(sql(N, E) + "SELECT e.dst AS key, e.ref_id, n.rid AS citing_rid, n.node_type AS citing_type FROM e JOIN n ON n.key = e.src WHERE e.dst IS NOT NULL")
def cited_by(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d).select(F.col("key").alias("src"), F.col("rid").alias("citing_rid"), F.col("node_type").alias("citing_type"))
    return edges(spark, d).where("dst is not null").join(n, "src").select(F.col("dst").alias("key"), "ref_id", "citing_rid", "citing_type")


def _citing(spark: SparkSession, d: str) -> DataFrame:
    e = edges(spark, d).where("dst is not null")
    return e.select("dst", "src", F.when(F.col("kind") == "term", "uses_term").otherwise(F.col("kind")).alias("kind")).distinct()


@query(sql(C, E) + """, w AS (SELECT dst, src, CASE WHEN kind = 'term' THEN 'uses_term' ELSE kind END AS kind FROM e WHERE dst IS NOT NULL), p AS (SELECT ancestor, descendant FROM c UNION SELECT dst, dst FROM w)
SELECT DISTINCT p.ancestor, w.src, w.kind FROM p JOIN w ON w.dst = p.descendant""")
def what_cites(spark: SparkSession, d: str, anchor: Column | None = None) -> DataFrame:
    """(ancestor, src, kind): what cites a node or anything in its subtree, for all nodes or one anchor; a target outside of the closure stands for itself."""
    w = _citing(spark, d)
    pairs = links(spark, d).select("ancestor", F.col("descendant").alias("dst")).unionByName(w.select(F.col("dst").alias("ancestor"), "dst")).distinct()
    if anchor is not None:
        pairs = pairs.where(F.col("ancestor") == anchor)
    return pairs.join(w, "dst").select("ancestor", "src", "kind").distinct()


@query(sql(N, C) + """SELECT descendant AS key, arg_min(ancestor, (c.depth, ancestor)) AS owner FROM c JOIN n ON n.key = c.ancestor WHERE n.node_type = 'article' GROUP BY 1""")
def article_of(spark: SparkSession, d: str) -> DataFrame:
    return op.nearest_of_type(links(spark, d), nodes(spark, d), ["article"])


@query(sql(N, C, E) + "SELECT ref_id, kind FROM e WHERE src IN (SELECT descendant FROM c WHERE ancestor IN (SELECT key FROM n WHERE node_type = 'part'))")
def scope_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges out of the subtrees of all parts; the scope is a DataFrame, never a literal list."""
    parts = nodes(spark, d).where("node_type = 'part'").select(F.col("key").alias("ancestor"))
    scope = links(spark, d).join(parts, "ancestor", "left_semi").select(F.col("descendant").alias("src"))
    return edges(spark, d).join(scope, "src", "left_semi").select("ref_id", "kind")


@query(sql(N, C, E) + "SELECT DISTINCT src, dst FROM e WHERE kind = 'term' AND dst IS NOT NULL AND src IN (SELECT descendant FROM c WHERE ancestor IN (SELECT key FROM n WHERE node_type = 'division'))")
def scope_terms_semi(spark: SparkSession, d: str) -> DataFrame:
    roots = nodes(spark, d).where("node_type = 'division'").select(F.col("key").alias("ancestor"))
    scope = links(spark, d).join(roots, "ancestor", "left_semi").select(F.col("descendant").alias("src"))
    return edges(spark, d).where("kind = 'term' and dst is not null").join(scope, "src", "left_semi").select("src", "dst").distinct()


# The label of each kind of reference that a reader sees; other kinds have none.
LABELS = {"code_ref": "refers to", "act_ref": "refers to the Act", "cap_ref": "see", "note": "explained by", "supp": "supplemented by"}


@query(sql(E) + f"""SELECT e.src, e.dst, l.label FROM e JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in LABELS.items())}) l(kind, label) ON l.kind = e.kind WHERE e.dst IS NOT NULL""")
def outbound_labeled(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.createDataFrame(list(LABELS.items()), "kind string, label string")
    return edges(spark, d).where("dst is not null").join(F.broadcast(labels), "kind").select("src", "dst", "label")


@query(sql(E) + "SELECT ref_id, kind, reason, text FROM e WHERE dst IS NULL")
def unresolved_refs(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).where("dst is null").select("ref_id", "kind", "reason", "text")


@query(sql(N, D, E) + "SELECT ref_id, dst FROM e WHERE dst IS NOT NULL AND dst NOT IN (SELECT key FROM n) AND dst NOT IN (SELECT key FROM d)")
def dangling_refs(spark: SparkSession, d: str) -> DataFrame:
    known = nodes(spark, d).select(F.col("key").alias("dst")).unionByName(definitions(spark, d).select(F.col("key").alias("dst")))
    return edges(spark, d).where("dst is not null").join(known, "dst", "left_anti").select("ref_id", "dst")


# Which type of node may stand under which.
MAY_HOLD = [
    ("division", "part"), ("part", "section"), ("part", "table"), ("section", "subsection"), ("subsection", "article"), ("article", "sentence"), ("sentence", "clause"), ("clause", "subclause"),
    ("act", "act_section"), ("act_section", "act_subsection"), ("act_subsection", "act_clause"), ("appendix", "note"), ("note", "sentence"), ("index", "index_entry"), ("index_entry", "index_subentry"), ("index_subentry", "index_subentry"), ("supplementary_standard", "article"), ("supplementary_standard", "note"),
]


@query(sql(N) + f"""SELECT k.key, k.node_type, p.node_type AS parent_type FROM n k JOIN n p ON p.key = k.up WHERE (p.node_type, k.node_type) NOT IN (VALUES {", ".join(map(str, MAY_HOLD))})""")
def parent_type_conflict(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d)
    allowed = spark.createDataFrame(MAY_HOLD, "parent_type string, node_type string")
    parents = n.select(F.col("key").alias("up"), F.col("node_type").alias("parent_type"))
    return n.select("key", "up", "node_type").join(parents, "up").join(F.broadcast(allowed), ["parent_type", "node_type"], "left_anti").select("key", "node_type", "parent_type")


@query(sql(N, E) + """SELECT e.ref_id, s.node_type AS src_type, t.node_type AS dst_type FROM e LEFT JOIN n s ON s.key = e.src LEFT JOIN n t ON t.key = e.dst
WHERE e.kind = 'cap_ref' AND e.dst IS NOT NULL AND (s.key IS NULL OR t.node_type IS DISTINCT FROM 'table')""")
def invalid_binding(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d)
    e = edges(spark, d).where("kind = 'cap_ref' and dst is not null")
    both = e.join(n.select(F.col("key").alias("src"), F.col("node_type").alias("src_type")), "src", "left").join(n.select(F.col("key").alias("dst"), F.col("node_type").alias("dst_type")), "dst", "left")
    return both.where(F.col("src_type").isNull() | ~F.col("dst_type").eqNullSafe("table")).select("ref_id", "src_type", "dst_type")


@query(sql(N) + "SELECT count(*) FILTER (WHERE heading ILIKE '%See Note%') AS headed, count(*) FILTER (WHERE modality = 'prohibition' AND body NOT ILIKE '%not%') AS unfounded, count(heading) AS headings FROM n")
def heading_notes_probe(spark: SparkSession, d: str) -> DataFrame:
    """Headings that send the reader to a note, and prohibitions without a negation."""
    return nodes(spark, d).agg(F.count_if(F.col("heading").ilike("%See Note%")).alias("headed"), F.count_if((F.col("modality") == "prohibition") & ~F.col("body").ilike("%not%")).alias("unfounded"), F.count("heading").alias("headings"))


@query(sql(N, C, E) + """SELECT key, heading, heading ILIKE '%See Note%' AS promised FROM n WHERE heading <> '' AND NOT EXISTS (SELECT 1 FROM c JOIN e ON e.src = c.descendant WHERE c.ancestor = n.key AND e.kind = 'note' AND e.dst IS NOT NULL)""")
def heading_notes_unlinked(spark: SparkSession, d: str) -> DataFrame:
    """Headings without a note edge anywhere in their subtree; promised where the heading says "See Note"."""
    noted = links(spark, d).join(edges(spark, d).where("kind = 'note' and dst is not null").select(F.col("src").alias("descendant")), "descendant", "left_semi").select(F.col("ancestor").alias("key"))
    return nodes(spark, d).where("heading <> ''").join(noted, "key", "left_anti").select("key", "heading", F.col("heading").ilike("%See Note%").alias("promised"))


@query(sql(N) + "SELECT modality, count(*) AS n FROM n WHERE modality IS DISTINCT FROM 'statement' GROUP BY 1")
def nullsafe_neq(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where(~F.col("modality").eqNullSafe("statement")).groupBy("modality").agg(F.count(F.lit(1)).alias("n"))


@query(sql(N) + "SELECT p.key AS prefix, count(*) AS ids FROM n p JOIN n k ON starts_with(k.key, p.key || '/') WHERE p.node_type IN ('part', 'act', 'appendix') GROUP BY 1")
def prefix_scope(spark: SparkSession, d: str) -> DataFrame:
    """Ids below a prefix: every id is exploded into its own prefixes, so the match is an equi-join."""
    n = nodes(spark, d)
    parts = F.split("key", "/")
    own = n.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("prefix")).where(F.size(F.split("prefix", "/")) > 0)
    heads = n.where("node_type in ('part', 'act', 'appendix')").select(F.col("key").alias("prefix"))
    return own.join(heads, "prefix").groupBy("prefix").agg(F.count(F.lit(1)).alias("ids"))


@query(sql(N, C) + """, s AS (SELECT key FROM n WHERE body LIKE '%sprinklered%') SELECT key FROM s WHERE NOT EXISTS (SELECT 1 FROM c JOIN s o ON o.key = c.ancestor WHERE c.descendant = s.key AND c.depth > 0)""")
def outermost_only(spark: SparkSession, d: str) -> DataFrame:
    """Of nodes that speak of a topic, those not nested under another such node."""
    s = nodes(spark, d).where(F.col("body").contains("sprinklered")).select("key")
    nested = links(spark, d).where("depth > 0").join(s.select(F.col("key").alias("ancestor")), "ancestor", "left_semi").select(F.col("descendant").alias("key"))
    return s.join(nested, "key", "left_anti")


@query(sql(N, C) + """SELECT c.descendant AS key, string_agg(p.heading, ' > ' ORDER BY c.depth DESC, p.rid) AS trail FROM c JOIN n p ON p.key = c.ancestor JOIN n k ON k.key = c.descendant
WHERE k.node_type = 'article' AND c.depth > 0 AND p.heading IS NOT NULL GROUP BY 1""")
def scope_trail(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d)
    up = links(spark, d).where("depth > 0").join(n.where("node_type = 'article'").select(F.col("key").alias("descendant")), "descendant", "left_semi").join(n.where("heading is not null").select(F.col("key").alias("ancestor"), "heading", "rid"), "ancestor")
    trail = F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("up"), "rid", "heading")))
    return up.groupBy(F.col("descendant").alias("key")).agg(F.array_join(F.transform(trail, lambda x: x["heading"]), " > ").alias("trail"))


@query(sql(N, E) + "SELECT src, dst, kind FROM e WHERE dst IS NOT NULL UNION ALL SELECT key, up, 'part_of' FROM n WHERE up IS NOT NULL")
def ref_edges(spark: SparkSession, d: str) -> DataFrame:
    """Semantic edges and structural parent links in one edge list."""
    return edges(spark, d).where("dst is not null").select("src", "dst", "kind").unionByName(nodes(spark, d).where("up is not null").select(F.col("key").alias("src"), F.col("up").alias("dst"), F.lit("part_of").alias("kind")))


@query(sql(N, C) + """, m AS (SELECT key FROM n WHERE body LIKE '%O. Reg.%'),
u AS (SELECT c.descendant AS source, c.ancestor AS key, min(CASE WHEN c.depth = 0 OR n.node_type IN ('sentence', 'clause', 'subclause') THEN 1 ELSE 0 END) OVER (PARTITION BY c.descendant ORDER BY c.depth, c.ancestor ROWS UNBOUNDED PRECEDING) AS whole
  FROM c JOIN n ON n.key = c.ancestor WHERE c.descendant IN (SELECT key FROM m))
SELECT key, count(*) AS marks FROM u WHERE whole = 1 GROUP BY 1""")
def amendment_inherit(spark: SparkSession, d: str) -> DataFrame:
    """Nodes that name a regulation, and those above them through an unbroken chain of leaf types."""
    n = nodes(spark, d)
    return op.leaf_chain(links(spark, d), n, n.where(F.col("body").contains("O. Reg.")), LEAF_TYPES).groupBy("key").agg(F.count(F.lit(1)).alias("marks"))


OWNED = """ta AS (SELECT key, up FROM n WHERE node_type IN ('table', 'figure')),
be AS (SELECT src AS prov, dst AS bound FROM e WHERE kind = 'cap_ref' UNION SELECT dst, src FROM e WHERE kind = 'forms_part_of'),
ow AS (SELECT DISTINCT c.ancestor AS owner, be.bound FROM c JOIN be ON be.prov = c.descendant WHERE be.bound IN (SELECT key FROM ta)),
owned AS (SELECT owner, bound, 'edge' AS how FROM ow UNION ALL SELECT DISTINCT c.ancestor, ta.key, 'parent' FROM c JOIN ta ON ta.up = c.descendant WHERE c.ancestor NOT IN (SELECT owner FROM ow))"""


def owned_tables(spark: SparkSession, d: str) -> DataFrame:
    """(owner, bound, how): the tables and figures of every node: those bound by an edge to its subtree, else those whose parent stands in it."""
    t = nodes(spark, d).where("node_type in ('table', 'figure')").select(F.col("key").alias("bound"), "up")
    e = edges(spark, d)
    bound = e.where("kind = 'cap_ref'").select(F.col("src").alias("descendant"), F.col("dst").alias("bound")).union(e.where("kind = 'forms_part_of'").select("dst", "src"))
    c = links(spark, d).select(F.col("ancestor").alias("owner"), "descendant")
    by_edge = c.join(bound.join(t, "bound", "left_semi"), "descendant").select("owner", "bound").distinct()
    by_parent = c.join(t.select(F.col("up").alias("descendant"), "bound"), "descendant").select("owner", "bound").distinct().join(by_edge.select("owner"), "owner", "left_anti")
    return by_edge.withColumn("how", F.lit("edge")).unionByName(by_parent.withColumn("how", F.lit("parent")))


@query(sql(N, C, E, OWNED) + "SELECT owner, bound, how FROM owned WHERE owner IN (SELECT key FROM n)")
def bound_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables and figures of every live node."""
    return owned_tables(spark, d).join(nodes(spark, d).select(F.col("key").alias("owner")), "owner", "left_semi")


@query(sql(N, D, C) + """, x AS (SELECT d.key, n.key AS home FROM d JOIN n ON starts_with(n.key, 'v' || n.volume || '/') AND substr(n.key, length('v' || n.volume || '/') + 1) = lower(trim(d.blob)))
SELECT home, key AS ancestor, key AS descendant, 0 AS depth FROM x UNION ALL SELECT x.home, c.ancestor, x.key, c.depth + 1 FROM x JOIN c ON c.descendant = x.home""")
def closure_extend(spark: SparkSession, d: str) -> DataFrame:
    """Closure rows of definitions hung under the text they come from, in every volume that has it: its ancestors one deeper, and themselves."""
    homes = nodes(spark, d).select(F.col("key").alias("home"), F.concat(F.lit("v"), F.col("volume").cast("string"), F.lit("/")).alias("volume")).where(F.col("home").startswith(F.col("volume")))
    x = definitions(spark, d).where("blob is not null").select("key", F.lower(F.trim("blob")).alias("local")).join(homes.select("home", F.expr("substr(home, length(volume) + 1)").alias("local")), "local")
    own = x.select("home", F.col("key").alias("ancestor"), F.col("key").alias("descendant"), F.lit(0).alias("depth"))
    return own.unionByName(links(spark, d).join(x.withColumn("descendant", F.col("home")), "descendant").select("home", "ancestor", F.col("key").alias("descendant"), (F.col("depth") + 1).alias("depth")))


def merged(volumes: list[DataFrame], id_col: str = "key") -> DataFrame:
    """Volumes put together by column name; an id that occurs twice raises ValueError with the first of them, in place of a silent choice."""
    whole = reduce(DataFrame.unionByName, volumes)
    clashes = [r[0] for r in whole.groupBy(id_col).count().where("count > 1").orderBy(id_col).limit(5).collect()]
    if clashes:
        raise ValueError(f"ids that occur more than once: {', '.join(map(str, clashes))}")
    return whole


@query(sql(N) + "SELECT volume, key, rid, dense_rank() OVER (ORDER BY volume) AS place FROM n WHERE volume IS NOT NULL")
def merge_volumes(spark: SparkSession, d: str) -> DataFrame:
    """All volumes, each with its place, in one table of unique ids."""
    n = nodes(spark, d).select("volume", "key", "rid")
    volumes = sorted(r[0] for r in n.where("volume is not null").select("volume").distinct().collect())  # a library has some tens of volumes
    return merged([n.where(F.col("volume") == v).withColumn("place", F.lit(i).cast("bigint")) for i, v in enumerate(volumes, 1)])


PARTS = """p AS (SELECT key, rid, 1 + rid % 3 AS weeks FROM n WHERE node_type = 'part'),
own AS (SELECT c.descendant, c.ancestor AS part FROM c WHERE c.ancestor IN (SELECT key FROM p)),
st AS (SELECT DISTINCT a.part AS src, b.part AS dst FROM e JOIN own a ON a.descendant = e.src JOIN own b ON b.descendant = e.dst JOIN p x ON x.key = a.part JOIN p y ON y.key = b.part WHERE x.rid < y.rid)"""


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as tracks with a weight, the part of each node, and the acyclic steps between parts that cite each other."""
    p = nodes(spark, d).where("node_type = 'part'").select("key", "rid", (1 + F.col("rid") % 3).alias("weeks"))
    own = links(spark, d).join(p.select(F.col("key").alias("ancestor")), "ancestor", "left_semi").select("descendant", F.col("ancestor").alias("part"))
    e = edges(spark, d).where("dst is not null").select("src", "dst").distinct()
    ab = e.join(own.select(F.col("descendant").alias("src"), F.col("part").alias("a")), "src").join(own.select(F.col("descendant").alias("dst"), F.col("part").alias("b")), "dst").select("a", "b").distinct()
    ranked = ab.join(p.select(F.col("key").alias("a"), F.col("rid").alias("ra")), "a").join(p.select(F.col("key").alias("b"), F.col("rid").alias("rb")), "b")
    return p, own, ranked.where("ra < rb").select(F.col("a").alias("src"), F.col("b").alias("dst"))


@query(sql(N, C, E, PARTS) + "SELECT src, dst FROM st")
def dag_successors(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d)[2]


@query(sql(N, C, E, PARTS, "w AS (SELECT key, weeks AS total FROM p UNION SELECT st.dst, w.total + p.weeks FROM w JOIN st ON st.src = w.key JOIN p ON p.key = st.dst)", recursive=True) + "SELECT key, max(total) AS weeks FROM w GROUP BY 1")
def critical_path(spark: SparkSession, d: str) -> DataFrame:
    tracks, _, steps = _parts(spark, d)
    return op.longest_paths(tracks.select("key", "weeks"), steps)


STATUS = """open AS (SELECT DISTINCT own.part AS key FROM e JOIN own ON own.descendant = e.src WHERE e.dst IS NULL),
typed AS (SELECT p.key, CASE WHEN p.key NOT IN (SELECT key FROM open) THEN 'done' WHEN p.rid % 5 = 0 THEN 'conditional' WHEN p.rid % 2 = 0 THEN 'ready' ELSE 'blocked' END AS typed FROM p),
wait AS (SELECT DISTINCT st.dst AS key FROM st JOIN typed t ON t.key = st.src WHERE t.typed <> 'done')"""


@query(sql(N, C, E, PARTS, STATUS) + """SELECT key, typed, CASE WHEN typed = 'done' THEN CASE WHEN waits THEN 'error' ELSE 'done' END WHEN typed = 'conditional' THEN 'conditional' WHEN waits THEN CASE WHEN typed = 'ready' THEN 'error' ELSE 'blocked' END ELSE 'ready' END AS status FROM (SELECT *, key IN (SELECT key FROM wait) AS waits FROM typed)""")
def dag_status(spark: SparkSession, d: str) -> DataFrame:
    """The status of each part derived from the typed ones: done or ready over unfinished parts is an error, a condition stays, else it is blocked or ready.

    The typed status comes from the data: done without unresolved refs, the others by their place.
    """
    tracks, own, steps = _parts(spark, d)
    todo = edges(spark, d).where("dst is null").select(F.col("src").alias("descendant")).join(own, "descendant").select(F.col("part").alias("key")).distinct()
    typed = F.when(F.col("todo").isNull(), "done").when(F.col("rid") % 5 == 0, "conditional").when(F.col("rid") % 2 == 0, "ready").otherwise("blocked")
    t = tracks.join(todo.withColumn("todo", F.lit(True)), "key", "left").select("key", typed.alias("typed"))
    wait = steps.join(t.where("typed <> 'done'").select(F.col("key").alias("src")), "src", "left_semi").select(F.col("dst").alias("key"), F.lit(True).alias("waits")).distinct()
    waits = F.coalesce("waits", F.lit(False))
    status = F.when((F.col("typed") == "done") & waits, "error").when(F.col("typed") == "done", "done").when(F.col("typed") == "conditional", "conditional").when(waits & (F.col("typed") == "ready"), "error").when(waits, "blocked").otherwise("ready")
    return t.join(wait, "key", "left").select("key", "typed", status.alias("status"))


@query(sql(N, C) + """SELECT n.rid, repeat('  ', CAST(x.level AS INTEGER)) || coalesce(n.heading, n.key) AS entry FROM n JOIN (SELECT descendant AS key, max(depth) AS level FROM c GROUP BY 1) x USING (key)
WHERE n.node_type IN ('division', 'part', 'section', 'act', 'appendix')""")
def nav_outline(spark: SparkSession, d: str) -> DataFrame:
    level = links(spark, d).groupBy(F.col("descendant").alias("key")).agg(F.max("depth").alias("level"))
    n = nodes(spark, d).where("node_type in ('division', 'part', 'section', 'act', 'appendix')")
    return n.join(level, "key").select("rid", F.concat(F.expr("repeat('  ', level)"), F.coalesce("heading", "key")).alias("entry"))


@query(sql(N, E) + """, p AS (SELECT e.dst AS key, min(s.rid) AS after FROM e JOIN n s ON s.key = e.src WHERE e.kind = 'cap_ref' GROUP BY 1)
SELECT n.key, coalesce(p.after, n.rid) AS sort_rid, CASE WHEN p.after IS NULL THEN 0 ELSE 1 END AS placed, n.rid FROM n LEFT JOIN p USING (key) WHERE n.node_type = 'table'""")
def render_order(spark: SparkSession, d: str) -> DataFrame:
    """Where a table is rendered: after the first provision that cites it, else at its own place."""
    n = nodes(spark, d)
    first = edges(spark, d).where("kind = 'cap_ref'").join(n.select(F.col("key").alias("src"), F.col("rid").alias("src_rid")), "src").groupBy(F.col("dst").alias("key")).agg(F.min("src_rid").alias("after"))
    return n.where("node_type = 'table'").join(first, "key", "left").select("key", F.coalesce("after", "rid").alias("sort_rid"), F.when(F.col("after").isNull(), 0).otherwise(1).alias("placed"), "rid")


def _leaves(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    n = nodes(spark, d)
    a = (n.where("node_type = 'article'") if anchors is None else anchors).select(F.col("key").alias("ancestor"))
    text = n.where("body is not null").select(F.col("key").alias("descendant"), "rid", "designator", "body", "modality")
    return links(spark, d).join(a, "ancestor", "left_semi").join(text, "descendant").select(F.col("ancestor").alias("article"), "rid", "designator", "body", "modality")


@query(sql(N, C) + "SELECT c.ancestor AS anchor, n.rid, n.designator, n.body, n.modality FROM c JOIN n ON n.key = c.descendant WHERE n.body IS NOT NULL AND c.ancestor IN (SELECT key FROM n)")
def get_provision(spark: SparkSession, d: str, anchors: DataFrame | None = None) -> DataFrame:
    """The text leaves of every live node, or of the given anchors (key), with their modality."""
    return _leaves(spark, d, _anchors(nodes(spark, d), anchors)).withColumnRenamed("article", "anchor")


@query(sql(N) + "SELECT up AS key, string_agg(body, ' ' ORDER BY rid) AS text FROM n WHERE up IS NOT NULL AND body IS NOT NULL GROUP BY 1")
def node_text(spark: SparkSession, d: str) -> DataFrame:
    """The bodies of each node's children in document order."""
    kids = nodes(spark, d).where("up is not null and body is not null")
    return kids.groupBy(F.col("up").alias("key")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rid", "body"))), lambda x: x["body"]), " ").alias("text"))


@query(sql(N, C, E) + """, pr AS (SELECT 'applicability' AS probe, (SELECT count(*) FROM n WHERE node_type IN ('occupancy', 'applicability_predicate')) AS n, true AS if_none UNION ALL SELECT 'objectives', (SELECT count(*) FROM n WHERE node_type IN ('objective', 'functional_statement')), true
 UNION ALL SELECT 'temporal', 0, true UNION ALL SELECT 'rules', 0, true UNION ALL SELECT 'semantic', 1, true UNION ALL SELECT 'heading_notes', (SELECT count(*) FROM n WHERE heading ILIKE '%See Note%' AND NOT EXISTS (SELECT 1 FROM c JOIN e ON e.src = c.descendant WHERE c.ancestor = n.key AND e.kind = 'note')), false)
SELECT probe, n, CASE WHEN if_none THEN n = 0 ELSE n > 0 END AS cannot FROM pr UNION ALL SELECT 'official', NULL, true""")
def capability_probes(spark: SparkSession, d: str) -> DataFrame:
    """What the graph cannot answer, by measuring it: types and tables that aren't there (an absent table counts 0), notes that no heading links to; an official reading never."""
    typed = nodes(spark, d).agg(F.count_if(F.col("node_type").isin("occupancy", "applicability_predicate")).alias("a"), F.count_if(F.col("node_type").isin("objective", "functional_statement")).alias("b"))
    linked = links(spark, d).join(edges(spark, d).where("kind = 'note'").select(F.col("src").alias("descendant")), "descendant", "left_semi").select(F.col("ancestor").alias("key"))
    notes = nodes(spark, d).where(F.col("heading").ilike("%See Note%")).join(linked, "key", "left_anti").agg(F.count(F.lit(1)).alias("c"))
    there = lambda *names: sum(_has_table(spark, d, name) for name in names)
    probe = lambda name, n, cannot: F.struct(F.lit(name).alias("probe"), n.cast("bigint").alias("n"), cannot.alias("cannot"))
    none = [("applicability", F.col("a")), ("objectives", F.col("b")), ("temporal", F.lit(there("in_force", "edition"))), ("rules", F.lit(there("rule"))), ("semantic", F.lit(1))]  # search uses vectors
    rows = [probe(name, n, n == 0) for name, n in none] + [probe("heading_notes", F.col("c"), F.col("c") > 0), probe("official", F.lit(None), F.lit(True))]
    return typed.crossJoin(notes).select(F.explode(F.array(*rows)).alias("r")).select("r.*")  # one row each


def _has_table(spark: SparkSession, d: str, name: str) -> bool:
    return exists(spark, f"{d.rstrip('/')}/{name}.parquet")


@query(sql(N, E, D, G) + """SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM n WHERE node_type = 'article') AS articles, (SELECT count(*) FROM d) AS definitions,
(SELECT count(DISTINCT table_id) FROM g) AS tables, (SELECT count(*) FROM e) AS edges, (SELECT count(modality) FROM n) AS tagged""")
def capability_stats(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d).agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("node_type") == "article").alias("articles"), F.count("modality").alias("tagged"))
    rest = [definitions(spark, d).agg(F.count(F.lit(1)).alias("definitions")), cells(spark, d).agg(F.countDistinct("table_id").alias("tables")), edges(spark, d).agg(F.count(F.lit(1)).alias("edges"))]
    for one in rest:
        n = n.crossJoin(one)  # one row each
    return n
