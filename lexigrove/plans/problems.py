"""Queries over the general problems: orphan references, wide tables, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.operators.hierarchy import closure_faults, hierarchy
from lexigrove.operators.orphans import ForeignKey, orphan_report, orphans
from lexigrove.operators.wide import wide_rows, wide_values
from lexigrove.sources.tables import table

IS_TERM = "coalesce(lower(trim(BOTH '\t\n\r ' FROM kind)), '') = 'term'"

#: The references of the document graph: an end of a ref must hold at seen_at; nodes of one load come in any order, so a parent must only exist.
GRAPH_KEYS = [
    ForeignKey("node", "parent", "node", record="rid", at=None, child_id="id"),
    ForeignKey("ref", "src", "node", record="ref_id", at="seen_at", blank_is_orphan=True),
    ForeignKey("ref", "dst", "definition", record="ref_id", at="seen_at", where=IS_TERM),
    ForeignKey("ref", "dst", "node", record="ref_id", at="seen_at", where=f"not ({IS_TERM})"),
]


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans({t: table(spark, d, t) for t in ("node", "ref", "definition")}, GRAPH_KEYS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Ends of refs that are orphan at their seen_at."""
    return _orphans(spark, d).where("table = 'ref' and how = 'direct'").select(F.col("record").cast("bigint").alias("ref_id"), "field").distinct()


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphan ends per target table and month."""
    return orphan_report(_orphans(spark, d))


def p2_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Orphan node records with the round of the cascade that reached them."""
    return _orphans(spark, d).where("table = 'node'").select(F.col("record").cast("bigint").alias("rid"), "how", "round").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The values of the wide rows of all tables."""
    catalog = table(spark, d, "attr_catalog")
    return wide_values(wide_rows(table(spark, d, "cell"), catalog), catalog)


def p3_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per (table_id, r) with the typed columns of the catalog."""
    return wide_rows(table(spark, d, "cell"), table(spark, d, "attr_catalog"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Faults of the stored closure against the hierarchy of all node rows."""
    return closure_faults(table(spark, d, "node"), table(spark, d, "closure")).distinct()


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    """State, depth, root key and full path (root first) of every node."""
    return hierarchy(table(spark, d, "node")).select("key", "state", "depth", "root", F.array_join(F.reverse(F.concat(F.array("key"), "path")), " > ").alias("full_path"))


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p2_cascade, p3_found, p3_wide, p4_found, p4_nodes)}

_WS = "concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), ' ', chr(133), chr(160), chr(8203), chr(8239), chr(12288), chr(65279))"


def _key(col: str) -> str:
    return f"nullif(lower(trim({col}, {_WS})), '')"


_P2_ENDS = f"""
    SELECT ref_id, 'src' AS field, 'node' AS parent, {_key("src")} AS key, seen_at FROM ref
    UNION ALL
    SELECT ref_id, 'dst', CASE WHEN {_key("kind")} = 'term' THEN 'definition' ELSE 'node' END, {_key("dst")}, seen_at FROM ref WHERE {_key("dst")} IS NOT NULL"""
_P2_LIVES = f"""
    SELECT DISTINCT 'node' AS parent, {_key("id")} AS key, loaded_at, deleted_at FROM node
    UNION ALL SELECT DISTINCT 'definition', {_key("id")}, loaded_at, deleted_at FROM definition"""

_SPACES = "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+"
_NOTES = "( ?[(\\[] ?[0-9]{1,2} ?[)\\]])+$"
_BARE = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
_HEAD = _BARE.replace("{}", f"regexp_replace(rtrim(b.t, ' :'), '{_NOTES}', '')")
_WHOLE = "coalesce(nullif(regexp_extract(t, '^([0-9]*)', 1), ''), '0')"
_P3 = f"""
WITH g AS (SELECT table_id, r, c, greatest(coalesce(rowspan, 1), 1) AS rowspan, greatest(coalesce(colspan, 1), 1) AS colspan, trim(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS t
  FROM (SELECT *, row_number() OVER (PARTITION BY table_id, r, c ORDER BY loaded_at DESC NULLS LAST, text DESC NULLS LAST) AS rn FROM cell WHERE table_id IS NOT NULL AND r IS NOT NULL AND c IS NOT NULL) WHERE rn = 1),
w AS (SELECT table_id, max(c + colspan) AS ncols FROM g GROUP BY 1),
b AS (SELECT g.* FROM g JOIN w USING (table_id) WHERE colspan < ncols OR ncols = 1),
h AS (SELECT table_id, min(r) AS head_r FROM b GROUP BY 1),
k AS (SELECT attr, data_type, unit, unnest([{_BARE.format("label")}, {_BARE.format("label || coalesce(unit, '')")}, {_BARE.format("short_label")}, {_BARE.format("short_label || coalesce(unit, '')")}]) AS key FROM attr_catalog),
hd AS (SELECT b.table_id, b.c, {_HEAD} AS key FROM b JOIN h ON h.table_id = b.table_id AND h.head_r = b.r),
ag AS (SELECT b.table_id, b.r FROM b JOIN h USING (table_id) LEFT JOIN hd ON hd.table_id = b.table_id AND hd.c = b.c WHERE b.r > head_r AND {_HEAD} <> '' GROUP BY 1, 2 HAVING count(*) > 1 AND bool_and({_HEAD} IS NOT DISTINCT FROM hd.key)),
sp AS (SELECT table_id, c, t, r AS own_r, unnest(range(r, r + rowspan)) AS r FROM b JOIN h USING (table_id) WHERE r > head_r),
ce AS (SELECT table_id, CAST(r AS INTEGER) AS r, c, arg_max(t, own_r) AS t FROM sp GROUP BY 1, 2, 3),
v AS (SELECT DISTINCT ce.table_id, ce.r, ce.c, k.attr, k.data_type, ce.t AS full_text,
    regexp_replace(trim(CASE WHEN unit IS NOT NULL AND ends_with(lower(n), lower(unit)) THEN left(n, length(n) - length(unit)) ELSE n END), '{_NOTES}', '') AS u
  FROM (SELECT *, regexp_replace(t, '{_NOTES}', '') AS n FROM ce) ce JOIN hd ON hd.table_id = ce.table_id AND hd.c = ce.c JOIN k ON k.key = hd.key
  WHERE (ce.table_id, ce.r) NOT IN (SELECT table_id, r FROM ag) AND NOT regexp_full_match(ce.t, '[-\\s\\x{{2010}}-\\x{{2015}}\\x{{2212}}_.]*') AND lower(ce.t) NOT IN ('n/a', 'n.a.')),
s AS (SELECT *, CASE WHEN regexp_matches(u, '^[-\\x{{2212}}\\x{{2010}}-\\x{{2015}}] ?[0-9.,½¼¾]') THEN '-' ELSE '' END AS sign, regexp_replace(u, '^[-\\x{{2212}}\\x{{2010}}-\\x{{2015}}] ?', '') AS t FROM v),
x AS (SELECT table_id, r, c, attr, CASE data_type
    WHEN 'text' THEN full_text
    WHEN 'integer' THEN CASE WHEN regexp_full_match(t, '[0-9]{{1,3}}([ ,][0-9]{{3}})+|[0-9]+') THEN CAST(CAST(sign || regexp_replace(t, '[^0-9]', '', 'g') AS BIGINT) AS VARCHAR) END
    WHEN 'decimal' THEN CASE WHEN regexp_full_match(t, '[0-9]+([.,][0-9]*)?|[.,][0-9]+') THEN CAST(CAST(sign || replace(t, ',', '.') AS DECIMAL(20, 2)) AS VARCHAR)
      WHEN regexp_full_match(t, '[0-9]* ?[½¼¾]') THEN CAST(CAST(sign || {_WHOLE} || CASE WHEN t LIKE '%½' THEN '.5' WHEN t LIKE '%¼' THEN '.25' ELSE '.75' END AS DECIMAL(20, 2)) AS VARCHAR)
      WHEN regexp_full_match(t, '([0-9]+ )?[0-9]+ ?[/\\x{{2044}}] ?[1-9][0-9]*') THEN CAST(CAST(CASE WHEN sign = '' THEN 1 ELSE -1 END * (CAST(coalesce(nullif(regexp_extract(t, '^([0-9]+) [0-9]', 1), ''), '0') AS DOUBLE)
        + CAST(regexp_extract(t, '([0-9]+) ?[/\\x{{2044}}]', 1) AS DOUBLE) / CAST(regexp_extract(t, '([0-9]+)$', 1) AS DOUBLE)) AS DECIMAL(20, 2)) AS VARCHAR) END
    WHEN 'boolean' THEN CASE WHEN lower(u) IN ('yes', 'y', 'required', 'permitted') THEN 'true' WHEN lower(u) IN ('no', 'n', 'not required', 'not permitted') THEN 'false' END
    WHEN 'date' THEN CAST(CAST(coalesce(try_strptime(u, '%Y-%m-%d'), try_strptime(u, '%Y/%m/%d'), try_strptime(lower(u), '%d %b. %Y'), try_strptime(lower(u), '%d %B %Y'), try_strptime(lower(u), '%B %d, %Y')) AS DATE) AS VARCHAR) END AS val FROM s)
SELECT table_id, r, attr, arg_min(val, c) AS val FROM x WHERE val IS NOT NULL GROUP BY 1, 2, 3"""

ORACLE = {
    "p3_found": _P3,
    "p2_found": f"""
SELECT DISTINCT e.ref_id, e.field FROM ({_P2_ENDS}) e
WHERE NOT EXISTS (SELECT 1 FROM ({_P2_LIVES}) a WHERE a.parent = e.parent AND a.key = e.key AND a.loaded_at <= e.seen_at AND (a.deleted_at IS NULL OR a.deleted_at > e.seen_at))""",
    "p2_cascade": f"""
WITH RECURSIVE n AS (SELECT DISTINCT rid, {_key("id")} AS key, {_key("parent")} AS up FROM node),
c AS (SELECT rid, key, 'direct' AS how, 0 AS round FROM n WHERE up IS NOT NULL AND up NOT IN (SELECT key FROM n WHERE key IS NOT NULL)
      UNION SELECT n.rid, n.key, 'inherited', c.round + 1 FROM n JOIN c ON n.up = c.key WHERE c.round < 200)
SELECT rid, arg_min(how, round) AS how, CAST(min(round) AS INTEGER) AS round FROM c GROUP BY rid""",
    "p2_report": f"""
WITH RECURSIVE n AS (SELECT DISTINCT rid, {_key("id")} AS key, {_key("parent")} AS up FROM node),
c AS (SELECT rid, key, up, 'direct' AS how, 0 AS round FROM n WHERE up IS NOT NULL AND up NOT IN (SELECT key FROM n WHERE key IS NOT NULL)
      UNION SELECT n.rid, n.key, n.up, 'inherited', c.round + 1 FROM n JOIN c ON n.up = c.key WHERE c.round < 200),
nd AS (SELECT rid, up, arg_min(how, round) AS how FROM c GROUP BY 1, 2),
ends AS (SELECT DISTINCT * FROM ({_P2_ENDS})), lives AS ({_P2_LIVES}),
direct AS (SELECT e.* FROM ends e WHERE NOT EXISTS (SELECT 1 FROM lives a WHERE a.parent = e.parent AND a.key = e.key AND a.loaded_at <= e.seen_at AND (a.deleted_at IS NULL OR a.deleted_at > e.seen_at))),
below AS (SELECT e.* FROM ends e WHERE e.parent = 'node' AND e.key IN (SELECT key FROM c) AND (e.ref_id, e.field) NOT IN (SELECT ref_id, field FROM direct)),
f AS (SELECT 'node' AS target_table, NULL AS month, how, 'node' AS tab, rid AS record FROM nd
      UNION ALL SELECT parent, strftime(seen_at AT TIME ZONE 'UTC', '%Y-%m'), 'direct', 'ref', ref_id FROM direct
      UNION ALL SELECT parent, strftime(seen_at AT TIME ZONE 'UTC', '%Y-%m'), 'inherited', 'ref', ref_id FROM below)
SELECT target_table, month, how, count(*) AS ends, count(DISTINCT (tab, record)) AS records FROM f GROUP BY 1, 2, 3""",
    "p4_found": f"""
WITH RECURSIVE n AS (
  SELECT {_key("id")} AS key, min(id) AS label, min({_key("parent")}) FILTER (WHERE {_key("parent")} IN (SELECT {_key("id")} FROM node)) AS up
  FROM node WHERE {_key("id")} IS NOT NULL GROUP BY 1),
tree AS (SELECT key FROM n WHERE up IS NULL UNION SELECT n.key FROM n JOIN tree ON n.up = tree.key),
pairs AS (SELECT key AS ancestor, key AS descendant, 0 AS depth FROM tree
          UNION ALL SELECT n.up, p.descendant, p.depth + 1 FROM pairs p JOIN n ON n.key = p.ancestor WHERE n.up IS NOT NULL),
loops AS (SELECT key AS a, up AS here FROM n WHERE up IS NOT NULL AND key NOT IN (SELECT key FROM tree)
          UNION SELECT l.a, n.up FROM loops l JOIN n ON n.key = l.here WHERE n.up IS NOT NULL),
stored AS (SELECT {_key("ancestor")} AS ancestor, {_key("descendant")} AS descendant, min(coalesce(depth, -1)) AS lo, max(coalesce(depth, -1)) AS hi, min(ancestor) AS a_text, min(descendant) AS d_text
           FROM closure WHERE {_key("ancestor")} IS NOT NULL AND {_key("descendant")} IS NOT NULL GROUP BY 1, 2),
faults AS (SELECT CASE WHEN s.lo IS NULL THEN 'missing' WHEN p.depth IS NULL THEN 'extra' WHEN s.lo <> p.depth OR s.hi <> p.depth THEN 'depth' END AS fault,
             coalesce(p.ancestor, s.ancestor) AS ak, coalesce(p.descendant, s.descendant) AS dk, s.a_text, s.d_text
           FROM pairs p FULL JOIN stored s ON p.ancestor = s.ancestor AND p.descendant = s.descendant)
SELECT DISTINCT fault, coalesce(a.label, a_text) AS ancestor, coalesce(d.label, d_text) AS descendant
FROM faults LEFT JOIN n a ON a.key = ak LEFT JOIN n d ON d.key = dk
WHERE fault IS NOT NULL AND (d.key IS NULL OR d.key IN (SELECT key FROM tree))
UNION SELECT 'cycle', label, label FROM n WHERE key IN (SELECT a FROM loops WHERE a = here)""",
    "p4_nodes": f"""
WITH RECURSIVE n AS (
  SELECT {_key("id")} AS key, min({_key("parent")}) FILTER (WHERE {_key("parent")} IN (SELECT {_key("id")} FROM node)) AS up FROM node WHERE {_key("id")} IS NOT NULL GROUP BY 1),
tree AS (SELECT key, 0 AS depth, key AS root, key AS full_path FROM n WHERE up IS NULL
         UNION ALL SELECT n.key, t.depth + 1, t.root, t.full_path || ' > ' || n.key FROM n JOIN tree t ON n.up = t.key),
loops AS (SELECT key AS a, up AS here FROM n WHERE up IS NOT NULL AND key NOT IN (SELECT key FROM tree)
          UNION SELECT l.a, n.up FROM loops l JOIN n ON n.key = l.here WHERE n.up IS NOT NULL)
SELECT key, 'tree' AS state, depth, root, full_path FROM tree
UNION ALL SELECT key, CASE WHEN key IN (SELECT a FROM loops WHERE a = here) THEN 'cycle' ELSE 'below' END, NULL, NULL, NULL FROM n WHERE key NOT IN (SELECT key FROM tree)""",
}
