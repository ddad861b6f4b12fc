"""The citation grammar: references in headings, bodies and cells with their places, parts, context and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.plans.registry import Registry
from lexigrove.plans.views import G, N, cells, nodes, sql
from lexigrove.sources.tables import table

R = Registry()
query = R.query

# The alternatives of the grammar in their order, the bodies that issue standards, and the context that qualifies a citation.
ISSUERS = "CSA|ASTM|ASHRAE|ANSI|ULC|NFPA|ISO|AAMA|ACI|AWWA|CGSB|NSF|AWS|BNQ|AISI|AISC|SMACNA|HVI|MSS|WDMA|APA|ASME|ASSE|CAN"
ALTERNATIVES = [
    ("cap_ref", r"(?:Table|Figure)\s+[A-Z]?-?[0-9]+(?:\.[0-9]+){1,4}\.?(?:-[A-Z0-9/]+)?"),
    ("note", r"\bNote\s+A-[0-9]+(?:\.[0-9]+)*[^\s,;)]*"),
    ("supp", r"\bS[ABC]-[0-9]+\b"),
    ("form", r"\bForm\s+[0-9]+(?:\.[0-9]+){1,4}\.?-[A-Z]"),
    ("ca", r"\bC\.A\.\s*[A-F][0-9]{1,3}"),
    ("std", rf"\b(?:[A-Z]{{2,6}}/)?(?:{ISSUERS})[\s/\-]+[A-Z]{{0,6}}[0-9][0-9A-Za-z_./\-]*"),
    ("code_ref", r"[0-9]+(?:\.[0-9]+){1,4}[A-Z]?\.(?:\([0-9]+(?:\.[0-9]+)?\))?(?:\([a-z]\))?"),
    ("act_ref", r"\b(?:section|subsection|clause)s?\s+[0-9]+(?:\.[0-9]+){0,2}(?:\([0-9]+(?:\.[0-9]+)?\))?(?:\([a-z](?:\.[0-9]+)?\))?"),
    ("short", r"\bss?\.\s*[0-9]+(?:\.[0-9]+)?"),
]
GRAMMAR = "|".join(f"(?:{p})" for _, p in ALTERNATIVES)
TAIL = 22
OF_DIVISION = r"^\s*of\s+Division\s+([ABC])"
OF_THIS_ACT = r"(?i)^\s*of\s+(?:this|the)\s+Act\b"
OTHER_ACT = r"of the [A-Z][0-9A-Za-z_ ]+ Act"
#: Characters before and after a citation of an Act in which the name of another one counts.
BEFORE, AFTER = 8, 60

PARTS = [("number", r"^[^0-9]*([0-9]+(?:[.][0-9]+)*[A-Z]?)"), ("sentence", r"\(([0-9]+(?:[.][0-9]+)?)\)"), ("clause", r"\(([a-z](?:[.][0-9]+)?)\)$")]


def citations(c: str) -> Column:
    """array<struct<kind, s, e, text, before, tail, around>> of the citations in a text: leftmost first, the earliest alternative of equals, without overlaps.

    Places are zero-based, the end exclusive. Matches are bracketed by two control characters, which the text itself loses for blanks, and the pieces between
    them counted, so all of it stays in the JVM.
    """
    text = F.translate(F.col(c), "\x01\x02", "  ")
    pieces = F.split(F.regexp_replace(text, GRAMMAR, "\x01$0\x02"), "[\x01\x02]")

    def kind(x: Column) -> Column:
        out = F.when(F.lit(False), "")
        for name, pattern in ALTERNATIVES:
            out = out.when(x.rlike(f"^(?:{pattern})$"), name)
        return out

    def one(v: Column, i: Column) -> Column:
        match, s = F.get(v["p"], 2 * i - 1), F.length(F.array_join(F.slice(v["p"], F.lit(1), 2 * i - 1), ""))
        return F.struct(kind(match).alias("kind"), s.alias("s"), match.alias("text"))

    def with_context(v: Column, x: Column) -> Column:
        e = x["s"] + F.length(x["text"])
        lo = F.greatest(x["s"] - BEFORE, F.lit(0))
        return F.struct(x["kind"], x["s"], e.alias("e"), x["text"], F.when(x["s"] > 0, F.substring(v["t"], x["s"], F.lit(1))).alias("before"), F.substring(v["t"], e + 1, F.lit(TAIL)).alias("tail"), F.substring(v["t"], lo + 1, e + AFTER - lo).alias("around"))

    def found(v: Column) -> Column:
        matches = F.transform(F.filter(F.sequence(F.lit(0), F.floor(F.size(v["p"]) / 2).cast("int")), lambda i: i > 0), lambda i: one(v, i))
        return F.transform(matches, lambda x: with_context(v, x))

    # An array of one makes text and pieces variables of the lambda, so that they are computed once a row.
    return F.flatten(F.transform(F.array(F.struct(text.alias("t"), pieces.alias("p"))), found))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """(owner, chunk, text): headings h, bodies *, and each cell of a table g{row}.{column}."""
    n = nodes(spark, d)
    part = lambda c, tag: n.where(F.col(c).isNotNull()).select(F.col("id").alias("owner"), F.lit(tag).alias("chunk"), F.col(c).alias("text"))
    grid = cells(spark, d).where("text is not null").select(F.col("table_id").alias("owner"), F.concat(F.lit("g"), F.col("r").cast("string"), F.lit("."), F.col("c").cast("string")).alias("chunk"), "text")
    return part("heading", "h").unionByName(part("body", "*")).unionByName(grid)


def documents(spark: SparkSession, d: str) -> DataFrame:
    """(owner, chunk, text) of all documents; repeated rows once."""
    return table(spark, d, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("owner"), F.lit("d").alias("chunk"), "text").distinct()


def cited(texts: DataFrame) -> DataFrame:
    """(owner, chunk, ord, kind, s, e, text, number, sentence, clause, division, this_act, skipped) of every citation in texts (owner, chunk, text).

    division: the qualifier "of Division X" behind it. this_act: "of this (or the) Act" behind it. skipped: why the grammar leaves the match out: a letter before it (part of
    a standard's designation), another statute named around it, or a short form that names no Act.
    """
    x = texts.select("owner", "chunk", F.posexplode(citations("text")).alias("ord", "c")).select("owner", "chunk", "ord", "c.*")
    own = (F.col("tail").rlike(OF_THIS_ACT)) | F.col("tail").contains("this Act")
    skipped = (
        F.when((F.col("kind") == "code_ref") & F.coalesce(F.col("before").rlike("[A-Za-z]"), F.lit(False)), "part of a designation")
        .when((F.col("kind") == "code_ref") & F.col("tail").rlike(OTHER_ACT), "another statute")
        .when((F.col("kind") == "act_ref") & F.col("around").rlike(OTHER_ACT), "another statute")
        .when((F.col("kind") == "short") & ~own, "amending statute")
    )
    parts = [F.nullif(F.regexp_extract("text", p, 1), F.lit("")).alias(n) for n, p in PARTS]
    return x.select("owner", "chunk", "ord", "kind", "s", "e", "text", *parts, F.nullif(F.regexp_extract("tail", OF_DIVISION, 1), F.lit("")).alias("division"), F.col("tail").rlike(OF_THIS_ACT).alias("this_act"), skipped.alias("skipped"))


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_KIND = "CASE " + " ".join(f"WHEN regexp_full_match(text, {_q(p)}) THEN '{n}'" for n, p in ALTERNATIVES) + " END"
NODE_CHUNKS = "SELECT id AS owner, 'h' AS chunk, heading AS t FROM n WHERE heading IS NOT NULL UNION ALL SELECT id, '*', body FROM n WHERE body IS NOT NULL UNION ALL SELECT table_id, 'g' || r || '.' || c, text FROM g WHERE text IS NOT NULL"
DOCUMENTS = "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS owner, 'd' AS chunk, text AS t FROM documents WHERE text IS NOT NULL"
CITED = f"""pc AS (SELECT owner, chunk, t, string_split(translate(regexp_replace(t, {_q("(" + GRAMMAR + ")")}, chr(1) || '\\1' || chr(2), 'g'), chr(2), chr(1)), chr(1)) AS p FROM (SELECT owner, chunk, translate(t, chr(1) || chr(2), '  ') AS t FROM ch)),
px AS (SELECT owner, chunk, t, p, unnest(range(1, len(p) // 2 + 1)) AS i FROM pc WHERE len(p) > 1),
ps AS (SELECT owner, chunk, t, CAST(i - 1 AS INTEGER) AS ord, CAST(list_sum(list_transform(p[1:2 * i - 1], lambda x: length(x))) AS INTEGER) AS s, p[2 * i] AS text FROM px),
pe AS (SELECT *, {_KIND} AS kind, s + CAST(length(text) AS INTEGER) AS e, substr(t, s + length(text) + 1, {TAIL}) AS tail, CASE WHEN s > 0 THEN substr(t, s, 1) END AS before, substr(t, greatest(s - {BEFORE}, 0) + 1, s + length(text) + {AFTER} - greatest(s - {BEFORE}, 0)) AS around FROM ps),
ci AS (SELECT owner, chunk, ord, kind, s, e, text, {", ".join(f"nullif(regexp_extract(text, {_q(p)}, 1), '') AS {n}" for n, p in PARTS)}, nullif(regexp_extract(tail, {_q(OF_DIVISION)}, 1), '') AS division, regexp_matches(tail, {_q(OF_THIS_ACT)}) AS this_act,
  CASE WHEN kind = 'code_ref' AND coalesce(regexp_matches(before, '[A-Za-z]'), false) THEN 'part of a designation' WHEN kind = 'code_ref' AND regexp_matches(tail, {_q(OTHER_ACT)}) THEN 'another statute' WHEN kind = 'act_ref' AND regexp_matches(around, {_q(OTHER_ACT)}) THEN 'another statute'
    WHEN kind = 'short' AND NOT (regexp_matches(tail, {_q(OF_THIS_ACT)}) OR contains(tail, 'this Act')) THEN 'amending statute' END AS skipped FROM pe)"""


@query(sql(N, G, f"ch AS ({NODE_CHUNKS})", CITED) + "SELECT owner, chunk, ord, kind, s, e, text, number, sentence, clause FROM ci WHERE skipped IS NULL")
def extract_citations(spark: SparkSession, d: str) -> DataFrame:
    """All citations that headings, bodies and cells make, with their places and parts."""
    return cited(chunks(spark, d)).where("skipped is null").select("owner", "chunk", "ord", "kind", "s", "e", "text", "number", "sentence", "clause")


@query(sql(N, G, f"ch AS ({NODE_CHUNKS} UNION ALL {DOCUMENTS})", CITED) + "SELECT kind, coalesce(skipped, 'kept') AS outcome, count(*) AS n, min(text) AS sample FROM ci GROUP BY 1, 2")
def citation_skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Matches of the grammar in all texts per kind, and how many of them context leaves out, by reason."""
    return cited(chunks(spark, d).unionByName(documents(spark, d))).groupBy("kind", F.coalesce("skipped", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("sample"))


@query(sql(f"ch AS ({DOCUMENTS})", CITED) + "SELECT owner, chunk, ord, division, this_act, skipped = 'another statute' AS other_act FROM ci WHERE division IS NOT NULL OR this_act OR skipped = 'another statute'")
def division_qualifier(spark: SparkSession, d: str) -> DataFrame:
    """Citations in documents with a qualifier behind them: a division, this Act, another Act."""
    return cited(documents(spark, d)).where("division is not null or this_act or skipped = 'another statute'").select("owner", "chunk", "ord", "division", "this_act", (F.col("skipped") == "another statute").alias("other_act"))
