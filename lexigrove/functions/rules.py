"""Ordered rule tables that become one expression: the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks each modality, in order; the second table is the one used when text is rendered.
MODALITY = [
    ("prohibition", r"\bshall\s+not\b|\bshall\s+in\s+no\s+case\b|\b(is|are)\s+not\s+permitted\b|\bmay\s+not\b"),
    ("obligation", r"\b(shall|must)\b|\b(is|are)\s+required\s+to\b"),
    ("permission", r"\b(is|are)\s+permitted\b|\bmay\b"),
    ("exemption", r"\bneed\s+not\b|\b(is|are)\s+not\s+required\b|\bexcept\b"),
]
MODALITY_RENDERED = [
    ("prohibition", r"\bshall not\b|\bshall in no case\b|\bis not permitted\b"),
    ("obligation", r"\b(shall|must)\b|\bis required to\b"),
    ("permission", r"\b(is|are) permitted\b|\bmay\b"),
    ("exemption", r"\bneed not\b|\bis not required\b|\bexcept\b"),
]
# What the text of a line must begin with for each role.
HEAD = r"^([0-9]+([.][0-9]+)*[A-Z]?)[.]?(\s|$)"
SECTION, SECTION_OF = r"^Section\s+[0-9]+[.][0-9]+", r"^Section\s+\S+\s+of\b"
ACT_HEAD, SENTENCE, CLAUSE, SUBCLAUSE = r"^[0-9]+([.][0-9]+)*[.]?\s*(\([0-9]+\))?\s*\S", r"^\([0-9]+([.][0-9]+)?\)", r"^\([a-z]([.][0-9]+)?\)", r"^\([ivx]+\)"


def first_match(c: Column, rules: Sequence[tuple[str, str]], default: str, flags: str = "(?i)") -> Column:
    """The name of the first rule whose pattern occurs in c; null stays null."""
    out = F.when(c.isNull(), None)
    for name, pattern in rules:
        out = out.when(c.rlike(flags + pattern), name)
    return out.otherwise(default)


def first_match_sql(c: str, rules: Sequence[tuple[str, str]], default: str, options: str = "'i'") -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL " + " ".join(f"WHEN regexp_matches({c}, '{p}', {options}) THEN '{n}'" for n, p in rules) + f" ELSE '{default}' END"


def line_role(font: Column, x: Column, text: Column) -> Column:
    """The role of a printed line: section, subsection, article, label, act_section, sentence, clause, subclause or text, by the first rule that holds."""
    black, bold = font.contains("Black"), font.contains("Bold")
    number = F.regexp_extract(text, HEAD, 1)
    depth = F.when(number != "", F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1).otherwise(0)
    return (
        F.when(text.rlike(SECTION) & (black | bold) & ~text.rlike(SECTION_OF), "section")
        .when(black & (depth == 3), "subsection")
        .when(black & (depth == 4), "article")
        .when(black & (depth == 2), "section")
        .when(black & (depth == 0), "label")
        .when(bold & font.contains("Times") & text.rlike(ACT_HEAD) & (x < 400), "act_section")
        .when(text.rlike(SENTENCE), "sentence")
        .when(text.rlike(CLAUSE), "clause")
        .when(text.rlike(SUBCLAUSE), "subclause")
        .otherwise("text")
    )


_DEPTH = f"CASE WHEN regexp_extract(t, '{HEAD}', 1) <> '' THEN length(regexp_extract(t, '{HEAD}', 1)) - length(replace(regexp_extract(t, '{HEAD}', 1), '.', '')) + 1 ELSE 0 END"
_BLACK = "contains(font, 'Black')"
#: The same over columns font, x and t.
LINE_ROLE_SQL = f"""CASE WHEN regexp_matches(t, '{SECTION}') AND ({_BLACK} OR contains(font, 'Bold')) AND NOT regexp_matches(t, '{SECTION_OF}') THEN 'section' WHEN {_BLACK} AND {_DEPTH} = 3 THEN 'subsection' WHEN {_BLACK} AND {_DEPTH} = 4 THEN 'article'
  WHEN {_BLACK} AND {_DEPTH} = 2 THEN 'section' WHEN {_BLACK} AND {_DEPTH} = 0 THEN 'label' WHEN contains(font, 'Bold') AND contains(font, 'Times') AND regexp_matches(t, '{ACT_HEAD}') AND x < 400 THEN 'act_section'
  WHEN regexp_matches(t, '{SENTENCE}') THEN 'sentence' WHEN regexp_matches(t, '{CLAUSE}') THEN 'clause' WHEN regexp_matches(t, '{SUBCLAUSE}') THEN 'subclause' ELSE 'text' END"""
