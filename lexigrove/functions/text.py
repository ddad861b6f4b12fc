"""Text functions as column expressions; the few that need Unicode tables or a stemmer are Arrow-batched."""

from __future__ import annotations

import html
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Roman numerals, words without content, characters of print and their plain forms.
ROMAN = "i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx xxi xxii xxiii xxiv xxv xxvi xxvii xxviii xxix xxx".split()
STOP = "the and for are with that this from what which who how does can must may not any all its was were has have had into over under where when why you your".split()
PRINT_FORMS = {"‘": "'", "’": "'", "“": '"', "”": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", " ": " ", "ﬁ": "fi", "ﬂ": "fl"}


def normdes(c: str) -> Column:
    """A designator without points, hyphens and blanks, in capitals."""
    return F.upper(F.regexp_replace(c, r"[.\-\s]", ""))


def squash(c: str) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def slug(c: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def permalink(c: str) -> Column:
    """An id as a path that is safe in links: (2) as s2, (a) as c-a, (iv) as sc-iv, other odd characters as hyphens."""

    def segment(x: Column) -> Column:
        inner = F.regexp_extract(x, r"^\(([^)]*)\)$", 1)
        return (
            F.when(x.rlike(r"^\([0-9]+\)$"), F.concat(F.lit("s"), inner))
            .when(x.rlike(r"^\([a-z]\)$"), F.concat(F.lit("c-"), inner))
            .when(x.rlike(r"^\([ivxlc]+\)$"), F.concat(F.lit("sc-"), inner))
            .otherwise(F.regexp_replace(x, "[^A-Za-z0-9._-]", "-"))
        )

    return F.array_join(F.transform(F.split(c, "/"), segment), "/")


def anchor(c: str) -> Column:
    return F.regexp_replace(permalink(c), "/", "__")


def html_escape(c: str) -> Column:
    out = F.col(c)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    """text with named and numbered entities resolved."""
    return text.map(lambda t: None if t is None else html.unescape(t))


def repaired_designator(c: str) -> Column:
    """A designator without its last full stop, with point and hyphen before its suffix in the right order: 4.1.7.6-.G and 4.1.7.6..-G as 4.1.7.6.-G."""
    plain = F.rtrim(F.trim(c), F.lit("."))
    return F.regexp_replace(F.regexp_replace(plain, "([0-9])-[.]([A-Za-z0-9/]+)$", "$1.-$2"), "([0-9])[.][.]-([A-Za-z0-9/]+)$", "$1.-$2")


def links(c: str) -> Column:
    """The links and addresses in a text, without punctuation at their end and with the scheme they lack."""
    hits = F.regexp_extract_all(c, F.lit(r"(?:https?://|www[.])[^\s<>\"]+|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"), F.lit(0))

    def whole(x: Column) -> Column:
        bare = F.rtrim(x, F.lit(".,;:)"))
        return F.when(bare.contains("@") & ~bare.contains("/"), F.concat(F.lit("mailto:"), bare)).when(bare.startswith("www."), F.concat(F.lit("https://"), bare)).otherwise(bare)

    return F.transform(hits, whole)


def weeks(c: str) -> Column:
    """A printed effort in weeks: the figures of its first word, 1 without any; five days to a week."""
    low = F.lower(c)
    figure = F.regexp_replace(F.split_part(low, F.lit(" "), F.lit(1)), "[^0-9.]", "")
    return F.coalesce(F.nullif(figure, F.lit("")).try_cast("double"), F.lit(1.0)) / F.when(low.contains("day"), 5).otherwise(1)


def singulars(c: str) -> Column:
    """Possible singulars of a term, of its last word; not the term itself. A stem keeps at least three letters."""

    def cut(suffix: str, new: str) -> Column:
        n = len(suffix)
        stem = F.expr(f"left({c}, length({c}) - {n})")
        last = F.length(F.substring_index(c, " ", -1))
        return F.when(F.col(c).endswith(suffix) & (last - n >= 3), F.concat(stem, F.lit(new)))

    rules = F.array_compact(F.array(cut("ies", "y"), cut("ses", "s"), cut("es", ""), cut("s", ""), cut("es", "e")))
    return F.array_distinct(F.filter(rules, lambda x: x != F.col(c)))


@F.pandas_udf(StringType())
def canon_text(text: pd.Series) -> pd.Series:
    """Entities resolved, NFC, printed forms of quotes, dashes, blanks and ligatures made plain, white space folded."""
    table = str.maketrans(PRINT_FORMS)

    def one(t: str | None) -> str | None:
        return None if t is None else " ".join(unicodedata.normalize("NFC", html.unescape(t)).translate(table).split())

    return text.map(one)


@F.pandas_udf(StringType())
def term_norm(text: pd.Series) -> pd.Series:
    """A term without accents and case, hyphens and blanks folded."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        plain = "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
        return " ".join(plain.replace("’", "'").lower().replace("-", " ").split())

    return text.map(one)


def _measure(word: str) -> int:
    """Vowel-consonant sequences of a stem."""
    shape = ""
    for i, ch in enumerate(word):
        v = ch in "aeiou" or ch == "y" and i > 0 and shape[-1] == "c"
        shape += "v" if v else "c"
    return sum(1 for a, b in zip(shape, shape[1:], strict=False) if a + b == "vc")


def _vowel(word: str) -> bool:
    return any(ch in "aeiou" or ch == "y" and i > 0 and word[i - 1] not in "aeiou" for i, ch in enumerate(word))


def _cvc(word: str) -> bool:
    if len(word) < 3:
        return False
    v = [ch in "aeiou" or ch == "y" and i > 0 and word[i - 1] not in "aeiou" for i, ch in enumerate(word)]
    return not v[-3] and v[-2] and not v[-1] and word[-1] not in "wxy"


# Suffixes and their replacements of the published stemmer, steps 2 to 4.
STEP2 = "ational ate tional tion enci ence anci ance izer ize abli able alli al entli ent eli e ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble".split()
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize".split()


@lru_cache(maxsize=200_000)
def porter(word: str) -> str:
    """The stem of a lower-case word by the published suffix-stripping algorithm."""
    w = word
    if len(w) <= 2:
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    again = False
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    elif w.endswith("ed") and _vowel(w[:-2]):
        w, again = w[:-2], True
    elif w.endswith("ing") and _vowel(w[:-3]):
        w, again = w[:-3], True
    if again:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and w[-1] not in "aeioulsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    for suffix, new in sorted(zip(STEP2[::2], STEP2[1::2], strict=True), key=lambda p: -len(p[0])):
        if w.endswith(suffix):
            w = w[: -len(suffix)] + new if _measure(w[: -len(suffix)]) > 0 else w
            break
    for suffix, new in STEP3:
        if w.endswith(suffix):
            w = w[: -len(suffix)] + new if _measure(w[: -len(suffix)]) > 0 else w
            break
    for suffix in sorted([*STEP4, "ion"], key=lambda x: -len(x)):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t")):
                w = stem
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or _measure(w[:-1]) == 1 and not _cvc(w[:-1])):
        w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


@F.pandas_udf(ArrayType(StringType()))
def stems(text: pd.Series) -> pd.Series:
    """Stemmed tokens: lower case, accents off, runs of letters and digits."""
    import re

    word = re.compile(r"[^\W_]+")

    def one(t: str | None) -> list[str] | None:
        if t is None:
            return None
        plain = "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)).lower()
        return [porter(w) for w in word.findall(plain)]

    return text.map(one)
