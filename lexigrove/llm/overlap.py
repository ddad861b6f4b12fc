"""Same or near-same evaluation records across splits, by Aho-Corasick automata over sharded evaluation passages."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexigrove.functions.ids import id_key, trimmed
from lexigrove.operators.blocks import over_blocks
from lexigrove.session import cut

#: Evaluation passages an automaton holds, and training texts that one task scans with it.
SHARD_ROWS, BLOCK_ROWS = 50_000, 40_000
#: Words that are looked up within the tasks, the most frequent ones; all others are looked up by a join. No influence on the result.
COMMON_WORDS = 20_000
#: A word is a slip of another that is one letter away and at least this many times as frequent.
SLIP_RATIO = 8
#: A word in fewer records than this that was not recognised as a slip counts as unknown.
KNOWN_ROWS = 3

# Number words; spelling variants and abbreviations, and words that don't tell questions apart (both are parameters).
UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
VARIANTS = {
    "storys": "storey", "stories": "storey", "story": "storey", "storeys": "storey", "center": "centre", "theater": "theatre", "meter": "metre", "fiber": "fibre",
    "color": "colour", "gray": "grey", "aluminum": "aluminium", "neighbor": "neighbour", "labor": "labour", "mold": "mould", "license": "licence", "program": "programme",
    "min": "minimum", "max": "maximum", "ht": "height", "dist": "distance", "temp": "temperature", "bldg": "building", "approx": "approximately", "dia": "diameter", "reqd": "required", "sq": "square", "no": "number",
}
SMALL = frozenset(
    "a an the of in for on at to is are be was must meet does do did i we you it there this that my our your any some and or so then well ok please hello hi hey dear kindly thanks q question just actually normally exactly generally usually really simply currently also".split()
)

_WORD = re.compile(r"[^\W_]+")
_THOUSANDS = re.compile(r"(?<=\d),(?=\d{3}(?!\d))")
_INVISIBLE = re.compile("[\\u00ad\\u200b\\u200c\\u200d\\u2060\\ufeff]")


def question_words(text: str | None) -> list[str]:
    """The words of a question in order: compatibility forms, case and punctuation folded, numbers in digits."""
    if not text:
        return []
    plain = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).lower().replace("'", "").replace("\u2019", "")
    words: list[str] = []
    open_tens = False
    for w in _WORD.findall(_THOUSANDS.sub("", plain)):
        if w in UNITS:
            n = UNITS.index(w)
            if open_tens and 0 < n < 10:  # "twenty one" is one number
                words[-1] = str(int(words[-1]) + n)
            else:
                words.append(str(n))
        elif w in TENS:
            words.append(str(20 + 10 * TENS.index(w)))
        else:
            words.append((w.lstrip("0") or "0") if w.isdigit() else w)
        open_tens = w in TENS
    return words


def settled(word: str, variants: Mapping[str, str] = VARIANTS) -> str:
    """A word without spelling variants, abbreviation and plural."""
    word = variants.get(word, word)
    if len(word) > 3 and word[-1] == "s" and word[-2] not in "sui":
        word = word[:-1]
    return variants.get(word, word)


def one_slip(a: str, b: str) -> bool:
    """Whether a and b differ by one letter changed, left out, added, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        off = [k for k in range(len(a)) if a[k] != b[k]]
        return len(off) <= 1 or len(off) == 2 and off[1] == off[0] + 1 and a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]]
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def same_question(a: list[str], b: list[str]) -> bool:
    """Exact check of two canonical passages: equal as bags of words, but for slips.

    Words left over on either side must pair off, at most two of them, each pair with an unknown word (marked ~) that is
    one letter away from, or an abbreviation of, the other; numbers never pair.
    """
    if a == b:
        return True
    left, right = list((Counter(a) - Counter(b)).elements()), list((Counter(b) - Counter(a)).elements())
    if len(left) != len(right) or len(left) > 2:
        return False

    def pair(x: str, y: str) -> bool:
        if x[0] != "~" and y[0] != "~":
            return False
        x, y = sorted((x.lstrip("~"), y.lstrip("~")), key=len)
        if not (x.isalpha() and y.isalpha()) or len(x) < 3:
            return False
        return x == y or len(x) > 3 and one_slip(x, y) or y.startswith(x)

    return all(map(pair, left, right)) or len(left) == 2 and pair(left[0], right[1]) and pair(left[1], right[0])


def _pieces(words: list[str]) -> list[tuple[int, int]]:
    """The pieces of a passage's known words as (first word, end): three, so that two differing words leave one whole; none if it has fewer words."""
    n = len(words)
    return [] if n < 3 else [(0, n // 3), (n // 3, 2 * n // 3), (2 * n // 3, n)]


def _known(words: Sequence[str]) -> list[str]:
    return [w for w in words if w[0] != "~"]


class Shard:
    """One shard of held-out passages, compiled into automata when a task first asks for them.

    rows: (id, article, words). Passages of the same words and article are held once, so a question that many rows copy is met once.
    """

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        self.ready = False

    def compile(self) -> None:
        once: dict[tuple, list] = {}
        for key, article, words in self.rows:
            once.setdefault((tuple(words), article), []).append(key)
        self.groups = [(words, article, ids) for (words, article), ids in once.items()]
        #: Every passage as a whole, by its words; and the pieces of those with unknown words, and of those without.
        self.whole, self.rough, self.clean = _Patterns(), _Patterns(), _Patterns()
        self.few: dict[tuple[int, str | None], list[int]] = defaultdict(list)  # of too few known words for pieces
        for g, (words, article, _) in enumerate(self.groups):
            self.whole.add(_whole(words), article, (g, 0, len(words)))
            known = _known(words)
            pieces = _pieces(known)
            if not pieces:
                self.few[len(words), article].append(g)
            for first, end in pieces:
                part = self.clean if len(known) == len(words) else self.rough
                part.add(_text(known[first:end]), (len(words), article), (g, first, end))
        self.few_articles = {a for _, a in self.few}
        for part in (self.whole, self.rough, self.clean):
            part.make()
        self.ready = True


class _Patterns:
    """An automaton whose patterns lead to lists by a second key."""

    def __init__(self) -> None:
        self.automaton, self.number, self.lists = ahocorasick.Automaton(), {}, []

    def add(self, pattern: str, key, value) -> None:
        if pattern not in self.number:
            self.number[pattern] = len(self.lists)
            self.lists.append({})
            self.automaton.add_word(pattern, self.number[pattern])
        self.lists[self.number[pattern]].setdefault(key, []).append(value)

    def make(self) -> None:
        if self.lists:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[dict]:
        if self.lists:
            for _, n in self.automaton.iter(text):
                yield self.lists[n]


def _text(words: Sequence[str]) -> str:
    return " " + " ".join(words) + " "


def _whole(words: Sequence[str]) -> str:
    return "^" + _text(words) + "$"


def scan(train: Iterable[tuple], shard: Shard) -> Iterator[tuple[object, object, float]]:
    """(train id, held-out id, coverage) of the same questions among (id, article, words) training rows and a shard.

    The automaton of whole passages finds equal ones. Passages that differ differ in unknown words, on one side at least; so the pieces
    of passages without unknown words are looked for only in training rows that have some.
    """
    if not shard.ready:
        shard.compile()
    groups = shard.groups
    for key, article, words in train:
        for by in shard.whole.matches(_whole(words)):
            for a in by if article is None else {article, None}:
                for g, _, _ in by.get(a, ()):
                    yield from ((key, h, 1.0) for h in groups[g][2])
        known = _known(words)
        rough = len(known) < len(words)
        n = len(words)
        intervals: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for part in (shard.rough, shard.clean) if rough else (shard.rough,):
            for by in part.matches(_text(known)):
                for k in [k for k in by if k[0] == n] if article is None else ((n, article), (n, None)):
                    for g, first, end in by.get(k, ()):
                        intervals[g].add((first, end))
        for g, parts in intervals.items():
            theirs = groups[g][0]
            if theirs != tuple(words) and same_question(words, list(theirs)):
                covered, reach = 0, 0
                for first, end in sorted(parts):
                    covered += max(0, end - max(first, reach))
                    reach = max(reach, end)
                yield from ((key, h, covered / len(_known(theirs))) for h in groups[g][2])
        for a in shard.few_articles if article is None else {article, None}:
            for g in shard.few.get((n, a), ()):
                theirs = groups[g][0]
                if theirs != tuple(words) and (rough or any(w[0] == "~" for w in theirs)) and same_question(words, list(theirs)):
                    yield from ((key, h, sum((Counter(theirs) & Counter(words)).values()) / len(theirs)) for h in groups[g][2])


def article_key(target: str) -> Column:
    """The article that a target names: its key without the levels in parentheses; null for null and blank."""
    return F.regexp_replace(id_key(target), r"(/\([^/]*\))+$", "")


def split_key(split: str) -> Column:
    return F.lower(trimmed(split))


def _folded(records: DataFrame, id_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [question_words(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(words, pa.list_(pa.string()))], names=["id", "split", "article", "words"])

    kind = records.schema[id_col].dataType.simpleString()
    base = records.select(F.col(id_col).alias("id"), split_key("split").alias("split"), article_key("target").alias("article"), "q").where("id is not null and q is not null and split in ('train', 'dev', 'test')")
    return base.mapInArrow(run, f"id {kind}, split string, article string, words array<string>").where(F.size("words") > 0).distinct()


def slips(words: DataFrame) -> DataFrame:
    """(word, meant) for each word that is one letter away from a much more frequent one, meant: all such; from (word, n) counts.

    Words meet by the forms they have with one letter left out, so no word is compared with all others.
    """
    long = words.where(F.length("word") >= 4).where(~F.col("word").rlike("[0-9]"))
    forms = F.array_distinct(F.concat(F.array("word"), F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(F.expr("word").substr(F.lit(1), i - 1), F.expr("word").substr(i + 1, F.length("word"))))))
    a = long.select(F.col("word"), F.col("n"), F.explode(forms).alias("form"))
    b = a.select(F.col("word").alias("meant"), F.col("n").alias("m"), "form").where(F.col("m") >= SLIP_RATIO)
    letters = lambda c: F.sort_array(F.split(F.col(c), ""))
    near = (F.levenshtein("word", "meant") == 1) | ((F.levenshtein("word", "meant") == 2) & (letters("word") == letters("meant")))
    pairs = a.join(b, "form").where((F.col("word") != F.col("meant")) & (F.col("m") >= SLIP_RATIO * F.col("n")) & near)
    return pairs.groupBy("word").agg(F.collect_set("meant").alias("meant"))


class Canon:
    """Printed words to canonical ones: what a word of a slip's meanings or none comes to."""

    def __init__(self, variants: Mapping[str, str], small: Iterable[str]):
        self.variants, self.small = variants, frozenset(small)
        self.long_small = [s for s in self.small if len(s) > 3]
        self.numbers = {w: i for i, w in enumerate(UNITS)} | {w: 20 + 10 * i for i, w in enumerate(TENS)}

    def of(self, word: str, meant: list[str] | None, unknown: bool) -> str | None:
        """The canonical word, marked ~ where it is unknown or a slip of several words; None for a small word."""
        meanings = {settled(m, self.variants) for m in meant or [word]}
        if word in self.small or any(m in self.small for m in meant or ()) or meanings & self.small:
            return None
        if len(meanings) > 1:
            return "~" + word
        (one,) = meanings
        if not unknown:
            return one
        if any(one_slip(one, s) for s in self.long_small):
            return None
        numbers = {n for w, n in self.numbers.items() if len(w) > 3 and len(one) > 3 and one_slip(one, w)}
        return str(*numbers) if len(numbers) == 1 else "~" + one


def passages(records: DataFrame, id_col: str = "qid", variants: Mapping[str, str] = VARIANTS, small: Iterable[str] = SMALL, common_words: int = COMMON_WORDS) -> DataFrame:
    """(id, split, article, words): the canonical passage of each usable record, its content words in order of letters.

    Slips are corrected by the records' own vocabulary; a word that stays unknown, or may be a slip of several words, is marked ~ and so sorts
    last. Only the counts of words and the rare words of records are shuffled; the most frequent words are looked up in place.
    """
    spark = records.sparkSession
    canon = Canon(variants, small)
    folded = cut(_folded(records, id_col))
    counts = cut(folded.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    listed = spark.createDataFrame([(w,) for w in sorted(canon.small | set(variants))] or [("",)], "word string").withColumn("listed", F.lit(True))
    unknown = F.col("meant").isNull() & (F.col("n") < KNOWN_ROWS) & F.col("listed").isNull() & ~F.col("word").rlike("[0-9]")
    table = cut(counts.join(slips(counts), "word", "left").join(listed, "word", "left").select("word", "n", "meant", unknown.alias("unknown")))
    common = {r["word"]: canon.of(r["word"], r["meant"], r["unknown"]) for r in table.orderBy(F.desc("n"), "word").limit(common_words).collect()}
    shared = spark.sparkContext.broadcast(common)
    kind = records.schema[id_col].dataType.simpleString()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(3).to_pylist()
            words = [sorted(x for w in ws if (x := known.get(w))) for ws in texts]
            rest = [[w for w in ws if w not in known] for ws in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(words, pa.list_(pa.string())), pa.array(rest, pa.list_(pa.string()))], names=["id", "split", "article", "words", "rest"])

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bags = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            rows = [sorted(ws + [x for t in bag if (x := canon.of(t["word"], t["meant"], t["unknown"]))]) for ws, bag in zip(words, bags, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.list_(pa.string()))], names=["id", "split", "article", "words"])

    columns = f"id {kind}, split string, article string, words array<string>"
    seen = folded.mapInArrow(look_up, columns + ", rest array<string>")
    rare = seen.where(F.size("rest") > 0).select("id", "split", "article", "words", F.explode("rest").alias("word")).join(table.drop("n"), "word")
    bags = rare.groupBy("id", "split", "article", "words").agg(F.collect_list(F.struct("word", "meant", "unknown")).alias("bag"))
    done = seen.where(F.size("rest") == 0).select("id", "split", "article", "words")
    return done.unionByName(bags.mapInArrow(complete, columns)).where(F.size("words") > 0)


def overlaps(records: DataFrame, id_col: str = "qid", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, variants: Mapping[str, str] = VARIANTS, small: Iterable[str] = SMALL) -> DataFrame:
    """(train_id, held_id, coverage): pairs of a train and a dev or test record that put the same question.

    Two questions are the same when their content words are the same after folding case, punctuation, spacing, forms of
    characters, spelling variants, abbreviations, ways of writing numbers, openings and small words, and the order of
    phrases; slips of the pen are corrected. Their targets must name the same article, or one is null. coverage is the
    share of the held-out passage that the automaton found in the train text. `variants` and `small` are the lists of spellings and of small words.

    Method: the canonical dev and test passages are sharded and compiled, a shard at a time, into Aho-Corasick automata: of whole passages, and
    of the three pieces of their known words (two differing words leave one whole; passages of fewer known words meet by their
    number of words). They scan all canonical training texts; matched intervals are merged into a coverage for each evaluation record, and covered
    records are checked word by word.

    Scale: training texts are spread once and stay in place; shards of bounded size are broadcast, one alive at a time. Equal
    passages are held once and by article, so copies and hot articles are met once a text. Whole texts are never shuffled by word.

    Defined cases: null and blank questions, null ids and other splits give no rows; splits and targets compare trimmed and
    without case; a blank target counts as null; repeated rows count once; an id in several splits may meet itself and then
    gives no row; a question of small words only gives no row; empty tables give no rows; other columns are ignored.
    """
    spark = records.sparkSession
    ready = cut(passages(records, id_col, variants, small))
    kind = records.schema[id_col].dataType.simpleString()
    arrow = to_arrow_type(records.schema[id_col].dataType)
    sizes = {r[0]: r[1] for r in ready.groupBy(F.col("split") == "train").count().collect()}
    rows = ready.select("id", "article", "words")
    parts = max(spark.sparkContext.defaultParallelism, -(-sizes.get(True, 0) // block_rows))
    train = rows.where(ready["split"] == "train").repartition(parts)
    held = rows.where(ready["split"] != "train").toLocalIterator()

    def shards() -> Iterator[Shard]:
        while block := [tuple(r) for _, r in zip(range(shard_rows), held, strict=False)]:
            yield Shard(block)

    def against(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(scan(zip(*(c.to_pylist() for c in batch.columns), strict=True), shared.value))
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], arrow), pa.array([f[1] for f in found], arrow), pa.array([f[2] for f in found], pa.float64())], names=["train_id", "held_id", "coverage"])

        return train.mapInArrow(run, schema)

    schema = f"train_id {kind}, held_id {kind}, coverage double"
    met = over_blocks(spark, shards() if sizes.get(True) else (), against, schema, "overlaps")
    return met.where("train_id <> held_id").groupBy("train_id", "held_id").agg(F.max("coverage").alias("coverage"))


def overlap_report(found: DataFrame, records: DataFrame, id_col: str = "qid") -> DataFrame:
    """Overlaps per split and source of the held-out record: (split, source, records, overlapping, pairs)."""
    rows = records.select(F.col(id_col).alias("held_id"), split_key("split").alias("split"), "source").where("split in ('dev', 'test')").distinct()
    per = found.groupBy("held_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(per, "held_id", "left").groupBy("split", "source").agg(F.count(F.lit(1)).alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
