"""Reading level of documents: a familiar-word formula over lists derived from the corpus."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.flat import FlatMemo, slices
from lexigrove.session import cut

LEAST_WORDS = 60
#: A word is familiar when it stands in at least this share of the English documents. So there are at most 1 / share times
#: as many familiar words as a document has different words on average; the list needs no cap.
FAMILIAR_SHARE = 1 / 6
#: The average sentence length leaves out the shortest sentences, up to this share of the words (headings, list items, fragments),
#: and the longest, this share of the sentences (run-on text without marks), in documents of more than three.
TRIM_SHORT, TRIM_LONG = 0.3, 0.1
#: Labelled documents that the band model is fitted on, chosen by a hash of the id; the only bounded sample here.
MOST_LABELLED = 20_000
#: Words a task counts before it hands its counts on.
HELD_WORDS = 500_000

# Function words by which the main language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as be this are by or not which an at from must shall may each every any your should can these their if when has have was were will you they he she we but on",
    "fr": "le la les des du une un et est que qui dans pour par sur doit être au aux chaque ou ne pas avec sont ce cette il elle nous vous mais",
    "de": "der die das und ist ein eine nicht mit für von den dem des zu im auf werden wird muss oder bei als nach jede jeder sind er sie wir aber auch",
    "es": "el la los las del una un y es que en para por con debe ser cada se no al o su son este esta pero como más",
}
LANGUAGES = tuple(FUNCTION_WORDS)

_WORD = re.compile(r"[^\W\d_]+")
#: A break between blocks, and a line that begins with a list mark, end a sentence.
_BLOCK = re.compile(r"\n[^\S\n]*\n|\r[^\S\r]*\r|[\n\r]+\s*(?=(?:[-•*–—‣◦]|\(?(?:\d{1,3}|[A-Za-z]|[ivx]{1,4})[.)])\s)")
_CLOSERS = "\"'”’»)]}"
_HARD, _SOFT, _TITLE = -1, -2, -3
#: A private-use character, since it must not be white space.
_MARK = "\ue000"


class WordTable:
    """Numbers of words within one task, with the codes that end sentences between them."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.memo = FlatMemo(lambda pieces: [self._codes(p) for p in pieces])

    def _codes(self, piece: str) -> list[int]:
        """The words of a piece between white space; before a word in title case _TITLE, at the end what kind of sentence end."""
        if piece == _MARK:
            return [_HARD]
        words = _WORD.findall(piece)
        codes: list[int] = []
        if words and words[0][0].isupper() and (len(words[0]) == 1 or words[0][1:].islower()):
            codes.append(_TITLE)
        codes.extend(self.number.setdefault(w.lower(), len(self.number)) for w in words)
        tail = piece.rstrip(_CLOSERS)
        if tail[-1:] in ("!", "?", "…") or tail[-1:] == "." and len(tail) > 1:
            before = tail[:-1]
            # After a number ("9.10.3.1.") or a single letter ("O.") a full stop ends the sentence only before a word in title case.
            abbreviation = tail[-1] == "." and (before[-1:].isdigit() or len(before) == 1 or before.lower() in ("reg", "no", "art", "fig", "cl", "sec", "approx"))
            mark = re.fullmatch(r"\W*(?:\d{1,3}|\w)\.", piece) is not None
            if not mark and before.lower() not in ("o", "reg"):
                codes.append(_SOFT if abbreviation else _HARD)
        return codes

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(codes, document of each code) of the texts."""
        codes, bounds = self.memo.numbers([_BLOCK.sub(f" {_MARK} ", t).split() if t else [] for t in texts])
        return codes, np.repeat(np.arange(len(texts)), np.diff(bounds))

    def clear(self) -> None:
        self.number.clear()
        self.memo.clear()


def main_language(table: WordTable, words: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Index into LANGUAGES of each document, -1 where no function word of any language stands."""
    counts = np.zeros((len(LANGUAGES), n), dtype=np.int64)
    for i, lang in enumerate(LANGUAGES):
        flag = np.zeros(len(table.number) + 1, dtype=bool)
        flag[[table.number[w] for w in FUNCTION_WORDS[lang].split() if w in table.number]] = True
        counts[i] = np.bincount(doc[flag[words]], minlength=n)
    return np.where(counts.max(axis=0) > 0, counts.argmax(axis=0), -1)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, held = WordTable(), np.zeros(0, np.int64)
    documents = 0

    def out() -> pa.RecordBatch:
        names = [*table.number, None]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.append(held[: len(names) - 1], documents), pa.int64())], names=["word", "n"])

    for batch in batches:
        for _, texts in slices(batch.column(0)):
            codes, doc = table.read(texts)
            keep = codes >= 0
            words, doc = codes[keep].astype(np.int64), doc[keep]
            size = len(table.number)
            english = (main_language(table, words, doc, len(texts)) == 0) & (np.bincount(doc, minlength=len(texts)) >= LEAST_WORDS)
            documents += int(english.sum())
            inside = english[doc]
            pairs = np.unique(doc[inside] * size + words[inside]) if size else np.zeros(0, np.int64)
            held = np.concatenate([held, np.zeros(max(0, size - len(held)), np.int64)])
            held += np.bincount(pairs % max(size, 1), minlength=len(held))
            if size > HELD_WORDS:
                yield out()
                table.clear()
                held, documents = np.zeros(0, np.int64), 0
    yield out()


def familiar_words(documents: DataFrame, text_col: str = "text", share: float = FAMILIAR_SHARE) -> list[str]:
    """Words that stand in at least `share` of all English documents, in order of letters."""
    counts = cut(documents.select(text_col).mapInArrow(_document_frequencies, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    # The row without a word holds the number of documents.
    total = sum(r["n"] for r in counts.where("word is null").collect())
    return sorted(r["word"] for r in counts.where(F.col("word").isNotNull() & (F.col("n") >= max(1, share * total))).collect())


def sentence_lengths(sentence: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """The average sentence length of each of n documents without its outer sentences; from sentence and document of each word, both ascending."""
    first = np.flatnonzero(np.diff(sentence, prepend=-1))
    length, owner = np.diff(np.append(first, len(sentence))), doc[first]
    order = np.lexsort((length, owner))
    length, count = length[order], np.bincount(owner, minlength=n)
    ends = np.cumsum(count)
    left = np.where(count > 3, count - np.ceil(count * TRIM_LONG).astype(np.int64), count)
    inner = np.arange(len(length)) < (ends - count + left)[owner]
    words = np.cumsum(length * inner)
    before = np.concatenate([[0], words])[ends - count]
    total = np.concatenate([[0], words])[ends] - before
    inner &= words - before[owner] > TRIM_SHORT * total[owner]
    return np.bincount(owner[inner], weights=length[inner], minlength=n) / np.maximum(np.bincount(owner[inner], minlength=n), 1)


def features(documents: DataFrame, familiar: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words, unfamiliar, sentence) of each English document with at least LEAST_WORDS words.

    unfamiliar: share of words outside the familiar list. sentence: the average sentence length in words without the outer
    sentences (TRIM_SHORT, TRIM_LONG), so that headings, fragments and a few other sentences don't move it.
    """
    shared = documents.sparkSession.sparkContext.broadcast(familiar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = WordTable(), shared.value
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                codes, doc = table.read(texts)
                n = len(texts)
                # A soft end holds before a word in title case.
                soft = np.zeros(len(codes), dtype=bool)
                soft[:-1] = (codes[:-1] == _SOFT) & (codes[1:] == _TITLE)
                start = np.zeros(len(codes), dtype=bool)
                start[1:] = doc[1:] != doc[:-1]
                sentence = np.cumsum((codes == _HARD) | soft | start)
                keep = codes >= 0
                words, doc, sentence = codes[keep], doc[keep], sentence[keep]
                counts = np.bincount(doc, minlength=n)
                language = main_language(table, words, doc, n)
                flag = np.ones(len(table.number) + 1, dtype=bool)
                flag[[table.number[w] for w in known if w in table.number]] = False
                unfamiliar = np.bincount(doc, weights=flag[words], minlength=n) / np.maximum(counts, 1)
                typical = sentence_lengths(sentence, doc, n)
                good = np.flatnonzero((language == 0) & (counts >= LEAST_WORDS))
                ids = batch.column(0).slice(first, n).take(pa.array(good, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts[good], pa.int64()), pa.array(unfamiliar[good]), pa.array(typical[good])], names=[id_col, "words", "unfamiliar", "sentence"])
                if len(table.number) > HELD_WORDS:
                    table.clear()

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, f"`{id_col}` {kind}, words bigint, unfamiliar double, sentence double")


def fit_bands(rows: list[tuple[int, float, float]]) -> dict[int, tuple[float, float, float, float]]:
    """Band to (middle and spread of unfamiliar, middle and spread of log sentence length) from (band, unfamiliar, sentence) rows.

    Medians and median deviations, so that a minority of erring raters doesn't move them; the spreads have a floor of a
    twentieth of the range of the middles.
    """
    by: dict[int, list[tuple[float, float]]] = defaultdict(list)
    for band, unfamiliar, sentence in rows:
        by[band].append((unfamiliar, float(np.log(max(sentence, 1.0)))))
    middles = {b: (median(u for u, _ in v), median(s for _, s in v)) for b, v in by.items()}
    floors = [max(0.02, (max(m[k] for m in middles.values()) - min(m[k] for m in middles.values())) / 20) for k in (0, 1)] if middles else []
    found = {}
    for b, v in sorted(by.items()):
        spread = [max(floors[k], 1.4826 * median(abs(x[k] - middles[b][k]) for x in v)) for k in (0, 1)]
        found[b] = (middles[b][0], spread[0], middles[b][1], spread[1])
    return found


def band_column(model: dict[int, tuple[float, float, float, float]]) -> Column:
    """The band nearest in both parts of the formula, as an expression over unfamiliar and sentence; null without a fitted band."""
    if not model:
        return F.lit(None)
    log = F.log(F.greatest("sentence", F.lit(1.0)))
    far = [F.struct((F.pow((F.col("unfamiliar") - F.lit(u)) / su, 2) + F.pow((log - F.lit(s)) / ss, 2) + 2 * float(np.log(su * ss))).alias("d"), F.lit(b).alias("band")) for b, (u, su, s, ss) in model.items()]
    return F.array_min(F.array(*far))["band"]


def reading_levels(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", band_col: str = "band") -> DataFrame:
    """(doc_id, band, words, unfamiliar, sentence): the band of each document whose main language is English.

    Documents of fewer than 60 words (runs of letters) have no row. The main language is told by function words,
    whatever the table says.

    Method: familiar-word formula: the share of words outside a list of words frequent in the corpus's English
    documents (document frequencies over all of them), and the average sentence length; the bands' places in these two
    are fitted on labelled documents (at most MOST_LABELLED, chosen by a hash of the id, each with the median of its
    raters).

    Scale: two passes over the text without any shuffle of it; the first sends word counts, combined a task, the second
    leaves four numbers a document, written once to the shared folder. The driver holds the familiar list (bounded by its share)
    and the labelled rows.

    Defined cases: null, empty and short texts give no rows; without usable labels the band is null and the parts of the formula
    stand beside it; a label row with null band or for an unknown document is ignored, as is a document whose raters' median
    lies between two bands; repeated rows give one row; other columns are ignored.
    """
    found = cut(features(documents, familiar_words(documents, text_col), id_col, text_col).distinct())
    rated = labels.where(F.col(band_col).isNotNull()).groupBy(id_col).agg(F.percentile(band_col, 0.5).alias("m")).where("m = floor(m)")
    sample = found.join(rated, id_col).orderBy(F.xxhash64(id_col)).limit(MOST_LABELLED).select(F.col("m").cast("int"), "unfamiliar", "sentence").collect()
    return found.withColumn("band", band_column(fit_bands([tuple(r) for r in sample])).cast("int")).select(id_col, "band", "words", "unfamiliar", "sentence")
