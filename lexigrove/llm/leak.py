"""Evaluation texts leaking into training text: template windows, slot check, exact passage check."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexigrove.llm.flat import FlatMemo, slices
from lexigrove.operators.blocks import over_blocks

#: Words of a template window, least words of a passage, and how many words of it may hold one change.
WINDOW, LEAST, ONE_IN = 5, 15, 8
#: Least words of a template window that are no placeholder; a window with fewer is joined by its very words.
LITERALS = 2
#: Items whose index one task holds at a time, and their characters; more items are taken in blocks of this size.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
#: Window hits that are checked at a time; more are taken a few documents at a time.
HELD_HITS = 2_000_000

# Units that a template leaves open.
UNITS = ("mm", "cm", "m", "km", "m2", "m3", "kpa", "pa", "mpa", "kn", "n", "kg", "g", "min", "h", "s", "c", "k", "w", "kw", "l", "db", "lx", "percent")

NAME, NUMBER, UNIT = 0, 1, 2
#: Number of the place between two texts; words that no item has get the numbers below it, by place in the task's list and kind.
EDGE = -1

_RAW_WORD = re.compile(r"\w+(?:(?:[-\u2010\u2011\u00ad'\u2019\u02bc]|(?<=\d)[.,](?=\d))\w+)*")
_LINE_HYPHEN = re.compile(r"(?<=\w)[-\u2010\u2011\u00ad]\s*[\r\n]+[\s>|]*(?=\w)")
_INVISIBLE = re.compile("[\\u00ad\\u200b\\u200c\\u200d\\u2060\\ufeff]")


def printed(text: str | None) -> str:
    """text with hyphens at line ends undone and compatibility forms folded."""
    if not text:
        return ""
    if not text.isascii():
        text = _LINE_HYPHEN.sub("", text) if "\n" in text or "\r" in text else text
        text = _INVISIBLE.sub("", text)
        text = text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)
    if "-\n" in text or "-\r" in text or "- " in text:
        text = _LINE_HYPHEN.sub("", text)
    return text


def raw_words(text: str | None) -> list[str]:
    """The words of a text as printed."""
    return _RAW_WORD.findall(printed(text))


def plain_word(word: str) -> str:
    """A word without case, marks inside and accents' forms: the same for every print of it."""
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", word).lower())


class Windows:
    """Sorted keys of windows of the items' words, with the places behind each key."""

    BITS = 20

    def __init__(self, keys: np.ndarray, at: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.at = at[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.counts = np.diff(np.append(self.first, len(order)))
        #: Which leading bits some key has; most keys of a text fail here already.
        self.leading = np.zeros(1 << self.BITS, dtype=bool)
        self.leading[self.keys >> np.uint64(64 - self.BITS)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among keys, slot here) of the keys that are here."""
        if not len(self.keys) or not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.flatnonzero(self.leading[keys >> np.uint64(64 - self.BITS)])
        keys = keys[place]
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[slot] == keys
        return place[same], slot[same]

    def places(self, slot: np.ndarray) -> np.ndarray:
        """The places behind each slot, one after another."""
        n = self.counts[slot]
        return self.at[np.repeat(self.first[slot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class ItemIndex:
    """The template windows of a block of items, and the words behind them for the slot check. Items of the same words are held once."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(i, raw_words(t)) for i, t in items]
        lower = {w for _, ws in texts for w in ws if w == w.lower()}
        self.number: dict[str, int] = {}
        kinds: list[int] = []
        for _, ws in texts:
            for w in ws:
                p = plain_word(w)
                if p and p not in self.number:
                    self.number[p] = len(self.number) + 3
                    kinds.append(NUMBER if p[0].isdigit() else UNIT if p in UNITS else NAME if w not in lower and w.lower() not in lower else self.number[p])
        self.template = np.array([NAME, NUMBER, UNIT, *kinds], dtype=np.int64)
        once: dict[bytes, list] = {}
        words = []
        for i, ws in texts:
            numbers = np.array([self.number[p] for w in ws if (p := plain_word(w))], dtype=np.int32)
            if numbers.tobytes() not in once:
                words.append(numbers)
            once.setdefault(numbers.tobytes(), []).append(i)
        #: The ids of each item held.
        self.ids = list(once.values())
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.words = np.concatenate([*words, np.zeros(0, np.int32)]).astype(np.int32)
        self.owner = np.repeat(np.arange(len(words)), self.lengths)
        templates = self.templates(self.words)
        at = self._starts_of(WINDOW)
        keys, exact = window_keys(templates, self.words, WINDOW)
        self.short, self.exact = Windows(keys[at], at), Windows(exact[at], at)
        at = self._starts_of(LEAST)
        at = at[literals(templates, LEAST)[at] >= LITERALS * (LEAST // WINDOW)]
        self.long = Windows(rolling(templates, LEAST)[at], at)

    def _starts_of(self, size: int) -> np.ndarray:
        return np.concatenate([np.arange(max(0, n - size + 1)) + s for n, s in zip(self.lengths.tolist(), self.starts.tolist(), strict=True)] or [np.zeros(0)]).astype(np.int64)

    def templates(self, words: np.ndarray) -> np.ndarray:
        """The template word of each word: its kind for a number, name or unit, else itself."""
        return np.where(words >= 0, self.template[np.maximum(words, 0)], np.where(words == EDGE, -9, (-words.astype(np.int64) - 2) % 3))

    def memo(self) -> FlatMemo:
        """Printed piece between white space to the numbers of its words; words that no item has get a number below EDGE each."""
        unknown: dict[str, int] = {}

        def of(word: str) -> int:
            p = plain_word(word)
            known = self.number.get(p)
            if known is None:
                kind = NUMBER if p[:1].isdigit() else UNIT if p in UNITS else NAME
                known = unknown.setdefault(p, -(2 + 3 * len(unknown) + kind))
            return known

        def resolve(pieces: list[str]) -> list[list[int]]:
            if not memo.number:  # emptied: no text holds the old numbers any more
                unknown.clear()
            return [[of(w) for w in _RAW_WORD.findall(x) if plain_word(w)] for x in pieces]

        memo = FlatMemo(resolve)
        return memo


_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... of n places, modulo 2 ** 64."""
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of the `size` values from each place on; the last ones run over the end and are not for use.

    Differences of one running sum: the key of values v[i], v[i + 1], ... is the sum of their mixed forms times the base's inverse to the power of
    their distance. Keys only select; what they select is compared word by word.
    """
    n = len(values)
    mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_MIX)
    mixed ^= mixed >> np.uint64(32)
    room = 1 << max(10, (n - 1).bit_length())  # so that few sets of powers are kept
    total = np.zeros(n + size + 1, dtype=np.uint64)
    np.cumsum(mixed * _powers(pow(_BASE, -1, 1 << 64), room)[:n], out=total[1 : n + 1])
    total[n + 1 :] = total[n]
    return (total[size : n + size] - total[:n]) * _powers(_BASE, room)[:n]


def literals(templates: np.ndarray, size: int) -> np.ndarray:
    """The words that are no placeholder in the `size` words from each place on."""
    total = np.concatenate([[0], np.cumsum(templates > UNIT), np.full(size, int((templates > UNIT).sum()))])
    return total[size : size + len(templates)] - total[: len(templates)]


def window_keys(templates: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(template key, key of the very words) of each window; a window of too few literal words has its very words for a template."""
    exact = rolling(words, size)
    return np.where(literals(templates, size) >= LITERALS, rolling(templates, size), exact), exact


def template_hits(index: ItemIndex, words: np.ndarray, templates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, slot of index.exact) of every template window that text and items share and whose slots hold the same values.

    The windows meet by template first; only those whose slots are filled the same way are spread over the items' places, so a page of
    figures or of unknown names, whose template is everywhere, gives nothing to spread.
    """
    keys, exact = window_keys(templates, words, WINDOW)
    place, _ = index.short.find(keys[: max(0, len(words) - WINDOW + 1)])
    inner, slot = index.exact.find(exact[place])
    place = place[inner]
    # All places of a slot hold the same words, so one of them tells whether the slots are filled the same way.
    at = index.exact.at[index.exact.first[slot]]
    run = np.arange(WINDOW)
    same = (words[place[:, None] + run] == index.words[at[:, None] + run]).all(axis=1)
    return place[same], slot[same]


def bound_slots(text: np.ndarray, item: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For rows of template-equal words whether the item's slots are bound to the text's values one to one.

    Each value of a slot in the item must stand for one value in the text wherever it recurs, and different values for different ones.
    """
    good = np.ones(len(text), dtype=bool)
    for a in range(text.shape[1]):
        for b in range(a + 1, text.shape[1]):
            both = slots[:, a] & slots[:, b]
            good &= ~both | ((text[:, a] == text[:, b]) == (item[:, a] == item[:, b]))
    return good


def variants(index: ItemIndex, words: np.ndarray, templates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, item) of every run of LEAST words that is an item's up to numbers, names and units bound one to one."""
    place, slot = index.long.find(rolling(templates, LEAST)[: max(0, len(words) - LEAST + 1)])
    out_place, out_item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for some in np.split(np.arange(len(place)), _cuts(index.long.counts[slot])):
        p, q = np.repeat(place[some], index.long.counts[slot[some]]), index.long.places(slot[some])
        run = np.arange(LEAST)
        t = templates[p[:, None] + run]
        same = (t == index.templates(index.words[q[:, None] + run])).all(axis=1)
        good = same & bound_slots(words[p[:, None] + run], index.words[q[:, None] + run], t <= UNIT)
        out_place.append(p[good])
        out_item.append(index.owner[q[good]])
    return np.concatenate(out_place), np.concatenate(out_item)


def _cuts(sizes: np.ndarray, most: int = HELD_HITS // 10) -> np.ndarray:
    """Where to cut a row of sizes so that the parts sum to about `most`."""
    group = np.cumsum(sizes) // most
    return np.flatnonzero(np.diff(group)) + 1


def _runs(p: np.ndarray, q: np.ndarray, doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs of window hits along one diagonal: (doc, item, p, q, length in words)."""
    diagonal = p - q
    order = np.lexsort((p, diagonal, item, doc))
    p, q, doc, item, diagonal = (x[order] for x in (p, q, doc, item, diagonal))
    new = np.ones(len(p), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    return doc[first], item[first], p[first], q[first], np.diff(np.append(first, len(p))) + WINDOW - 1


def passages(words: np.ndarray, index: ItemIndex, item: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For seeds (place p in words, place q in the items' words) whether a passage runs through the seed's neighbourhood.

    A passage has n >= LEAST words of the item, begins and ends with words that agree, and at most n / ONE_IN of its
    words are changed, left out or added. With more than four changes one of the halves beside a middle change is a
    passage too, so four changes, a band of four diagonals on either side and 5 * ONE_IN words to each side suffice.
    All seeds advance together: best[seed, diagonal, changes] is the greatest n of a path that ends there.
    """
    most, reach = 4, 5 * ONE_IN
    band = 2 * most + 1
    ends = index.starts[item] + index.lengths[item]
    best = np.full((len(p), band, most + 1), -999, dtype=np.int16)
    enough = np.maximum(LEAST, ONE_IN * np.arange(most + 1)).astype(np.int16)
    found = np.zeros(len(p), dtype=bool)
    shifts = np.arange(band) - most
    for step in range(-reach, reach + WINDOW):
        row = q + step
        inside = (row >= index.starts[item]) & (row < ends)
        wanted = np.where(inside, index.words[np.clip(row, 0, len(index.words) - 1)], EDGE - 1)
        place = (p + step)[:, None] + shifts[None, :]
        same = words[np.clip(place, 0, len(words) - 1)] == wanted[:, None]
        same &= (place >= 0) & (place < len(words))
        before = best
        best = np.full_like(before, -999)
        best[:, :, 1:] = before[:, :, :-1] + 1
        best[:, :-1, 1:] = np.maximum(best[:, :-1, 1:], before[:, 1:, :-1] + 1)
        matched = np.maximum(before + 1, np.where(np.arange(most + 1) == 0, 1, -999).astype(np.int16))
        best = np.where(same[:, :, None], np.maximum(best, matched), best)
        found |= ((matched >= enough) & same[:, :, None]).any(axis=(1, 2))
        for d in range(1, band):
            best[:, d, 1:] = np.maximum(best[:, d, 1:], best[:, d - 1, :-1])
        best[~inside] = -999
        np.maximum(best, -999, out=best)
    return found


def _passages_of(index: ItemIndex, words: np.ndarray, p: np.ndarray, q: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Number of the text times the number of items, plus the item, of each passage that the equal windows (p, q) lead to."""
    item = index.owner[q]
    d, i, rp, rq, n = _runs(p, q, doc, item)
    key = d * len(index.ids) + i
    sure = np.unique(key[n >= LEAST])
    # A passage holds a run of 5 words, and its runs of that length have 6 words together at least.
    pairs, at = np.unique(key, return_inverse=True)
    open_ = (np.bincount(at, weights=n)[at] > WINDOW) & ~np.isin(key, sure)
    hit = passages(words, index, i[open_], rp[open_], rq[open_]) if open_.any() else np.zeros(0, bool)
    return np.concatenate([sure, key[open_][hit]])


def find_leaks(index: ItemIndex, memo: FlatMemo, texts: list[str | None]) -> list[tuple[int, object, str]]:
    """(number of the text, id of the item, how) of each leak; see `leaks`."""
    numbers, bounds = memo.numbers([printed(t).split() for t in texts])
    counts = np.diff(bounds)
    starts = bounds[:-1] + WINDOW * np.arange(len(texts))
    words = np.full(len(numbers) + WINDOW * len(texts), EDGE, dtype=np.int32)
    words[np.arange(len(numbers)) + WINDOW * np.repeat(np.arange(len(texts)), counts)] = numbers
    templates = index.templates(words)
    place, slot = template_hits(index, words, templates)
    doc = np.searchsorted(starts, place, "right") - 1
    found = [np.zeros(0, np.int64)]
    # Hits are spread over the items' places a few documents at a time.
    per_doc = np.bincount(doc, weights=index.exact.counts[slot], minlength=len(texts))
    edges = np.searchsorted(doc, np.concatenate([[0], _cuts(per_doc, HELD_HITS), [len(texts)]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            n = index.exact.counts[slot[a:b]]
            found.append(_passages_of(index, words, np.repeat(place[a:b], n), index.exact.places(slot[a:b]), np.repeat(doc[a:b], n)))
    sure = np.unique(np.concatenate(found))
    p, item = variants(index, words, templates)
    other = np.setdiff1d((np.searchsorted(starts, p, "right") - 1) * len(index.ids) + item, sure)
    out = {(k // len(index.ids), i, how) for keys, how in ((sure, "passage"), (other, "variant")) for k in keys.tolist() for i in index.ids[k % len(index.ids)]}
    return sorted(out, key=lambda x: (x[0], str(x[1]), x[2]))


def item_blocks(items: DataFrame, id_col: str, text_col: str, rows: int = BLOCK_ITEMS, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded rows and characters, a partition at a time on the driver."""
    block, size = [], 0
    for r in items.select(id_col, text_col).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).distinct().toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if len(block) >= rows or size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, how): documents that hold a passage of an item.

    how 'passage': at least 15 running words of the item, the first and last the same, with at most one word in eight
    changed, left out or added. how 'variant': no passage, but at least 15 running words that are the item's up to numbers,
    names and units, each value of which stands for one other value of its kind wherever it recurs: a re-parameterised item.

    Method: words are canonicalised into templates with typed placeholders for numbers, names and units (a name is a
    word that the items never print in lower case, and in a document any word that no item has); windows of five
    template words are joined by hash with those of the items (a window of fewer than two literal words by its very words); the slots behind
    the placeholders are then checked: windows whose slots hold the same values seed an exact banded check of the passage, windows of 15 template words
    whose slots are bound one to one make a variant.

    Scale: the items are the query set: they are taken in blocks of bounded rows and characters, each block's index is
    broadcast and all documents are streamed past it, without any shuffle of text. With several blocks one index is alive at a time, and each block's result is
    written to the shared folder. Items of the same words are held once. Memory follows slices of some million characters
    and bounded numbers of window hits, except that one text is held whole.

    Defined cases: case, punctuation, spacing, line breaks, quoting marks, hyphens (also at line ends), invisible
    characters and compatibility forms don't matter; null or empty texts and items of fewer than 15 words give no rows;
    items with the same text count under each id; repeated rows count once; empty tables give no rows; other columns
    are ignored, also where both tables have the name.
    """
    spark: SparkSession = documents.sparkSession
    kinds = documents.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item_col].dataType)
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, how string"

    def against(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            memo = index.memo()
            for batch in batches:
                for first, texts in slices(batch.column(1)):
                    rows = find_leaks(index, memo, texts)
                    ids = batch.column(0).slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array([a for a, _, _ in rows], pa.int64())), pa.array([b for _, b, _ in rows], item_type), pa.array([h for _, _, h in rows], pa.string())], names=[id_col, item_col, "how"])

        return documents.select(id_col, text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, schema)

    return over_blocks(spark, map(ItemIndex, item_blocks(items, item_col, item_text, block_items)), against, schema, "leaks").distinct()
