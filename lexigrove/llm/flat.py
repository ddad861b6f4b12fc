"""Texts to flat number arrays through a memo of their distinct pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

SLICE_CHARS = 4_000_000
MEMO_PIECES = 400_000


class FlatMemo:
    """Piece of text to a list of numbers; each distinct piece is resolved once, the rest is array work.

    resolve gets all new pieces of a slice at once. The memo is emptied when it holds MEMO_PIECES pieces.
    """

    def __init__(self, resolve: Callable[[list[str]], list[Sequence[int]]]):
        self.resolve = resolve
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.int32), 0

    def learn(self, pieces: list[str]) -> None:
        if len(self.number) > MEMO_PIECES:
            self.clear()
        new = list(set(pieces).difference(self.number))
        if not new:
            return
        lists = self.resolve(new)
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        first, size = len(self.number), int(lengths.sum())
        while len(self.starts) < first + len(new):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while len(self.flat) < self.used + size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + size] = np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=size)
        self.starts[first : first + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(new)] = lengths
        self.used += size
        self.number.update(zip(new, range(first, first + len(new)), strict=True))

    def numbers(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(flat numbers of all texts, bounds): text i has flat[bounds[i]:bounds[i + 1]]."""
        pieces = list(chain.from_iterable(texts))
        self.learn(pieces)
        at = np.fromiter(map(self.number.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        return self.flat[places], np.concatenate([np.zeros(1, np.int64), ends])[edges]


def slices(column: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows with about `chars` characters, so memory follows neither rows nor batch size."""
    first, held, size = 0, [], 0
    for i, text in enumerate(column):
        value = text.as_py()
        held.append(value)
        size += len(value) if value else 0
        if size >= chars:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held
