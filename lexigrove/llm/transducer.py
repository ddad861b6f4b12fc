"""A minimal acyclic transducer from words to numbers, laid out in flat arrays that can be memory-mapped."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Maps each word of a fixed lexicon to its rank in byte order, sharing prefixes and suffixes.

    States are numbered from 0 (the start); the arcs are sorted by state * 256 + byte. The output of an arc is the
    number of lexicon words that sort before those reached through it, so the outputs along a word sum to its rank.
    """

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.outputs, self.final = keys, targets, outputs, final

    @classmethod
    def build(cls, words: Iterable[bytes]) -> Transducer:
        """From distinct words in byte order: states of equal right languages are merged as soon as they are complete."""
        register: dict[tuple, int] = {}
        arcs_of: list[tuple] = []
        counts: list[int] = []
        ends: list[bool] = []

        def freeze(end: bool, arcs: list[tuple[int, int]]) -> int:
            signature = (end, *arcs)
            state = register.get(signature)
            if state is None:
                state = register[signature] = len(arcs_of)
                arcs_of.append(tuple(arcs))
                ends.append(end)
                counts.append(end + sum(counts[t] for _, t in arcs))
            return state

        # The open path: for each depth the arcs already complete, whether a word ends there, and the byte that leads on.
        path: list[list] = [[False, []]]
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            while len(path) > shared + 1:
                end, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(end, arcs)))
            path.extend([False, []] for _ in range(len(word) - shared))
            path[-1][0] = True
            last = word
        while len(path) > 1:
            end, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(end, arcs)))
        root = freeze(*path[0])
        number = lambda s: 0 if s == root else s + 1 if s < root else s  # noqa: E731  the start gets number 0
        keys, targets, outputs = [], [], []
        final = np.zeros(len(arcs_of), dtype=np.uint8)
        for s, arcs in enumerate(arcs_of):
            final[number(s)] = ends[s]
            before = int(ends[s])
            for byte, t in arcs:
                keys.append(number(s) * 256 + byte)
                targets.append(number(t))
                outputs.append(before)
                before += counts[t]
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        return cls(np.array(keys, dtype=np.int64)[order], np.array(targets, dtype=np.int32)[order], np.array(outputs, dtype=np.int32)[order], final)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for a word outside the lexicon; all words advance together, a byte a step."""
        n = len(words)
        rank = np.zeros(n, dtype=np.int64)
        if not n or not len(self.keys):
            return np.where([w == b"" for w in words], 0, -1) if n and self.final[:1].any() else np.full(n, -1, dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        state = np.zeros(n, dtype=np.int64)
        alive = np.arange(n)
        at = 0
        while True:
            done = lengths[alive] <= at
            ended = alive[done]
            rank[ended[self.final[state[ended]] == 0]] = -1
            alive = alive[~done]
            if not len(alive):
                return rank
            wanted = state[alive] * 256 + text[starts[alive] + at]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[arc] == wanted
            rank[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            rank[alive] += self.outputs[arc]
            state[alive] = self.targets[arc]
            at += 1
