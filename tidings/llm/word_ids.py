"""Ids of running text from the ids of its distinct words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import ranges

#: Words whose ids a process keeps, in two generations: when the younger one is full, the older one goes.
KEPT_WORDS = 800_000
#: Words learned at a time, as what a tokenizer returns is large.
LEARNED = 4096


class Recent:
    """Results by key: those used since the last turn, and those of the turn before."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def get(self, key):
        """The result, or None."""
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordIds:
    """Look up the ids of words; ``learn`` gives those of words that aren't kept."""

    def __init__(self, learn: Callable[[list[str]], list[list[int]]], kept: int | None = None):
        self.learn, self.kept = learn, KEPT_WORDS if kept is None else kept
        self._turn()
        self._turn()

    def _turn(self) -> None:
        """What was kept becomes the older generation, whose words move over when they are used."""
        self.old = (self.index, self.flat, self._starts()) if hasattr(self, "index") else ({}, None, None)
        self.index, self.flat, self.lengths, self.used = {}, np.zeros(1 << 20, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.lengths[: len(self.index)])))

    def _keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first, total = len(self.index), len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while first + len(words) > len(self.lengths):
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
        self.flat[self.used : self.used + total] = ids
        self.lengths[first : first + len(words)] = lengths
        self.used += total
        self.index.update(zip(words, range(first, first + len(words))))

    def _move(self, words: list[str]) -> None:
        """Words of the older generation into the younger one."""
        index, flat, starts = self.old
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        lengths = starts[at + 1] - starts[at]
        self._keep(words, flat[ranges(starts[at], lengths)], lengths)

    def _learn(self, words: list[str]) -> None:
        found = self.learn(words)
        lengths = np.array([len(x) for x in found], np.int64)
        self._keep(words, np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum())), lengths)

    def __call__(self, words: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and the n + 1 bounds of the texts in them."""
        coded = pc.dictionary_encode(words)
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.index]
        if self.index and len(self.index) + len(new) > self.kept // 2:
            self._turn()
            new = distinct
        if self.old[0]:
            known = [w for w in new if w in self.old[0]]
            if known:
                self._move(known)
                new = [w for w in new if w not in self.index]
        for k in range(0, len(new), LEARNED):
            self._learn(new[k : k + LEARNED])
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        at = at[np.asarray(coded.indices)] if distinct else at
        starts, lengths = self._starts()[at], self.lengths[at]
        return self.flat[ranges(starts, lengths)], np.concatenate(([0], np.cumsum(lengths)))[bounds]
