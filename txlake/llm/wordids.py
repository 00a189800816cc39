"""Token ids of every word of a slice, encoding each distinct word once.

Words are told apart by 64-bit hashes. The table of known words is a sorted array of hashes with places in a flat
array of ids (about 40 bytes a word), kept per worker process and started anew beyond ``LIMIT`` words.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .textops import SpanHasher

LIMIT = 3_000_000


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[start[i]:start[i] + length[i]]``."""
    ends = np.cumsum(length)
    if not len(ends):
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(start - (ends - length), length)]


class WordIds:
    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        """``encode`` gives (lengths, flat ids) of distinct words."""
        self.encode, self.hasher = encode, SpanHasher()
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of every word, all ids in order)."""
        words, where, inverse = np.unique(self.hasher(data, starts, ends), return_index=True, return_inverse=True)
        at = self._find(words)
        if (at < 0).any():
            if len(self.hashes) + len(words) > LIMIT:
                self._clear()
                at[:] = -1
            new = np.flatnonzero(at < 0)
            self._add(words[new], data, starts[where[new]], ends[where[new]])
            at = self._find(words)
        at = at[inverse]
        return self.length[at], gathered(self.flat, self.start[at], self.length[at])

    def _find(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at, -1)

    def _add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        length, flat = self.encode([raw[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist())])
        start = len(self.flat) + np.cumsum(length) - length
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.start = np.insert(self.start, place, start)
        self.length = np.insert(self.length, place, length)
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
