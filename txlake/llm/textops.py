"""Word, line and shingle arithmetic straight on Arrow string buffers.

Everything here works on one slice of a record batch (a few MiB of text, or one longer text), so memory is
bounded by the slice and never by a table. A word is ``[^\\x20\\x09-\\x0D]+``: those bytes never occur inside a
multi-byte UTF-8 sequence, so words are found on bytes. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 18


def is_space() -> np.ndarray:
    """True for the bytes that separate words."""
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into row ranges of about ``limit`` bytes of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``, a null one is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind, column = np.int32, column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def is_between_terms(digits: bool) -> np.ndarray:
    """True for the ASCII bytes that separate terms: all but letters and, with ``digits``, digits."""
    table = np.zeros(256, bool)
    table[:128] = True
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1] = False
    if digits:
        table[ord("0") : ord("9") + 1] = False
    return table


def word_spans(data: np.ndarray, offs: np.ndarray, separates: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word in bytes, and ``first``: words of text ``i`` are ``first[i]:first[i + 1]``.

    ``separates`` tells for each of the 256 bytes if it separates words; white space by default."""
    inside = ~(is_space() if separates is None else separates)[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    heads = offs[:-1][offs[:-1] < len(data)]
    tails = offs[1:][offs[1:] > 0] - 1
    begin[heads], stop[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offs)


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every ``\\n``-split line of every text; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    return np.sort(np.concatenate([offs[:-1], breaks + 1])), np.sort(np.concatenate([breaks, offs[1:]]))


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each range ``bounds[i]:bounds[i + 1]``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


class SpanHasher:
    """64-bit hashes of byte spans, by differences of running polynomial sums; ``fold`` hashes A-Z as a-z."""

    def __init__(self, fold: bool = False):
        self.table = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
        if fold:
            self.table[65:91] = self.table[97:123]
        self._grow(BLOCK_BYTES)

    def _grow(self, n: int) -> None:
        ones = np.full(n + 1, BASE, U64)
        ones[0] = 1
        self.power = np.cumprod(ones)
        ones[1:] = BASE_INVERSE
        self.inverse = np.cumprod(ones)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), U64)
        i = 0
        while i < len(starts):
            low = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
            n = int(ends[j - 1]) - low
            tall = n > len(self.power) - 1
            if tall:
                self._grow(n)
            total = np.zeros(n + 1, U64)
            np.cumsum(self.table[data[low : low + n]] * self.power[:n], out=total[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = mix((total[e] - total[s]) * self.inverse[s] + (e - s).astype(U64))
            if tall:
                self._grow(BLOCK_BYTES)
            i = j
        return out


def text_of_words(first: np.ndarray) -> np.ndarray:
    """For every word, the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) for the window of ``size`` words that starts at each word; invalid where it would leave its text."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, U64)
    for j in range(size):
        total = total * U64(BASE) + words[j : j + n]
    owner = text_of_words(first)
    return mix(total), owner[:n] == owner[size - 1 :][:n]


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of ``n`` places that a window of ``size`` beginning at one of ``starts`` covers."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0
