"""Best-two-fit packing of tokenized documents into sequences.

Documents longer than a sequence are cut into pieces; full pieces are sequences of their own. The others are packed
by length alone: all that the plan needs is how many pieces have each length, a table bounded by the sequence
length, whatever the number of documents. A sequence is filled greedily with the longest piece left that fits;
then its smallest piece is given back if two pieces left fill the widened gap more tightly. Each sequence found
that way is repeated while the lengths last, so the plan is a short list of patterns with multiplicities. Pieces are
then numbered inside their length (by buckets, without a task that holds a whole length) and each number is looked
up in the plan, which goes to the tasks by broadcast: its size is bounded by the sequence length.

Defined cases: a null or empty text is the single end id; ties between pieces of one length are settled by doc_id and
piece; repeated rows (the same doc_id twice) are packed as they come; a null doc_id is packed like any other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, process_cache, stored, width
from .textops import per_text, slices, text_buffer, word_spans
from .wordids import WordIds

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Letters that neither change under NFC nor lower-case to another length, and ASCII marks that never join letters.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordTokenizer:
    """Ids of single words, as the given tokenizer has them; no token of it reaches across white space."""

    def __init__(self, file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, flat ids) of every word. Letters and the marks behind them are separate tokens by the tokenizer's
        own rules, so a word of that form is put together from its two parts, each encoded once."""
        parts = [PLAIN_WORD.fullmatch(w) for w in words]
        halves = [(m[1].lower(), m[2]) if m else (w, "") for m, w in zip(parts, words)]
        plain = list({half[0] for m, half in zip(parts, halves) if m})
        ids = dict(zip(plain, self._plain(plain)))
        other = list({half[1] for half in halves} | {w for m, w in zip(parts, words) if not m})
        ids.update(zip(other, (np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(other, add_special_tokens=False))))
        ids[""] = np.zeros(0, np.uint32)
        found = [x for a, b in halves for x in (ids[a], ids[b])]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths[::2] + lengths[1::2], np.concatenate([*found, np.zeros(0, np.uint32)])

    def _plain(self, words: list[str]) -> list[np.ndarray]:
        """Words of letters only: encoded many at a time, each up to its token that ends a word."""
        out = []
        lines = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
        for line in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
            ids = np.array(line.ids, np.uint32)
            out += np.split(ids, np.flatnonzero(self.ends_word[ids])[:-1] + 1)
        return out


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: a document's ids followed by ``end_id``, cut every ``capacity`` ids; no shuffle."""
    with open(tokenizer_path, encoding="utf-8") as f:
        file = f.read()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"word_ids_{hashlib.sha256(file.encode()).hexdigest()}"
        words = process_cache(name, lambda: WordIds(WordTokenizer(file)))
        for part in slices(batches):
            data, offs = text_buffer(part.column("text"))
            starts, ends, first = word_spans(data, offs)
            counts, flat = words(data, starts, ends)
            n = per_text(counts, first)
            total = n + 1
            ids = np.full(total.sum(), end_id, "<u4")
            inner = np.ones(len(ids), bool)
            inner[np.cumsum(total) - 1] = False
            ids[inner] = flat
            pieces = -(-total // capacity)
            owner = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, total[owner] - start)
            begin = 4 * ((np.cumsum(total) - total)[owner] + start)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def two_that_fit(left: np.ndarray, gap: int, more_than: int) -> tuple[int, int] | None:
    """The two lengths left whose sum is the largest up to ``gap`` and above ``more_than``; the most unequal on ties."""
    lengths = np.flatnonzero(left[: gap + 1])
    if not len(lengths):
        return None
    partner = np.searchsorted(lengths, gap - lengths, "right") - 1
    second = np.where(partner >= 0, lengths[np.maximum(partner, 0)], 0)
    alone = (second == lengths) & (left[lengths] < 2)
    below = np.maximum(partner - 1, 0)
    second = np.where(alone, np.where(partner >= 1, lengths[below], 0), second)
    total = np.where(second > 0, lengths + second, 0)
    best = int(np.argmax(total))
    return (int(second[best]), int(lengths[best])) if total[best] > more_than else None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, how many such sequences)] for ``counts[length]`` pieces of every length."""
    left = counts.copy()
    patterns = []
    longest = len(left) - 1
    while True:
        while longest > 0 and not left[longest]:
            longest -= 1
        if longest <= 0:
            return patterns
        items, gap = [], capacity
        while gap > 0:
            fitting = np.flatnonzero(left[1 : gap + 1])
            if not len(fitting):
                break
            items.append(int(fitting[-1]) + 1)
            left[items[-1]] -= 1
            gap -= items[-1]
        if gap and len(items) > 1:
            smallest = items[-1]
            pair = two_that_fit(left, gap + smallest, smallest)
            if pair:
                left[items.pop()] += 1
                items += pair
                left[pair[0]] -= 1
                left[pair[1]] -= 1
        used = np.bincount(items, minlength=len(left))
        left += used
        distinct = np.flatnonzero(used)
        times = int((left[distinct] // used[distinct]).min())
        left -= used * times
        patterns.append((sorted(items, reverse=True), times))


def plan_tables(patterns: list[tuple[list[int], int]], n_lengths: int) -> dict[str, np.ndarray]:
    """The plan by length: blocks of piece numbers, each with the sequences and offsets that they get."""
    rows = []  # length, slots of it in the pattern, times, first sequence, offset of its first slot
    sequence = 0
    for items, times in patterns:
        offset = 0
        for length in dict.fromkeys(items):
            slots = items.count(length)
            rows.append((length, slots, times, sequence, offset))
            offset += slots * length
        sequence += times
    rows.sort(key=lambda r: r[0])
    length, slots, times, first, offset = np.array(rows, np.int64).reshape(-1, 5).T
    size = slots * times
    total = np.cumsum(size) - size
    head = np.searchsorted(length, np.arange(n_lengths + 1))
    base = np.concatenate([total, [size.sum()]])[head]
    return {"head": head, "base": base, "begin": total, "slots": slots, "first": first, "offset": offset}


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset in it. Reads ``pieces`` three times."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    full = int(counts[capacity])
    by_length = counts.copy()
    by_length[capacity] = 0
    tables = plan_tables(plan(by_length, capacity), capacity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("__number").to_numpy()
            partial = length < capacity
            place = tables["base"][length] + number
            at = np.maximum(np.searchsorted(tables["begin"], place, "right") - 1, 0)
            if len(tables["begin"]):
                within, slots = place - tables["begin"][at], tables["slots"][at]
                sequence = np.where(partial, full + tables["first"][at] + within // slots, number)
                offset = np.where(partial, tables["offset"][at] + (within % slots) * length, 0)
            else:
                sequence, offset = number, np.zeros_like(number)
            columns = [batch.column(c) for c in batch.schema.names if c != "__number"]
            names = [c for c in batch.schema.names if c != "__number"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    ranked = numbered(pieces, "length", ["doc_id", "piece", "ids_crc32"], "__number", width(pieces))
    return ranked.mapInArrow(run, f"{PIECES}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    return pack(stored(tokenized(docs, tokenizer_path, capacity, end_id)), capacity)
