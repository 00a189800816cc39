"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut before every run of spaces, where no piece of the model reaches across; the distinct words of a slice
that are not yet known are encoded together. Their symbols lie in one flat numpy array. A round finds the minimum
pair rank of every word (segmented minimum), merges the leftmost occurrences in all words at once, compacts the
array, looks the changed pairs up again and puts words without any pair aside, until no word is left. All
non-overlapping occurrences of a rank are merged in one round when the merged piece takes part in no pair of that
rank or a better one; otherwise only the leftmost is, so the result is that of merging one pair at a time.

Defined cases: a null or empty text has no pieces beyond the begin and end ids; characters outside the model become
their UTF-8 bytes; repeated rows give repeated results; an empty table gives an empty result; other columns are
ignored. Memory follows one slice of text (or the longest text), and the table of known words is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import process_cache
from .textops import slices, text_buffer
from .wordids import WordIds, gathered

SPACE = "▁"
NO_RANK = np.iinfo(np.int32).max


class PieceBpe:
    """A SentencePiece BPE model with byte fallback and an identity normalizer, as numpy tables."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = n = sp.vocab_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        ids = {name: i for i, name in enumerate(names) if plain[i]}
        if any(SPACE in name.lstrip(SPACE) for name in ids):
            raise ValueError("a piece of this model reaches across the start of a word")

        scores = np.array([sp.get_score(i) for i in range(n)])
        rank_of = np.unique(-scores, return_inverse=True)[1]
        keys, ranks, merged = [], [], []
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    keys.append(left * n + right)
                    ranks.append(rank_of[i])
                    merged.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.merged = np.array(merged, np.int32)[order]
        best = np.full(n, NO_RANK, np.int32)
        np.minimum.at(best, self.keys // n, self.ranks)
        np.minimum.at(best, self.keys % n, self.ranks)
        self.alone = best[self.merged] <= self.ranks

        self.symbol = np.arange(n, n + 0x110000, dtype=np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        self.symbol[ord(" ")] = self.symbol[ord(SPACE)]
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)

        raw = [name.replace(SPACE, " ").encode() if plain[i] else b"" for i, name in enumerate(names)]
        for b, i in enumerate(self.byte_id):
            raw[i] = bytes([b])
        raw[sp.unk_id()] = " ⁇ ".encode()
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_length = np.array([len(x) for x in raw], np.int64)
        self.piece_start = np.concatenate([[0], np.cumsum(self.piece_length)[:-1]])
        self.spaced = np.array([x.startswith(b" ") for x in raw])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the pair tables) of every pair of neighbours; NO_RANK where no piece joins them."""
        key = left.astype(np.int64) * self.size + right
        key[(left >= self.size) | (right >= self.size)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK).astype(np.int32), at.astype(np.int32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of every word, all ids in order); a word begins with its spaces."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []

        def ranked(i):
            return self._pairs(symbols[i], symbols[i + 1])

        rank = np.full(len(symbols), NO_RANK, np.int32)
        at = np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], at[inner] = ranked(inner)
        while len(symbols):  # one round
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[heads, len(word)])
            least = np.minimum.reduceat(rank, heads)
            finished = np.repeat(least == NO_RANK, counts)
            if finished.any():
                done_symbols.append(symbols[finished])
                done_words.append(word[finished])
                go = ~finished
                symbols, word, rank, at = symbols[go], word[go], rank[go], at[go]
                counts, least = counts[least != NO_RANK], least[least != NO_RANK]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, counts))
            leftmost = np.r_[True, word[hits[1:]] != word[hits[:-1]]]
            # Of neighbouring hits, those at an even distance from the first of their run do not overlap.
            begins = np.r_[True, hits[1:] != hits[:-1] + 1]
            run = np.maximum.accumulate(np.where(begins, np.arange(len(hits)), 0))
            apart = (np.arange(len(hits)) - run) % 2 == 0
            careful = np.zeros(len(least), bool)
            index = np.cumsum(leftmost) - 1
            np.logical_or.at(careful, index, self.alone[at[hits]])
            hits = hits[leftmost | (apart & ~careful[index])]

            symbols[hits] = self.merged[at[hits]]
            stay = np.ones(len(symbols), bool)
            stay[hits + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[hits] = True
            before = np.maximum(hits - 1, 0)
            before = np.where(stay[before], before, np.maximum(before - 1, 0))
            changed[before] = True
            symbols, word, rank, at, changed = symbols[stay], word[stay], rank[stay], at[stay], changed[stay]
            again = np.flatnonzero(changed)
            rank[again] = NO_RANK
            again = again[again < len(symbols) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again], at[again] = ranked(again)

        symbols, word = np.concatenate([*done_symbols, np.zeros(0, np.int32)]), np.concatenate([*done_words, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        symbols, word = self._bytes_for_unknown(symbols[order], word[order])
        return np.bincount(word, minlength=len(words)), symbols

    def _bytes_for_unknown(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unknown = np.flatnonzero(symbols >= self.size)
        if not len(unknown):
            return symbols, word
        point = symbols[unknown] - self.size
        n_bytes = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
        repeats = np.ones(len(symbols), np.int64)
        repeats[unknown] = n_bytes
        raw = np.frombuffer(point.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        new = np.repeat(symbols, repeats)
        new[np.repeat(symbols >= self.size, repeats)] = self.byte_id[raw]
        return new, np.repeat(word, repeats)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes, offsets): the UTF-8 text of each ``ids[bounds[i]:bounds[i + 1]]``.

        Control ids are silent and the first space of a text's first sounding piece is dropped.
        """
        length = self.piece_length[ids]
        start = self.piece_start[ids]
        sounding = np.flatnonzero(length)
        at = np.searchsorted(sounding, bounds)
        first = sounding[at[:-1][at[:-1] < at[1:]]]
        first = first[self.spaced[ids[first]]]
        length[first] -= 1
        start[first] += 1
        offsets = np.concatenate([[0], np.cumsum(length)])[bounds]
        return gathered(self.piece_bytes, start, length).tobytes(), offsets


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and ``first``: words of text ``i`` are ``first[i]:first[i + 1]``.

    A word is its spaces less one, and what follows up to the next run of spaces; the space put before every text
    is implied. An empty text has no words.
    """
    space = data == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    heads = offs[:-1][offs[1:] > offs[:-1]]
    cut[heads] = False
    cuts = np.flatnonzero(cut)
    starts = np.sort(np.concatenate([heads, cuts + 1]), kind="stable")
    ends = np.sort(np.concatenate([cuts, offs[1:][offs[1:] > offs[:-1]]]), kind="stable")
    words = np.bincount(np.searchsorted(offs, cuts, "right") - 1, minlength=len(offs) - 1) + (offs[1:] > offs[:-1])
    return starts, ends, np.concatenate([[0], np.cumsum(words)])


class Codec:
    """A model with the words that this worker process has met; the tables are built once per process."""

    def __init__(self, model: bytes):
        name = f"piece_bpe_{hashlib.sha256(model).hexdigest()}"
        self.bpe = process_cache(name, lambda: PieceBpe(model))
        self.words = process_cache(f"{name}_words", lambda: WordIds(lambda words: self.bpe.encode_words([" " + w for w in words])))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text ``i``, with begin and end ids, are ``ids[bounds[i]:bounds[i + 1]]``."""
        texts = pc.replace_substring(texts.fill_null(""), SPACE, " ")
        data, offs = text_buffer(texts)
        starts, ends, first = word_spans(data, offs)
        counts, flat = self.words(data, starts, ends)
        inner = np.concatenate([[0], np.cumsum(counts)])[first]
        texts_before = np.arange(len(inner))
        bounds = inner + 2 * texts_before
        ids = np.empty(bounds[-1], np.uint32)
        framed = np.ones(len(ids), bool)
        framed[bounds[:-1]] = framed[bounds[1:] - 1] = False
        ids[framed] = flat
        ids[bounds[:-1]], ids[bounds[1:] - 1] = self.bpe.bos, self.bpe.eos
        return ids, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        return self.bpe.decode(ids, bounds)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids array<int>: the ids of every whole text, with begin and end ids."""
    model = read_model(model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for part in slices(batches):
            ids, bounds = codec.encode(part.column("text"))
            lists = pa.ListArray.from_arrays(bounds.astype(np.int32), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of every row's ids; null or empty ids give an empty text."""
    model = read_model(model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            rows = [np.array(ids or [], np.int64) for ids in batch.column("ids").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)])
            raw, offsets = codec.decode(np.concatenate([*rows, np.zeros(0, np.int64)]), bounds)
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes every text in one pass, without a shuffle."""
    model = read_model(model_path)

    def digests(raw: bytes, bounds: np.ndarray) -> pa.Array:
        view = memoryview(raw)
        return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds.tolist(), bounds[1:].tolist())], pa.string())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for part in slices(batches):
            ids, bounds = codec.encode(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds)), digests(ids.astype("<u4").tobytes(), 4 * bounds), digests(*codec.decode(ids, bounds))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
