"""Removal of passages that an earlier document has, by repeated-phrase automata.

A window is ``SIZE`` consecutive words of a document; a word goes if a window that covers it also starts in a document
with a smaller doc_id. The texts are dealt once, by a hash of doc_id, into shards of about ``SHARD_BYTES`` (their number comes
from the bytes of all texts, not from the session); all steps read them there.

1. Anchors: the least hash among the ``GRAM``-word grams of a window is the same for equal windows, and neighbouring
   windows mostly share it. Each shard names its distinct anchors with the smallest and largest doc_id that has them;
   buckets of anchors answer which ones recur in another document.
2. Confirmation: each shard names its distinct windows at recurring anchors the same way, and learns which of them
   start in an earlier document, and in which.
3. Location: each shard joins neighbouring confirmed windows to passages, compiles them into Aho-Corasick automata of
   bounded size, one after the other, and streams all its documents through each; every occurrence marks the windows
   whose first document is smaller.

A shard sends one entry for each distinct anchor or window, so what meets in a bucket is bounded by the number of shards for
any one passage, however many documents hold it. Entries travel as packed arrays, one row for each shard and bucket. Windows are told apart by 64-bit hashes.

Defined cases: a null, empty or wordless text has no words and loses none; a null doc_id counts as larger than any
other, and rows that repeat a doc_id do not remove from each other; an empty table gives an empty result; extra
columns are ignored by ``digests`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget_process_cache, give_back, named
from .textops import SpanHasher, slices, text_buffer, text_of_words, window_hashes, word_spans

SIZE, GRAM = 13, 5
NO_ID = np.iinfo(np.int64).max
#: Text of the passages of an automaton, which takes some eighty times that; one is in memory at a time.
AUTOMATON_BYTES = 1 << 18
#: Text whose words and windows a task has in memory at a time.
SLICE_BYTES = 1 << 20
#: Text of a shard, and text whose anchors or windows share a bucket.
SHARD_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
U64 = np.uint64
ENTRIES = "bucket int, shard int, keys binary, low binary, span binary"
ANSWERS = "shard int, keys binary, low binary"


def planes(values: np.ndarray) -> bytes:
    """64-bit integers byte plane by byte plane, which shuffle compression likes better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def ids_of(part: pa.RecordBatch) -> np.ndarray:
    return part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)


def windows_of(part: pa.RecordBatch, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, anchor, first word, text) of every window of a slice."""
    data, offs = text_buffer(part.column("text"))
    starts, ends, first = word_spans(data, offs)
    words = hasher(data, starts, ends)
    windows, valid = window_hashes(words, first, SIZE)
    grams, _ = window_hashes(words, first, GRAM)
    anchor = grams[: len(windows)].copy()
    for shift in range(1, SIZE - GRAM + 1):
        np.minimum(anchor, grams[shift : shift + len(windows)], out=anchor)
    at = np.flatnonzero(valid)
    return windows[at], anchor[at], at, text_of_words(first)[at]


def summed_up(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with the least ``low`` and the greatest ``high`` of each."""
    order = np.argsort(keys)
    keys, low, high = keys[order], low[order], high[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return (keys[heads], np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)) if len(heads) else (keys, low, high)


def entries(shard: int, found: list, n_buckets: int) -> pa.Table:
    """What a shard sends: its distinct keys by bucket."""
    parts = [np.concatenate([f[i] for f in found]) for i in range(3)] if found else [np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    keys, low, high = summed_up(*parts)
    bucket = ((keys >> U64(32)) * U64(n_buckets)) >> U64(32)
    bounds = np.searchsorted(bucket, np.arange(n_buckets + 1).astype(U64)).tolist()
    full = [(b, x, y) for b, (x, y) in enumerate(zip(bounds, bounds[1:])) if y > x]
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in full], pa.int32()),
            "shard": pa.array([shard] * len(full), pa.int32()),
            "keys": pa.array([keys[x:y].tobytes() for _, x, y in full], pa.binary()),
            "low": pa.array([planes(low[x:y]) for _, x, y in full], pa.binary()),
            "span": pa.array([planes(high[x:y] - low[x:y]) for _, x, y in full], pa.binary()),
        }
    )


def answered(sent: DataFrame, later_only: bool) -> DataFrame:
    """shard, keys, low: to each shard those of its keys that recur, with the smallest doc_id of all; under
    ``later_only`` those that it has in a larger doc_id than that."""

    def run(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, U64) for x in group.column("keys").to_pylist()]
        low = [unplanes(x) for x in group.column("low").to_pylist()]
        high = [a + unplanes(x) for a, x in zip(low, group.column("span").to_pylist())]
        all_keys, least, most = summed_up(np.concatenate(keys), np.concatenate(low), np.concatenate(high))
        give_back()
        shard, out_keys, out_low = [], [], []
        for s, k, h in zip(group.column("shard").to_pylist(), keys, high):
            at = np.searchsorted(all_keys, k)
            wanted = h > least[at] if later_only else most[at] > least[at]
            if wanted.any():
                shard.append(s)
                out_keys.append(k[wanted].tobytes())
                out_low.append(planes(least[at[wanted]]) if later_only else b"")
        return pa.table({"shard": pa.array(shard, pa.int32()), "keys": pa.array(out_keys, pa.binary()), "low": pa.array(out_low, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, ANSWERS)


def joined(words: list[bytes]) -> tuple[str, np.ndarray]:
    """The words between single spaces, one character a byte, and the places of the spaces."""
    flat = b" " + b" ".join(words) + b" "
    return flat.decode("latin-1"), np.flatnonzero(np.frombuffer(flat, np.uint8) == 32).astype(np.int32)


def automata(passages: dict[str, np.ndarray]) -> Iterator:
    """Aho-Corasick automata over the passages of a shard, each of bounded size and built when it is asked for."""
    import ahocorasick

    automaton, size = ahocorasick.Automaton(), 0
    for text, least in passages.items():
        automaton.add_word(text, least)
        size += len(text)
        if size >= AUTOMATON_BYTES:
            automaton.make_automaton()
            yield automaton
            automaton, size = ahocorasick.Automaton(), 0
    if size:
        automaton.make_automaton()
        yield automaton


def mark(automaton, text: str, spaces: np.ndarray, doc_id: int, edge: np.ndarray) -> None:
    """Adds the located windows with a smaller first document to ``edge``: 1 at the first word, -1 behind the last."""
    for end, least in automaton.iter(text):
        begin = int(np.searchsorted(spaces, end)) - (len(least) + SIZE - 1)
        if least[-1] < doc_id and (least < doc_id).all():
            edge[begin] += 1
            edge[begin + len(least) + SIZE - 1] -= 1
        else:
            at = begin + np.flatnonzero(least < doc_id)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + SIZE, -1)


def passages_of(text: pa.Table, keys: np.ndarray, least: np.ndarray, hasher: SpanHasher) -> dict[str, np.ndarray]:
    """The passages of a shard: runs of neighbouring confirmed windows, with the first document of each window."""
    found: dict[str, np.ndarray] = {}
    if not len(keys):
        return found
    for part in slices(text.to_batches(), limit=SLICE_BYTES):
        windows, _, word, owner = windows_of(part, hasher)
        at = np.minimum(np.searchsorted(keys, windows), len(keys) - 1)
        hit = np.flatnonzero((keys[at] == windows) & (least[at] < ids_of(part)[owner]))
        if not len(hit):
            continue
        data, offs = text_buffer(part.column("text"))
        starts, ends, _ = word_spans(data, offs)
        cut = np.flatnonzero((np.diff(word[hit]) != 1) | (np.diff(owner[hit]) != 0)) + 1
        raw = data.tobytes()
        for run in np.split(hit, cut):
            a, b = starts[word[run[0]]], ends[word[run[-1]] + SIZE - 1]
            passage = (b" " + b" ".join(raw[a:b].split()) + b" ").decode("latin-1")
            found.setdefault(passage, least[at[run]])
    return found


def located(text: pa.Table, confirmed: pa.Table) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, list[bytes], np.ndarray]]]]:
    """For every slice of a shard: each row's text, words and which of them go."""
    hasher = SpanHasher()
    keys = np.concatenate([np.frombuffer(x, U64) for x in confirmed.column("keys").to_pylist()] + [np.zeros(0, U64)])
    least = np.concatenate([unplanes(x) for x in confirmed.column("low").to_pylist()] + [np.zeros(0, np.int64)])
    order = np.argsort(keys)
    passages = passages_of(text, keys[order], least[order], hasher)
    parts = list(slices(text.to_batches(), limit=SLICE_BYTES))  # views of the shard
    edges: list[list[np.ndarray | None]] = [[None] * part.num_rows for part in parts]
    if passages:
        texts = []
        for part, here in zip(parts, edges):
            data, offs = text_buffer(part.column("text"))
            raw = data.tobytes()
            for i, (a, b, doc_id) in enumerate(zip(offs.tolist(), offs[1:].tolist(), ids_of(part).tolist())):
                words = raw[a:b].split()
                if len(words) >= SIZE:
                    here[i] = np.zeros(len(words) + 1, np.int32)
                    texts.append((*joined(words), doc_id, here[i]))
        for automaton in automata(passages):
            for flat, spaces, doc_id, edge in texts:
                mark(automaton, flat, spaces, doc_id, edge)
        automaton = texts = passages = None
    for part, here in zip(parts, edges):
        data, offs = text_buffer(part.column("text"))
        raw, rows = data.tobytes(), []
        for a, b, edge in zip(offs.tolist(), offs[1:].tolist(), here):
            words = raw[a:b].split()
            rows.append((raw[a:b], words, np.zeros(len(words), bool) if edge is None else np.cumsum(edge[:-1]) > 0))
        yield part, rows


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0


def dealt(docs: DataFrame, n_bytes: int) -> DataFrame:
    """The documents, whose texts have ``n_bytes``, with their shard."""
    n_shards = 1 + n_bytes // SHARD_BYTES
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)).cast("int")
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")).withColumn("shard", shard)


def confirmed_windows(texts: DataFrame, n_bytes: int) -> DataFrame:
    """shard, keys, low: the windows of a shard that also start in an earlier document."""
    n_buckets = 1 + n_bytes // BUCKET_BYTES

    def send_anchors(group: pa.Table) -> pa.Table:
        forget_process_cache()
        hasher, found = SpanHasher(), []
        for part in slices(group.to_batches(), limit=SLICE_BYTES):
            _, anchor, _, owner = windows_of(part, hasher)
            ids = ids_of(part)[owner]
            found.append(summed_up(anchor, ids, ids))
        give_back()
        return entries(group.column("shard")[0].as_py(), found, n_buckets)

    def send_windows(group: pa.Table, recurring: pa.Table) -> pa.Table:
        hasher, found = SpanHasher(), []
        known = np.sort(np.concatenate([np.frombuffer(x, U64) for x in recurring.column("keys").to_pylist()] + [np.zeros(0, U64)]))
        if len(known):
            for part in slices(group.to_batches(), limit=SLICE_BYTES):
                windows, anchor, _, owner = windows_of(part, hasher)
                hit = known[np.minimum(np.searchsorted(known, anchor), len(known) - 1)] == anchor
                ids = ids_of(part)[owner[hit]]
                found.append(summed_up(windows[hit], ids, ids))
        give_back()
        return entries(group.column("shard")[0].as_py() if group.num_rows else -1, found, n_buckets)

    recurring = answered(texts.groupBy("shard").applyInArrow(send_anchors, ENTRIES), later_only=False)
    sent = texts.groupBy("shard").cogroup(recurring.groupBy("shard")).applyInArrow(send_windows, ENTRIES)
    return answered(sent, later_only=True)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) for every row."""

    def run(text: pa.Table, confirmed: pa.Table) -> pa.Table:
        out = []
        for part, rows in located(text, confirmed):
            kept = [b" ".join(words) if not gone.any() else b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) for _, words, gone in rows]
            out.append(
                pa.table(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_words": pa.array([len(words) for _, words, _ in rows], pa.int64()),
                        "n_removed": pa.array([int(gone.sum()) for _, _, gone in rows], pa.int64()),
                        "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    }
                )
            )
        give_back()
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_sha256": pa.array([], pa.string())})

    n_bytes = text_bytes(docs)
    texts = dealt(docs.select("doc_id", "text"), n_bytes)
    return texts.groupBy("shard").cogroup(confirmed_windows(texts, n_bytes).groupBy("shard")).applyInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remaining(raw: bytes, gone: np.ndarray) -> str:
    """A text without the words that go and the white space before each; the rest is as it was."""
    starts, ends, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    before = np.concatenate([[0], ends[:-1]])
    out = [raw[a:b] for a, b, g in zip(before.tolist(), ends.tolist(), gone.tolist()) if not g]
    return b"".join(out).lstrip().decode() if gone[:1].any() else b"".join(out).decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words taken out of ``text``; documents that lose all their words go. Untouched texts stay as
    they are. Other columns are kept."""
    columns = docs.columns
    schema = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")).schema
    others = F.struct(*[named(c) for c in columns if c not in ("doc_id", "text")]) if len(columns) > 2 else F.struct(F.lit(0).alias("none"))
    n_bytes = text_bytes(docs)
    texts = dealt(docs.select("doc_id", "text"), n_bytes)

    def run(text: pa.Table, confirmed: pa.Table) -> pa.Table:
        out = []
        for part, rows in located(text.select(["doc_id", "text", "others"]), confirmed):
            # Rows of which nothing goes are taken as they are, the others' texts are written anew.
            at = [i for i, (_, _, gone) in enumerate(rows) if not gone.any() or not gone.all()]
            kept = part.take(pa.array(at, pa.int64()))
            if any(rows[i][2].any() for i in at):
                whole = kept.column("text").to_pylist()
                new = [remaining(rows[i][0], rows[i][2]) if rows[i][2].any() else t for i, t in zip(at, whole)]
                kept = kept.set_column(1, "text", pa.array(new, pa.string()))
            out.append(kept)
        give_back()
        return pa.Table.from_batches(out, schema=text.select(["doc_id", "text", "others"]).schema) if out else text.select(["doc_id", "text", "others"]).slice(0, 0)

    carried = dealt(docs.select("doc_id", "text", others.alias("others")), n_bytes)
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), carried.schema["others"]])
    out = carried.groupBy("shard").cogroup(confirmed_windows(texts, n_bytes).groupBy("shard")).applyInArrow(run, kind)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in columns]).to(schema)
