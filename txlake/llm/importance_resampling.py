"""Quality classification by importance resampling over hashed n-grams.

Two generative models, bags of word unigrams and bigrams hashed into ``BUCKETS``, are fitted: the raw one on every
document, the target one on labelled documents of good quality that are not toxic (at most ``MOST_TARGETS`` of them, those
with the smallest hash of doc_id). A document's log weight is its mean log ratio of target to raw probability for each
n-gram, times ``LENGTH``, so that long documents do not outweigh all others. Adding Gumbel noise to the log weights and
taking the ``k`` largest draws ``k`` documents without replacement in proportion to their weights. ``k`` is the share of target
documents (good and not toxic) among those labelled good or bad, or ``share``, of all documents with words.

The threshold of the ``k`` largest is found by counting in ever finer ranges, so no task or driver sees all
documents. Defined cases: a null, empty or wordless text has no weight and is not kept; noise depends on doc_id and
``seed``, so rows that repeat one fare alike; ties at the threshold are all kept; without labelled targets every
document weighs the same; a null doc_id draws its own noise; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textops import SpanHasher, slices, text_buffer, text_of_words, window_hashes, word_spans

BUCKETS = 1 << 16
MOST_TARGETS = 50_000
LENGTH = 100.0


def features(part: pa.RecordBatch, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every unigram and bigram of a slice."""
    data, offs = text_buffer(part.column("text"))
    starts, ends, first = word_spans(data, offs)
    words = hasher(data, starts, ends)
    pairs, valid = window_hashes(words, first, 2)
    owner, at = text_of_words(first), np.flatnonzero(valid)
    return (np.concatenate([words, pairs[at]]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([owner, owner[at]])


def fitted(docs: DataFrame, targets: np.ndarray) -> np.ndarray:
    """The log ratio of target to raw probability of every bucket; one pass over all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, raw, target = SpanHasher(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part in slices(batches):
            bucket, text = features(part, hasher)
            raw += np.bincount(bucket, minlength=BUCKETS)
            ids = part.column("doc_id")
            wanted = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), targets) & ids.is_valid().to_numpy(zero_copy_only=False)
            target += np.bincount(bucket[wanted[text]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    sums = docs.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = np.zeros((2, BUCKETS))
    for r in sums.collect():  # at most BUCKETS rows
        counts[:, r["bucket"]] = r["raw"], r["target"]
    logs = np.log(counts + 1) - np.log(counts.sum(axis=1, keepdims=True) + BUCKETS)
    return logs[1] - logs[0] if counts[1].any() else np.zeros(BUCKETS)


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The ``k``-th largest value of ``column`` (nulls left out) by counts over ever finer ranges."""
    values = df.where(F.col(column).isNotNull()).select(column)
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return low
    bins = 1024
    while True:
        inside = values.where((F.col(column) >= low) & (F.col(column) <= high))
        step = (high - low) / bins
        if step <= 0 or low + step <= low:
            return low
        cell = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1)).alias("cell")
        found = inside.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("cell")).collect()
        for r in found:
            if k <= r["n"]:
                break
            k -= r["n"]
        if r["low"] == r["high"] or k == r["n"]:
            return r["low"]
        low, high = r["low"], r["high"]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0) -> DataFrame:
    """doc_id, n_ngrams, log_weight, draw (log weight and noise) and kept, for every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    wanted = "quality = 1 and coalesce(toxic, 0) = 0"
    good = labels.where(f"doc_id is not null and {wanted}").select("doc_id").distinct()
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_TARGETS).collect()
    targets = np.array([r[0] for r in chosen], np.int64)
    ratio = fitted(rows, targets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for part in slices(batches):
            bucket, text = features(part, hasher)
            n = np.bincount(text, minlength=part.num_rows)
            mean = np.bincount(text, weights=ratio[bucket], minlength=part.num_rows) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(LENGTH * mean, mask=n == 0)], ["doc_id", "n_ngrams", "log_weight"])

    # Uniform in (0, 1) from 52 bits of a hash.
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    weighed = rows.mapInArrow(run, "doc_id long, n_ngrams long, log_weight double")
    drawn = stored(weighed.withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform))))
    if share is None:
        share = labels.where("quality in (0, 1)").agg(F.avg(F.expr(f"int({wanted})"))).first()[0]
        share = 1.0 if share is None else float(share)
    least = kth_largest(drawn, "draw", round(share * drawn.where("draw is not null").count()))
    kept = F.coalesce(F.col("draw") >= F.lit(least), F.lit(False)) if least is not None else F.lit(False)
    return drawn.withColumn("kept", kept)
