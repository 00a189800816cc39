"""Quality rules whose cutoffs carry a guarantee on labelled documents.

Every rule says "reject a document whose signal is above the cutoff". Cutoffs come from labelled documents: over a
fixed grid, the false rejections among good documents of a stratum are counted, and a cutoff is admissible only if
the exact (Clopper-Pearson) upper bound of its false-rejection rate stays within the rule's share of ``max_false``.
Each stratum and rule tests its grid from the mildest cutoff to the strictest and stops at the first that fails
(fixed-sequence testing, which needs no correction inside a sequence); the confidence is split over all sequences
(Bonferroni). So with probability ``1 - delta`` all admissible cutoffs keep their promise at once, and the rules
together reject at most ``max_false`` of the good documents of any stratum. Among admissible cutoffs the one with the largest share of
rejected bad documents less ``CAUTION`` times that of rejected good ones is taken, the mildest on ties; without one
the rule is off.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; a null stratum is the stratum
``""``; repeated rows are judged alike; unlabelled strata have no rules beyond the base rule; an empty table gives an
empty result; extra columns of the input are ignored by ``judge`` and kept by ``accepted``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_process_cache, stored
from .textops import SpanHasher, covered, is_space, line_spans, mix, per_text, slices, text_buffer, text_of_words, window_hashes, word_spans

BASE_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Shares in percent, and the largest value that the grid tells apart.
SIGNALS = {"repeat_pct": 100.0, "symbol_pct": 100.0, "upper_pct": 100.0, "mark_pct": 100.0, "dup_line_pct": 100.0}
GRID = 100
CAUTION = 10
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def measured_slice(part: pa.RecordBatch, hasher: SpanHasher) -> dict[str, np.ndarray]:
    """The base counts and the signals of every text of a slice."""
    data, offs = text_buffer(part.column("text"))
    starts, ends, first = word_spans(data, offs)
    n_words = np.diff(first)
    inside = ~is_space()[data]
    word_chars = per_text(inside & ((data & 0xC0) != 0x80), offs)

    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in "#*$%&|<>"]] = True
    n_symbols = per_text(symbol[data], offs)

    line_start, line_end = line_spans(data, offs)
    chars = np.concatenate([[0], np.cumsum(inside)])
    worded = chars[line_end] > chars[line_start]
    line_start, line_end = line_start[worded], line_end[worded]
    line_text = np.searchsorted(offs, line_start, "right") - 1
    line_key = mix(hasher(data, line_start, line_end) ^ mix(line_text.astype(np.uint64)))
    n_lines = np.bincount(line_text, minlength=len(n_words))
    _, kept = np.unique(line_key, return_index=True)
    n_dup_lines = n_lines - np.bincount(line_text[kept], minlength=len(n_words))

    windows, valid = window_hashes(hasher(data, starts, ends), first, 3)
    place = np.flatnonzero(valid)
    owner = text_of_words(first)
    key = mix(windows[place] ^ mix(owner[place].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    n_repeat_words = per_text(covered(place[again], 3, len(starts)), first)

    upper = per_text((data >= 65) & (data <= 90), offs)
    letter_or_digit = (data >= 128) | ((data >= 48) & (data <= 57)) | ((data | 32) >= 97) & ((data | 32) <= 122)
    marks = per_text(inside & ~letter_or_digit, offs)

    def pct(a, b):
        return 100.0 * a / np.maximum(b, 1)

    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "repeat_pct": pct(n_repeat_words, n_words),
        "symbol_pct": pct(n_symbols, word_chars),
        "upper_pct": pct(upper, word_chars),
        "mark_pct": pct(marks, word_chars),
        "dup_line_pct": pct(n_dup_lines, n_lines),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language), text_hash, the base counts and the signals of every row; one pass, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_process_cache()
        hasher = SpanHasher()
        for part in slices(batches):
            found = measured_slice(part, hasher)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in told), *(pa.array(x) for x in found.values())], [*told, *found]
            )

    told = ["doc_id", "stratum", "text_hash"]
    text = F.col("text").cast("string")
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long"), stratum.alias("stratum"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signals = ", ".join(f"{name} double" for name in SIGNALS)
    return narrow.mapInArrow(run, f"doc_id long, stratum string, text_hash long, {BASE_FIELDS}, {signals}")


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate under which at most ``k`` of ``n`` still has probability ``delta``."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most_k(p: float) -> float:
        return sum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(logs))

    low, high = k / n, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        if 0 < mid < 1 and at_most_k(mid) > delta:
            low = mid
        else:
            high = mid
    return high


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def calibrate(measured: DataFrame, labels: DataFrame, max_false: float = 0.05, delta: float = 0.05) -> dict[tuple[str, str], float]:
    """(stratum, signal) -> cutoff. Only histograms (strata x signals x grid x 2) reach the driver.

    Documents that the base rule rejects are left out: the method's verdict never reaches them. The bound needs
    independent draws, so a text counts once in its stratum, however many copies and labels it has, as good if any
    label says so; labels other than 0 and 1 and null labels are ignored.
    """
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality")).where("__quality in (0, 1)")
    labelled = measured.where(~base_failed()).join(marked, F.col("doc_id") == F.col("__id"))
    known = labelled.groupBy("stratum", "text_hash").agg(F.max("__quality").alias("__quality"), *[F.max(s).alias(s) for s in SIGNALS])
    cell = F.explode(
        F.array(*[F.struct(F.lit(s).alias("signal"), F.least(F.ceil(F.col(s) * (GRID / top)), F.lit(GRID)).cast("int").alias("cell")) for s, top in SIGNALS.items()])
    ).alias("at")
    rows = known.select("stratum", "__quality", cell).groupBy("stratum", "at.signal", "at.cell", "__quality").count().collect()

    count: dict[tuple[str, str], np.ndarray] = {}
    for r in rows:
        count.setdefault((r["stratum"], r["signal"]), np.zeros((2, GRID + 1), np.int64))[r["__quality"], r["cell"]] += r["count"]
    cutoffs = {}
    for (stratum, signal), cells in sorted(count.items()):
        bad_total, good_total = cells.sum(axis=1)
        # Rejected above grid point c: the cells beyond c.
        bad, good = (cells.sum(axis=1, keepdims=True) - np.cumsum(cells, axis=1))[:, :GRID]
        best = (0.0, 0)
        for c in reversed(range(GRID)):
            if upper_bound(int(good[c]), int(good_total), delta / len(count)) > max_false / len(SIGNALS):
                break
            gain = bad[c] / max(1, bad_total) - CAUTION * good[c] / max(1, good_total)
            if gain > best[0]:
                best = (gain, c)
        if best[0] > 0:
            cutoffs[stratum, signal] = best[1] * SIGNALS[signal] / GRID
    return cutoffs


def verdict(cutoffs: dict[tuple[str, str], float]):
    """Column: does a measured row pass the base rule and every calibrated rule of its stratum?"""
    passed = ~base_failed()
    for (stratum, signal), cutoff in sorted(cutoffs.items()):
        passed &= ~((F.col("stratum") == stratum) & (F.col(signal) > cutoff))
    return passed


def judge(docs: DataFrame, labels: DataFrame, max_false: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per document with its counts, signals, ``base_failed`` and ``kept``."""
    measured = stored(measure(docs))
    cutoffs = calibrate(measured, labels, max_false, delta)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", verdict(cutoffs))


def accepted(docs: DataFrame, labels: DataFrame, max_false: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. The second pass filters in place, without a shuffle."""
    cutoffs = calibrate(stored(measure(docs)), labels, max_false, delta)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_process_cache()
        hasher = SpanHasher()
        for part in slices(batches):
            found = measured_slice(part, hasher)
            passed = (found["n_words"] >= MIN_WORDS) & (100 * found["n_repeat_words"] <= MAX_REPEAT_PCT * found["n_words"])
            stratum = np.array([x or "" for x in part.column("lang").to_pylist()], object)
            for (of, signal), cutoff in cutoffs.items():
                passed &= ~((stratum == of) & (found[signal] > cutoff))
            yield part.filter(pa.array(passed))

    rows = docs.withColumn("text", F.col("text").cast("string")).withColumn("lang", F.col("lang").cast("string"))
    return rows.mapInArrow(run, rows.schema)
