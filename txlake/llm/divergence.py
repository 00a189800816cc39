"""How far the term use of each source lies from that of the other sources of its language, by hash-consed segment trees.

Terms are maximal runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``), A-Z lower-cased. A language keeps the
terms in at least ``LEAST_DOCUMENTS`` of its documents; a term's id is its place by hash. A group is a (language, source); its
smoothed share of a kept term is p = 1 + floor(10^9 (count + 1) / (N + V)), with N its occurrences of all V kept terms.
A group with shares p lies sum(floor((p - q)^2 / q)) from one with shares q.

The counts of a group over the term ids are a segment tree. Blocks of about ``2 ** MOST_BITS`` terms, its subtrees, are the
work of one task for all groups of the language: there, equal subtrees of any group and place are one node, found level by level as
the distinct pairs of nodes below. Two groups' subtrees are walked together from the top; a pair of nodes met again
for the same two groups only raises its multiplicity, so each is priced once, in both directions. What the subtrees
give is added up by Spark.

Counting pre-aggregates by slice of text, then by map task, so a source with a third of all documents is no heavier
than its vocabulary. Inside a slice and inside a block, terms are told apart by 64-bit hashes. Arithmetic is
in 64-bit integers without overflow: shares by long division in steps of 1000.

Defined cases: null text, lang and source are ''; doc_id is not read, every row is a document; a group without kept
terms has count 0 for each; a language without kept terms has distance 0 between its groups; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.session import scratch_path

from .textops import SpanHasher, is_between_terms, mix, slices, text_buffer, text_of_words, word_spans
from .wordids import gathered

LEAST_DOCUMENTS = 3
MOST_RANKS = 200
SCALE = 1_000_000_000
#: Counts of all groups that one task holds at once, and the widest subtree.
CELLS = 1 << 20
MOST_BITS = 12
SLICE = 6 << 20


def written(spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def slice_counts(part: pa.RecordBatch, hasher: SpanHasher, separates: np.ndarray) -> pa.RecordBatch:
    """lang, source, term, n (occurrences), docs (documents) for the terms of every group in a slice."""
    lang, source = (pc.dictionary_encode(part.column(c)) for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
    data, offs = text_buffer(part.column("text"))
    starts, ends, first = word_spans(data, offs, separates)
    owner, term = text_of_words(first), hasher(data, starts, ends)
    _, at, n = np.unique(mix(term ^ mix(owner.astype(np.uint64))), return_index=True, return_counts=True)
    _, of_group, inverse = np.unique(mix(term[at] ^ mix(group[owner[at]].astype(np.uint64))), return_index=True, return_inverse=True)
    where = at[of_group]

    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32
    length = (ends - starts)[where]
    ends_at = np.zeros(len(where) + 1, np.int64)
    np.cumsum(length, out=ends_at[1:])
    terms = pa.LargeStringArray.from_buffers(len(where), pa.py_buffer(ends_at), pa.py_buffer(folded[gathered(data, starts[where], length)])).cast(pa.string())
    rows = pa.array(owner[where])
    counts = [np.bincount(inverse, n, minlength=len(where)).astype(np.int64), np.bincount(inverse, minlength=len(where)).astype(np.int64)]
    return pa.RecordBatch.from_arrays([part.column("lang").take(rows), part.column("source").take(rows), terms, *map(pa.array, counts)], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: one row for each term of each group."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, separates = SpanHasher(fold=True), is_between_terms(digits=False)
        for part in slices(batches, limit=SLICE):
            yield slice_counts(part, hasher, separates)

    found = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def divided(a, b, times):
    """floor(10^9 a / b) for 0 <= a < 9 * 10^15 and 0 < b < 9 * 10^15; ``times`` gives (quotient, rest)."""
    total, rest = times(a, b)
    for _ in range(3):
        digit, rest = times(rest * 1000, b)
        total = total * 1000 + digit
    return total


def share_column(count: Column, total: Column) -> Column:
    return 1 + divided(count + 1, total, lambda a, b: (F.call_function("div", a, b), a % b))


def distance_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(root of each row, the (left, right) nodes of every level from the top, the count of each leaf node).

    ``counts`` has a row for each group and 2 ** k columns; equal subtrees of a level are one node."""
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes, levels = nodes.reshape(counts.shape), []
    while nodes.shape[1] > 1:
        below = int(nodes.max()) + 1
        pairs, up = np.unique(nodes[:, ::2] * below + nodes[:, 1::2], return_inverse=True)
        nodes = up.reshape(len(counts), -1)
        levels.append((pairs // below, pairs % below))
    return nodes[:, 0], levels[::-1], leaves


def walked(roots: np.ndarray, levels: list, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pair, leaf node, leaf node, multiplicity): the distinct leaf pairs of the trees of groups ``left[i]`` and ``right[i]``."""
    pair, a, b, times = np.arange(len(left)), roots[left], roots[right], np.ones(len(left), np.int64)
    for lefts, rights in levels:
        n = int(max(lefts.max(), rights.max())) + 1
        pair, times = np.tile(pair, 2), np.tile(times, 2)
        key = (pair * n + np.concatenate([lefts[a], rights[a]])) * n + np.concatenate([lefts[b], rights[b]])
        key, inverse = np.unique(key, return_inverse=True)
        times = np.bincount(inverse, times).astype(np.int64)
        pair, a, b = key // n // n, key // n % n, key % n
    return pair, a, b, times


def distances(counts: np.ndarray, totals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, other group, distance over these terms), in batches, for all ordered pairs; a count of -1 is no term."""
    roots, levels, leaves = consed(counts)
    n, (first, second) = len(counts), np.triu_indices(len(counts), 1)
    step = max(1, CELLS // counts.shape[1])
    for i in range(0, len(first), step):
        left, right = first[i : i + step], second[i : i + step]
        pair, a, b, times = walked(roots, levels, left, right)
        real = leaves[a] >= 0
        pair, a, b, times = pair[real], leaves[a[real]], leaves[b[real]], times[real]
        p, q = (1 + divided(x + 1, totals[g[pair]], np.divmod) for x, g in ((a, left), (b, right)))
        square = (p - q) * (p - q)
        for price, one, two in ((square // q, left, right), (square // p, right, left)):
            value = np.zeros(len(left), np.int64)
            np.add.at(value, pair, price * times)
            yield one, two, value


def kept_cells(counts: DataFrame, least_documents: int) -> DataFrame:
    """lang, source, term, n, lang_n (occurrences in the language), first (true on one row a term) for the kept terms.

    The rows of a term are one for each source of the language."""
    term = Window.partitionBy("lang", "term")
    first = F.row_number().over(term.orderBy("source")) == 1
    cells = counts.select("*", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("lang_n"), first.alias("first"))
    return cells.where(F.col("in_docs") >= least_documents).select("lang", "source", "term", "n", "lang_n", "first")


def priced_block(table: pa.Table) -> pa.Table:
    """lang, source, item, value: what the terms of one block add to the distances; rows without a hash name the groups."""
    named = pc.is_null(table.column("hash"))
    groups, cells = table.filter(named), table.filter(pc.invert(named))
    terms, column = np.unique(cells.column("hash").to_numpy(), return_inverse=True)
    grid = np.zeros((len(groups), 1 << max(0, len(terms) - 1).bit_length()), np.int64)
    grid[:, len(terms) :] = -1
    source = groups.column("source").combine_chunks()
    grid[pc.index_in(cells.column("source"), source).to_numpy(), column] = cells.column("n").to_numpy()
    found = [np.concatenate(x) for x in zip(*distances(grid, groups.column("p_all").to_numpy()))] or [np.zeros(0, np.int64)] * 3
    lang = pa.repeat(groups.column("lang")[0], len(found[0]))
    return pa.table({"lang": lang, "source": source.take(pa.array(found[0])), "item": source.take(pa.array(found[1])), "value": pa.array(found[2])})


def divergences(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_ranks: int = MOST_RANKS, bits: int = MOST_BITS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` ranks the other sources of the language, ``term`` the terms used more than there."""
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    cells = written(spark, kept_cells(term_counts(named), least_documents), "cells")
    langs = cells.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = named.select("lang", "source").distinct().join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    # The terms of a block, about 2 ** bits of them, are fewer where a language has so many groups that a task could not hold their counts.
    blocks = F.ceil(F.col("v") / F.least(F.lit(1 << bits), F.greatest(F.lit(1), F.lit(CELLS) / F.col("many"))))
    langs = langs.join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("many")), "lang").select("lang", "v", "lang_total", blocks.alias("blocks"))
    facts = groups.join(langs, "lang", "left").select(
        "lang", "source", "blocks", (F.coalesce("total", F.lit(0)) + F.col("v")).alias("p_all"), (F.col("lang_total") + F.col("v")).alias("q_all")
    )
    facts = written(spark, facts, "groups")

    own = cells.join(facts, ["lang", "source"])
    priced = own.select("lang", "source", "term", share_column(F.col("n"), F.col("p_all")).alias("p"), share_column(F.col("lang_n"), F.col("q_all")).alias("q"))
    terms = priced.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance_column(F.col("p"), F.col("q")).alias("value"))

    hashed = own.select("lang", "source", "blocks", "n", F.xxhash64("term").alias("hash"))
    hashed = hashed.select("lang", F.pmod("hash", F.col("blocks")).alias("block"), "source", "hash", "n", F.lit(None).cast("long").alias("p_all"))
    names = facts.where("blocks > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("long").alias("hash"), F.lit(None).cast("long").alias("n"), "p_all"
    )
    parts = hashed.unionByName(names).groupBy("lang", "block").applyInArrow(priced_block, "lang string, source string, item string, value long")
    both = facts.select("lang", "source")
    none = both.join(both.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = parts.unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    ranked = terms.select("*", rank).where(F.col("rank") <= most_ranks)
    return pairs.select("*", rank).unionByName(ranked)
