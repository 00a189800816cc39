"""Ranked lexical search by K2-treaps over the grid of terms and documents.

Every slice of documents becomes one grid: a row for each of its terms, a column for each document, arranged so
that much of it is empty, and in a cell the impact of the term in the document,
(10^9 tf) div (1000 tf + 12 m). A K2-treap stores it: the root is the whole square, and every node holds the largest cell
of its quadrant that no node above it holds, so there are as many nodes as cells, and a node's impact bounds all below it.
Level by level a node has four bits for its children, the place of its cell inside its quadrant in as few bytes as
the level needs, and how far its impact lies below its parent's. The trees are a table in the shared folder, one row a slice.

A search brings a bounded pack of items to all slices. The terms of an item descend together: a range of documents
carries, for each term, the node on that term's row path and the cells met on the way, and the sum over the terms of
weight times the largest of them bounds the score of every document in the range. Each round splits the best ranges of all items;
at a single document, or where only cells are left, the sum is the score. A range goes when it can no longer enter
the item's best ``k`` of the whole task. What is left, ``k`` rows an item and task, meets in a window.

In a slice and in a query, terms are told apart by 64-bit hashes.

Defined cases: a null or empty text has no terms and no rank; rows that repeat a doc_id are documents of their own; a
null doc_id counts as the largest 64-bit number, which stands for none; items that share id and text are one, those that
share only the id are ranked each; an item without terms has no rows; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.session import scratch_path

from .textops import SpanHasher, is_between_terms, mix, slices, text_buffer, text_of_words, word_spans
from .wordids import gathered

SLICE = 8 << 20
NO_ID = np.iinfo(np.int64).max
#: Item terms in one pack, and in one joint descent.
PACK_TERMS = 1 << 19
DESCENT_TERMS = 1 << 11
#: Ranges that an item splits in a round.
BEAM = 64
#: Parts of a grid's documents by which its terms are arranged.
PARTS = 16
INDEX = "docs array<long>, terms binary, df binary, height int, levels array<struct<masks:binary,places:binary,drops:binary>>"
#: For a node's child bits and a quadrant: how many children come before it.
BEFORE = np.array([[bin(bits & ((1 << k) - 1)).count("1") for k in range(4)] for bits in range(16)])
CHILDREN = np.array([bin(bits).count("1") for bits in range(16)])


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers at the even places."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x.astype(np.int64)


def gathered_bits(x: np.ndarray) -> np.ndarray:
    """The bits at the even places, put together."""
    x = x.astype(np.uint64) & np.uint64(0x5555555555555555)
    for shift, keep in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(keep)
    return x.astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold the largest; the first byte says how many."""
    size = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([size]) + np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    size = raw[0]
    wide = np.zeros(((len(raw) - 1) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, size)
    return wide.view("<i8")[:, 0].astype(np.int64)


def term_spans(part: pa.RecordBatch, separates: np.ndarray) -> tuple[np.ndarray, ...]:
    data, offs = text_buffer(part.column("text"))
    return data, *word_spans(data, offs, separates)


def treap(rows: np.ndarray, cols: np.ndarray, impact: np.ndarray) -> tuple[int, list[dict[str, bytes]]]:
    """(height, levels) of the K2-treap of the given cells, which are all different."""
    height = max(int(max(rows.max(), cols.max())).bit_length(), 1)
    code = spread(rows) << 1 | spread(cols)
    order = np.argsort(code)
    code, impact, above, levels = code[order], impact[order], np.zeros(1, np.int64), []
    for level in range(height + 1):
        if not len(code):
            break
        shift = 2 * (height - level)
        prefix = code >> shift
        heads = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        node = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(code))))
        most = np.maximum.reduceat(impact, heads)
        at = np.flatnonzero(impact == most[node])
        at = at[np.concatenate([[True], node[at][1:] != node[at][:-1]])]
        # The root's impact stands for itself; the parents of the others are in the order of their children.
        drops = most if level == 0 else above[heads] - most
        place = code[at] & ((1 << shift) - 1)
        code, impact, node = (np.delete(x, at) for x in (code, impact, node))
        quadrant = (code >> (shift - 2)) & 3 if shift else code
        masks = np.zeros(len(heads), np.uint8)
        for k in range(4):
            masks[node[quadrant == k]] |= 1 << k
        above = most[node]
        levels.append({"masks": masks.tobytes(), "places": packed(place), "drops": packed(drops)})
    return height, levels


def inverted(order: np.ndarray) -> np.ndarray:
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place


def arranged(row: np.ndarray, col: np.ndarray, df: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the terms, order of the documents) that leaves much of the grid empty.

    Documents with the same most frequent term lie together, which tells languages apart; terms lie by the part of
    the documents that they are in, there the frequent ones first."""
    by_df = inverted(np.argsort(-df, kind="stable"))
    commonest = np.full(len(ids), len(df))
    np.minimum.at(commonest, col, by_df[row])
    of_col = np.lexsort((ids, commonest))
    middle = np.bincount(row, inverted(of_col)[col]) / df
    return np.lexsort((-df, (middle * PARTS // len(ids)).astype(np.int64))), of_col


class Grid:
    """A slice's tree with the row, column and impact of every node, and where its children begin."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, height: int, levels: list[dict[str, bytes]]):
        self.docs, self.height, self.least = docs, height, [docs]
        for _ in range(height):
            below = self.least[-1]
            self.least.append(np.minimum.reduceat(below, np.arange(0, len(below), 2)))
        self.by_hash = np.argsort(terms)
        self.sorted = terms[self.by_hash]
        masks, codes, impacts, first = [], [], [], []
        prefix, above, total = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
        for level, stored in enumerate(levels):
            mask = np.frombuffer(stored["masks"], np.uint8)
            codes.append(prefix << (2 * (height - level)) | unpacked(stored["places"]))
            drop = unpacked(stored["drops"])
            impact = drop if level == 0 else above - drop
            n = CHILDREN[mask]
            total += len(mask)
            first.append(total + np.cumsum(n) - n)
            bits = (mask[:, None] >> np.arange(4)) & 1
            parent, quadrant = np.nonzero(bits)
            prefix, above = prefix[parent] << 2 | quadrant, impact[parent]
            masks.append(mask)
            impacts.append(impact)
        self.mask, self.impact, self.first = np.concatenate(masks), np.concatenate(impacts), np.concatenate(first)
        code = np.concatenate(codes)
        self.row, self.col = gathered_bits(code >> 1), gathered_bits(code)

    def rows_of(self, terms: np.ndarray) -> np.ndarray:
        """The row of each term, -1 for those that no document of the slice has."""
        at = np.minimum(np.searchsorted(self.sorted, terms), len(self.sorted) - 1)
        return np.where(self.sorted[at] == terms, self.by_hash[at], -1)


class Best:
    """The ``k`` best (score, doc) of every item so far; equal scores by doc."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.doc = k, np.zeros((n, k), np.int64), np.full((n, k), NO_ID)

    def may_enter(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        least = self.score[item, -1]
        return (score > least) | (score == least) & (score > 0) & (doc < self.doc[item, -1])

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        enters = (score > 0) & (self.may_enter(item, score, doc))
        item, score, doc = item[enters], score[enters], doc[enters]
        own = np.unique(item)
        item = np.concatenate([np.repeat(own, self.k), item])
        score, doc = np.concatenate([self.score[own].ravel(), score]), np.concatenate([self.doc[own].ravel(), doc])
        order = np.lexsort((doc, -score, item))
        place = placed(item[order])
        order = order[place < self.k]
        self.score[own], self.doc[own] = score[order].reshape(-1, self.k), doc[order].reshape(-1, self.k)


def placed(groups: np.ndarray) -> np.ndarray:
    """The place, from 0, of each element in its run of equal elements."""
    if not len(groups):
        return np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    return np.arange(len(groups)) - np.repeat(heads, np.diff(np.append(heads, len(groups))))


def run_heads(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


class Store:
    """Entries of ranges, in columns that only grow until more than half of them belong to no range."""

    NAMES = ("term", "node", "col", "impact")

    def __init__(self):
        self.columns, self.n = {k: np.zeros(1 << 12, np.int64) for k in self.NAMES}, 0

    def add(self, *columns: np.ndarray) -> int:
        """The place of the first of the new entries."""
        begin, self.n = self.n, self.n + len(columns[0])
        for k, new in zip(self.NAMES, columns):
            if self.n > len(self.columns[k]):
                self.columns[k] = np.concatenate([self.columns[k][:begin], np.zeros(2 * self.n - begin, np.int64)])
            self.columns[k][begin : self.n] = new
        return begin

    def of(self, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        at = gathered(np.arange(self.n), start, size)
        return [self.columns[k][at] for k in self.NAMES]


def descend(grid: Grid, best: Best, item: np.ndarray, row: np.ndarray, weight: np.ndarray) -> None:
    """Enters into ``best`` the documents of ``grid`` for the terms (item, row, weight), sorted by item.

    An entry is a term of a range with the node on its path (-1: a cell met above, with its column) and its impact.
    A range has an item, a level, a block of columns, a bound, and the place and number of its entries."""
    height, store = grid.height, Store()
    items, heads = np.unique(item, return_index=True)
    n = len(items)
    store.add(np.arange(len(item)), np.zeros(len(item), np.int64), np.full(len(item), -1), np.repeat(grid.impact[:1], len(item)))
    sizes = np.diff(np.append(heads, len(item)))
    ranges = np.stack([items, np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), heads, sizes])
    while ranges.shape[1]:
        # The best ranges of every item are split, the others wait.
        order = np.lexsort((-ranges[3], ranges[0]))
        chosen = np.zeros(len(order), bool)
        chosen[order[placed(ranges[0][order]) < BEAM]] = True
        own_item, own_level, own_block, _, start, size = ranges[:, chosen]
        term, node, col, impact = store.of(start, size)
        of = np.repeat(np.arange(len(size)), size)
        shift = height - own_level[of] - 1

        is_node, cell = np.flatnonzero(node >= 0), np.flatnonzero(node < 0)
        x, row_bit = node[is_node], (row[term[is_node]] >> shift[is_node]) & 1
        mask, first = grid.mask[x], grid.first[x]
        at = grid.row[x] == row[term[is_node]]
        hit, met = is_node[at], grid.col[x[at]]
        new = [
            (of[cell] * 2 + (col[cell] >> shift[cell] & 1), term[cell], node[cell], col[cell], impact[cell]),
            (of[hit] * 2 + (met >> shift[hit] & 1), term[hit], np.full(len(hit), -1), met, impact[hit]),
        ]
        for half in (0, 1):
            k = 2 * row_bit + half
            has = (mask >> k) & 1 == 1
            child = (first + BEFORE[mask, k])[has]
            to = is_node[has]
            new.append((of[to] * 2 + half, term[to], child, np.full(len(to), -1), grid.impact[child]))
        key, term, node, col, impact = (np.concatenate(x) for x in zip(*new))
        both = key * len(item) + term
        order = np.argsort(both, kind="stable")
        both, key, term, node, col, impact = (x[order] for x in (both, key, term, node, col, impact))

        # A term counts once in a bound, with its largest impact.
        heads, terms = run_heads(key), run_heads(both)
        sizes = np.diff(np.append(heads, len(key)))
        parent = key[heads] >> 1
        level = own_level[parent] + 1
        if len(heads):
            weighed = weight[term[terms]] * np.maximum.reduceat(impact, terms)
            bound = np.add.reduceat(weighed, np.searchsorted(terms, heads))
            done = (level == height) | (np.maximum.reduceat(node, heads) < 0)
        else:
            bound, done = heads, np.zeros(0, bool)

        # Single documents, and ranges of which only cells are left: here the sum by column is the score.
        ends = np.repeat(done, sizes)
        if ends.any():
            its_item = np.repeat(own_item[parent], sizes)[ends]
            its_col = np.where(node[ends] >= 0, grid.col[node[ends]], col[ends])
            value = weight[term[ends]] * impact[ends]
            order = np.lexsort((its_col, its_item))
            its_item, its_col, value = its_item[order], its_col[order], value[order]
            at = run_heads(its_item * (1 << height) + its_col)
            best.add(its_item[at], np.add.reduceat(value, at), grid.docs[its_col[at]])

        found = np.stack([own_item[parent], level, own_block[parent] * 2 + (key[heads] & 1), bound, heads, sizes])[:, ~done]
        found = found[:, enterable(grid, best, found)]
        at = gathered(np.arange(len(key)), found[4], found[5])
        found[4] = store.add(term[at], node[at], col[at], impact[at]) + np.cumsum(found[5]) - found[5]
        ranges = np.concatenate([ranges[:, ~chosen], found], axis=1)
        if ends.any():
            ranges = ranges[:, enterable(grid, best, ranges)]
        if store.n > (1 << 16) and ranges[5].sum() * 2 < store.n:
            kept, store = store.of(ranges[4], ranges[5]), Store()
            store.add(*kept)
            ranges[4] = np.cumsum(ranges[5]) - ranges[5]


def enterable(grid: Grid, best: Best, ranges: np.ndarray) -> np.ndarray:
    """If a document of the range may yet be one of its item's best."""
    least = np.empty(ranges.shape[1], np.int64)
    for level in np.unique(ranges[1]):
        at = ranges[1] == level
        least[at] = grid.least[grid.height - level][ranges[2][at]]
    return best.may_enter(ranges[0], ranges[3], least)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separates = is_between_terms(digits=True)
        for part in slices(batches, limit=SLICE):
            n = np.diff(term_spans(part, separates)[3])
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["n", "terms"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "n long, terms long").agg(F.sum("n"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def length_terms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 - 25 + (25 n N) div L, beyond 64 bits in Python's numbers."""
    if int(n.max(initial=0)) * 25 * documents < 1 << 63:
        return 75 + 25 * n * documents // terms
    return np.array([75 + 25 * int(x) * documents // terms for x in n], np.int64)


def index(docs: DataFrame, documents: int, terms: int) -> DataFrame:
    """One row for each slice of documents with a term: its grid's documents, terms and tree; written to the shared folder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, separates = SpanHasher(fold=True), is_between_terms(digits=True)
        names = ["docs", "terms", "df", "height", "levels"]
        kind = pa.list_(pa.struct([("masks", pa.binary()), ("places", pa.binary()), ("drops", pa.binary())]))
        for part in slices(batches, limit=SLICE):
            data, starts, ends, first = term_spans(part, separates)
            if not len(starts):
                continue
            ids = part.column("doc_id").fill_null(int(NO_ID)).to_numpy()
            owner, term = text_of_words(first), hasher(data, starts, ends)
            _, at, tf = np.unique(mix(term ^ mix(owner.astype(np.uint64))), return_index=True, return_counts=True)
            own, row, df = np.unique(term[at], return_inverse=True, return_counts=True)
            m = length_terms(np.diff(first), documents, terms)
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[owner[at]])
            of_row, of_col = arranged(row, owner[at], df, ids)
            height, levels = treap(inverted(of_row)[row], inverted(of_col)[owner[at]], impact)
            values = [[ids[of_col]], [own[of_row].tobytes()], [packed(df[of_row])], [height], [levels]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), kind))], names)

    spark = docs.sparkSession
    path = scratch_path(spark, "grids")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX)
    # Few trees in a row group: a reader holds a row group's trees at once.
    rows.write.option("parquet.block.row.count.limit", "4").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, item (hash of its text), term, times: the terms of every different item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, separates = SpanHasher(fold=True), is_between_terms(digits=True)
        for part in slices(batches):
            data, starts, ends, first = term_spans(part, separates)
            owner, term = text_of_words(first), hasher(data, starts, ends)
            _, at, times = np.unique(mix(term ^ mix(owner.astype(np.uint64))), return_index=True, return_counts=True)
            own = pa.array(owner[at])
            columns = [part.column("item_id").take(own), part.column("item").take(own), pa.array(term[at].view(np.int64)), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "item", "term", "times"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).withColumn("item", F.xxhash64("text")).distinct()
    return rows.mapInArrow(run, "item_id long, item long, term long, times long")


def document_counts(grids: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """In how many documents each of the sorted ``terms`` is; at most one row a term comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, df in zip(batch.column("terms"), batch.column("df")):
                own, df = np.frombuffer(own.as_py(), np.uint64), unpacked(df.as_py())
                asked = np.isin(own, terms)
                yield pa.RecordBatch.from_arrays([pa.array(own[asked].view(np.int64)), pa.array(df[asked])], ["term", "df"])

    found = grids.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term & (1 << 64) - 1: r.df for r in found.collect()}


def best_of_pack(grids: DataFrame, pack: list, documents: int, k: int) -> DataFrame:
    """item_id, item, doc_id, score: the best ``k`` documents of every task for the items of ``pack``."""
    keys = sorted({(r.item_id is None, r.item_id or 0, r.item) for r in pack})
    number = {key: i for i, key in enumerate(keys)}
    rows = sorted((number[r.item_id is None, r.item_id or 0, r.item], r.term & (1 << 64) - 1, r.times) for r in pack)
    item, term = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.uint64)
    df = document_counts(grids, np.unique(term))
    weight = np.array([times * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) if t in df else 0 for _, t, times in rows], np.int64)
    item, term, weight = item[weight > 0], term[weight > 0], weight[weight > 0]
    # Joint descents: runs of whole items with about DESCENT_TERMS terms.
    turn = np.cumsum(np.bincount(item, minlength=len(keys))) // DESCENT_TERMS
    cuts = np.append(run_heads(turn[item]), len(item))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(keys), k)
        for batch in batches:
            for i in range(batch.num_rows):
                docs, own, height, levels = (batch.column(c)[i] for c in ("docs", "terms", "height", "levels"))
                grid = Grid(docs.values.to_numpy(), np.frombuffer(own.as_py(), np.uint64), height.as_py(), levels.as_py())
                row = grid.rows_of(term)
                for a, b in zip(cuts[:-1], cuts[1:]):
                    has = a + np.flatnonzero(row[a:b] >= 0)
                    if len(has):
                        descend(grid, best, item[has], row[has], weight[has])
        at, place = np.nonzero(best.score)
        ids, texts = [keys[i][1] if not keys[i][0] else None for i in at], [keys[i][2] for i in at]
        doc, score = best.doc[at, place], best.score[at, place]
        columns = [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(doc, pa.int64(), mask=doc == NO_ID), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "item", "doc_id", "score"])

    return grids.select("docs", "terms", "height", "levels").mapInArrow(run, "item_id long, item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, pack_terms: int = PACK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item with a score above 0.

    Items go to the tasks in packs of about ``pack_terms`` terms, one pass over the index each."""
    spark = docs.sparkSession
    documents, terms = corpus_size(docs)
    path = scratch_path(spark, "items")
    item_terms(items).write.parquet(path)
    asked = spark.read.parquet(path)
    result = spark.createDataFrame([], "item_id long, item long, doc_id long, score long")
    if documents:
        grids = index(docs, documents, terms)
        packs = -(-asked.count() // pack_terms)
        for i in range(packs):
            pack = asked.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(packs)) == i).collect()
            result = result.unionByName(best_of_pack(grids, pack, documents, k)) if pack else result
    order = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
