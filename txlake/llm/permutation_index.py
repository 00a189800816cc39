"""Nearest neighbours by largest inner product with a permutation index.

Every vector is represented by its ``prefix`` nearest pivots in order. The rows are dealt by hash into blocks of
bounded size; inside a block equal vectors count as one, and each pivot has an inverted file of the vectors whose prefix
holds it, with its place there. A query walks the files of its own prefix, which gives the footrule distance between its
order and that of every vector posted (absent pivots count as the place behind the prefix), ranks the vectors of the block
by it and reranks the nearest, as many as ``share`` of the block's rows, at least ``at_least``, and all of the last footrule,
by the exact inner product in double precision. The best vectors stand for all their rows. Query blocks meet all row
blocks; each pair of blocks returns its ``k`` best rows per query, and the best of those are the answer.

Vectors are turned so that the largest inner product is the smallest angle: rows are divided by the largest norm and
completed to length 1 by one more component, queries are made length 1 with 0 there.

Only the pivots are a sample (``n_pivots`` different vectors, those with the smallest hash); every row is indexed.

Defined cases: rows whose vector is null, zero, of another length than most, or holds null or non-finite components,
and rows with a null vec_id, take no part; ties go to the smaller vec_id; of repeated rows each is a candidate for the
queries of other ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v array<double> of the rows that take part."""
    v = F.col("embedding").cast("array<double>").alias("v")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long"), v).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def completed(rows: np.ndarray, largest: float) -> np.ndarray:
    scaled = rows / largest
    return np.hstack([scaled, np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1, keepdims=True)))])


def nearest_pivots(points: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    return np.argsort(-(points @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Block:
    """The pivot inverted files of the different vectors of a block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, pivots: np.ndarray, prefix: int, largest: float):
        whole = np.ascontiguousarray(rows + 0.0)  # no -0.0: equal vectors are equal bytes
        _, first, vector = np.unique(whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.vectors, self.prefix = whole[first], prefix
        order = np.lexsort((ids, vector.ravel()))
        self.ids = ids[order]  # the ids of vector i in order: from bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(vector.ravel()[order], np.arange(len(first) + 1))
        near = nearest_pivots(completed(self.vectors, largest), pivots, prefix)
        at = np.argsort(near.ravel(), kind="stable")
        bounds = np.searchsorted(near.ravel()[at], np.arange(len(pivots) + 1))
        row, place = at // prefix, (at % prefix).astype(np.int32)
        self.files = [(row[a:b], place[a:b]) for a, b in zip(bounds, bounds[1:])]

    def search(self, query_id: int, query: np.ndarray, near: np.ndarray, k: int, n_candidates: int):
        """(ids, scores) of the best rows of this block."""
        footrule = np.zeros(len(self.vectors), np.int32)
        for place, pivot in enumerate(near):
            row, there = self.files[pivot]
            # Relative to a row that shares no pivot: its gap instead of the two that absence would cost.
            footrule[row] += np.abs(there - place) - (self.prefix - place) - (self.prefix - there)
        n = min(len(footrule), n_candidates + 1)
        chosen = np.flatnonzero(footrule <= np.partition(footrule, n - 1)[n - 1])
        rough = self.vectors[chosen] @ query
        if len(chosen) > k + 1:  # one more: the query's own vector may have no other row
            chosen = chosen[rough >= np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1] - 1e-9 * (1 + np.abs(rough).max())]
        exact = (self.vectors[chosen] * query).sum(axis=1)
        ids, scores = [], []
        for i, score in zip(chosen, exact):
            own = self.ids[self.bounds[i] : self.bounds[i + 1]]
            own = own[own != query_id][:k]  # of one score no more than k can be among the best
            ids.append(own)
            scores.append(np.full(len(own), score))
        found, score = np.concatenate(ids), np.concatenate(scores)
        best = np.lexsort((found, -score))[:k]
        return found[best], score[best]


def search(
    embeddings: DataFrame, query_every: int = 20, k: int = 20, n_pivots: int = 256, prefix: int = 64, share: float = 0.15, at_least: int = 400
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``query_every``, its ``k`` nearest found."""
    rows = vectors(embeddings)
    hashes = [r[0] for r in rows.select(F.xxhash64("v").alias("h")).distinct().orderBy("h").limit(n_pivots).collect()]
    pivots = np.array(sorted(r["v"] for r in rows.where(F.xxhash64("v").isin(hashes)).select("v").distinct().collect()), np.float64)
    stats = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    largest = float(np.sqrt(stats[1] or 1.0)) * (1 + 1e-12)
    pivots = completed(pivots, largest) if len(pivots) else np.zeros((0, 1))
    depth = min(prefix, len(pivots))
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    row_blocks = max(1, -(-stats[0] // BLOCK_ROWS))
    query_blocks = max(1, -(-stats[0] // (query_every * BLOCK_ROWS)))

    def dealt(to: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(to)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    all_rows = rows.select("vec_id", "v", dealt(row_blocks).alias("row_block"), every(query_blocks).alias("query_block"))
    queries = rows.where(is_query).select("vec_id", "v", every(row_blocks).alias("row_block"), dealt(query_blocks).alias("query_block"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            block = Block(left.column("vec_id").to_numpy(), matrix(left.column("v")), pivots, depth, largest)
            points = matrix(right.column("v"))
            unit = points / np.sqrt((points * points).sum(axis=1, keepdims=True))
            near = nearest_pivots(np.hstack([unit, np.zeros((len(unit), 1))]), pivots, depth)
            n_candidates = max(at_least, int(np.ceil(share * left.num_rows)))
            for i, query_id in enumerate(right.column("vec_id").to_pylist()):
                ids, scores = block.search(query_id, points[i], near[i], k, n_candidates)
                found.append((np.full(len(ids), query_id), ids, scores))
        q, v, s = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    keys = ("row_block", "query_block")
    met = all_rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
