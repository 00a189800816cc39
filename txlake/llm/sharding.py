"""Shards of near-equal size by vector bin packing.

Groups of equal texts have a vector of bytes, tokens (words) and rows. Groups above a small share of a shard are
items of their own, cut into parts by doc_id only when larger than ``WHOLE`` of a shard; the others are dealt by hash into bundles. So the number
of items is bounded by ``n_shards * GRAIN``, whatever the number of documents, and they are placed on the driver,
largest first, each on the shard where the dot product of its vector with the residual capacity is highest, among
the shards that are least filled in bytes once an item no longer fits everywhere. The law is ``bytes``: sums of
sizes are as near to each other as the smallest items allow.

Defined cases: a null text counts as empty (but for the text itself); a null doc_id is placed like any other value;
repeated rows are separate rows of one group; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored, width
from .textops import slices, text_buffer, word_spans

#: Items of a shard: bundles and the parts of a cut group are at most about one part in GRAIN of a shard, unless one document is larger.
GRAIN = 500
#: The share of a shard up to which a group of equal texts stays whole.
WHOLE = 0.5
ROW_BYTES = 16


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, tokens and the digest of the text; one pass, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offs = text_buffer(part.column("text"))
            raw, bounds = memoryview(data.tobytes()), offs.tolist()
            texts = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
            _, _, first = word_spans(data, offs)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(offs) + ROW_BYTES),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                    pa.array(np.diff(first)),
                    pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                ],
                ["doc_id", "size", "text_crc32", "tokens", "digest"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, size long, text_crc32 long, tokens long, digest binary"
    )


def placed(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of every item (bytes, tokens, rows)."""
    share = vectors / np.maximum(vectors.sum(axis=0), 1) * n_shards
    residual = np.ones((n_shards, share.shape[1]))
    shard = np.zeros(len(share), np.int64)
    for i in np.argsort(-vectors[:, 0], kind="stable"):
        item = share[i]
        # Where the item fits into what the byte law leaves; past that, the shards with most room for bytes.
        open_ = residual[:, 0] >= min(item[0], residual[:, 0].max())
        score = np.where(open_, residual @ item, -np.inf)
        shard[i] = best = int(np.argmax(score))
        residual[best] -= item
    return shard


def shards(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in its shard), grown_shard (null under this law)."""
    rows = stored(sized(docs))
    n_items = n_shards * GRAIN
    unit = max(1, (rows.agg(F.sum("size")).first()[0] or 0) // n_items)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("__bytes")).where(F.col("__bytes") > unit)
    parts = F.when(F.col("__bytes") <= WHOLE * GRAIN * unit, 1).otherwise(F.ceil(F.col("__bytes") / unit))
    # At most n_items groups are larger than the unit: the broadcast is bounded.
    large = F.broadcast(groups.select(F.col("digest").alias("__large"), parts.alias("__parts")))
    item = F.when(
        F.col("__large").isNotNull(), F.concat_ws("/", F.hex("digest"), F.pmod(F.xxhash64("doc_id"), F.col("__parts")).cast("string"))
    ).otherwise(F.pmod(F.xxhash64("digest"), F.lit(n_items)).cast("string"))
    itemized = rows.join(large, F.col("digest") == F.col("__large"), "left").withColumn("__item", item).drop("__large", "__parts")

    found = itemized.groupBy("__item").agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).orderBy("__item").collect()
    vectors = np.array([tuple(r)[1:] for r in found], np.float64).reshape(-1, 3)
    where = [(r[0], int(k)) for r, k in zip(found, placed(vectors, n_shards))]
    spark = docs.sparkSession
    # One row per item, so at most 3 * n_items rows.
    where = F.broadcast(spark.createDataFrame(where, "__placed string, shard int"))
    dealt = itemized.join(where, F.col("__item") == F.col("__placed")).drop("__item", "__placed", "tokens")
    return numbered(dealt, "shard", ["doc_id", "digest"], "slot", width(rows)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
