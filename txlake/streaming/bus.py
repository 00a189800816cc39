"""The real-time queries over the bus (P01, P02, P05), and P02's view with the newest window first.

Messages are decoded once: one query lands the transactions of the bus, each once, in a folder, from which any number
of stateful queries read the event time and the columns that an envelope carries. The folder is written by Spark's file
sink, whose log lets later streams see each finished batch whole and once.

Null, blank and undecodable messages bring no transaction; one without a block time (or with a malformed one) is landed
and left out of all windows; values that are no whole number of wei are rounded down to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txlake.schema import BLOCK_TIMESTAMP, FROM_ADDRESS, GAS, GAS_PRICE, HASH, NONCE, TO_ADDRESS, TX_SCHEMA
from txlake.sources.commits import OVERWRITE, CommitLog
from txlake.sources.envelope import decode_envelope, packed_text, unpacked_text
from txlake.sources.poll import seconds
from txlake.streaming import eventtime as et
from txlake.streaming.runner import ROCKSDB, distinct_transactions, start_with, state_width, watch

#: What an envelope carries of a transaction, under the names of the transaction table.
BUS_SCHEMA = T.StructType([TX_SCHEMA[c] for c in (HASH, NONCE, FROM_ADDRESS, TO_ADDRESS, GAS, GAS_PRICE, BLOCK_TIMESTAMP)])
GAS_PRICE_VIEW = "gas_price_view"

#: Queries that need nothing else than :data:`BUS_SCHEMA`.
BUS_MONITORS: dict[str, Callable[..., DataFrame]] = {
    "tx_count": et.tx_count_stream,
    "gas_price_trend": et.gas_price_trend_stream,
    "suspicious_activity": et.suspicious_activity_stream,
}


def bus_transactions(raw: DataFrame, dedup: str | None = None) -> DataFrame:
    """The transactions of raw messages in the columns of :data:`BUS_SCHEMA`.

    The poller's frames overlap: with ``dedup`` (a time, at least the overlap and the time between two polls) each comes once.
    """
    decoded = decode_envelope(raw)
    t = "transaction."
    # JSON numbers are doubles; one beyond a bigint becomes null.
    found = {
        HASH: F.col(t + "hash"), NONCE: F.col(t + "nonce"), FROM_ADDRESS: F.col(t + "sender.address"),
        TO_ADDRESS: F.col(t + "to.address"), GAS: F.col(t + "gas").try_cast("long"),
        GAS_PRICE: F.col(t + "gasPrice").try_cast("long"),
        BLOCK_TIMESTAMP: F.try_to_timestamp(t + "block.timestamp.iso8601"),
    }
    if not dedup:
        rows = decoded.select(F.explode("data.data.ethereum.transactions").alias("transaction")).where("transaction is not null")
        return rows.select(*[found[f.name].alias(f.name) for f in BUS_SCHEMA])
    # Only what is landed is shuffled by the key: addresses as bytes, and the hash as the key that it is.
    addresses = (FROM_ADDRESS, TO_ADDRESS)
    carried = [(packed_text(c) if name in addresses else c.isNotNull() if name == HASH else c).alias(name) for name, c in found.items()]
    rows = distinct_transactions(decoded, dedup, carried=carried, key="_key")
    back = {**{name: F.col(name) for name in found}, **{name: unpacked_text(F.col(name)) for name in addresses}, HASH: F.when(F.col(HASH), F.col("_key"))}
    return rows.select(*[back[f.name].alias(f.name) for f in BUS_SCHEMA])


def land_bus(raw: DataFrame, path: str, checkpoint: str, dedup: str | None = None, trigger: dict | None = None,
             state_partitions: int | None = None, compression: str = "zstd") -> StreamingQuery:
    """Starts the query that decodes the bus into ``path``."""
    watch(raw.sparkSession)
    w = (bus_transactions(raw, dedup).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path).option("compression", compression))
    if trigger:
        w = w.trigger(**trigger)
    return start_with(w, raw.sparkSession, {**(ROCKSDB if dedup else {}), **state_width(state_partitions)})


def read_bus_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """The landed transactions as a stream: input of the monitors."""
    return spark.readStream.schema(BUS_SCHEMA).options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_bus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BUS_SCHEMA).parquet(path)


def _newest_first(base: str, frame: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback that merges changed windows into the view."""

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        log = CommitLog(spark, base)
        if log.is_committed(int(batch_id)):
            return
        changed = changed.persist()
        try:
            if changed.isEmpty():
                return
            before = log.read(GAS_PRICE_VIEW, changed.schema).join(changed.select("window_start"), "window_start", "left_anti")
            windows = before.unionByName(changed)
            newest = windows.agg(F.max("window_start")).first()[0]
            kept = windows.where(F.col("window_start") > F.lit(newest) - F.expr(f"INTERVAL {seconds(frame)} SECONDS"))
            # At most frame / granularity rows, so one file holds them in order.
            ordered = kept.repartition(1).sortWithinPartitions(F.desc("window_start"))
            log.commit(int(batch_id), {GAS_PRICE_VIEW: log.stage(ordered, GAS_PRICE_VIEW, int(batch_id))}, OVERWRITE)
        finally:
            changed.unpersist()

    return write


def run_gas_price_view(tx_stream: DataFrame, base: str, checkpoint: str, granularity: str = "1 minute", frame: str = "1 hour",
                       watermark: str = et.DEFAULT_WATERMARK, trigger: dict | None = None) -> StreamingQuery:
    """P02 as the slides show it: the mean gas price of the windows of the last ``frame``, newest first, open ones included.

    Each batch merges the windows that it changed into the view and commits it whole; windows that end up ``frame`` or
    more behind the newest leave it. Readers see one state of it (:func:`read_gas_price_view`).
    """
    if seconds(frame) < seconds(granularity):
        raise ValueError("the frame must hold a window")
    spark = tx_stream.sparkSession
    watch(spark)
    w = (et.gas_price_trend_stream(tx_stream, granularity, watermark).writeStream.outputMode("update")
         .foreachBatch(_newest_first(base, frame)).option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return start_with(w, spark, state_width(et.KEYLESS_STATE_PARTITIONS))


def read_gas_price_view(spark: SparkSession, base: str) -> DataFrame:
    """window_start, window_end, average_gas_price, newest first as they were written: nothing is sorted."""
    schema = "window_start timestamp, window_end timestamp, average_gas_price double"
    return CommitLog(spark, base).read(GAS_PRICE_VIEW, schema)
