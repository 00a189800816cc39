"""Real-time queries of the slides, streaming form (P01-P05 on event time).

``NOW() - frame .. NOW()`` becomes an event-time window of length ``frame``
(sliding by ``slide`` when given). A watermark bounds the state: in append
mode a window is emitted once, when ``window.end`` falls behind
``max(event time) - watermark``, and its state is dropped. Input must carry
``block_timestamp`` as ``timestamp`` (not ``timestamp_ntz``).

Sliding frames are made of panes, the longest windows of which every frame is a whole number (the slide, where it
divides the frame). A row is aggregated once, into its pane; finished panes, not rows, go into the frame / slide frames
that hold them, in a second aggregation. A row may come late by ``watermark``; a later one is dropped (and counted as
late) once its pane has closed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import exact_sum
from txlake.schema import (BLOCK_TIMESTAMP, FROM_ADDRESS, GAS_PRICE, HASH, INPUT, RECEIPT_GAS_USED, TO_ADDRESS,
                           VALUE)
from txlake.sources.poll import seconds

DEFAULT_WATERMARK = "10 minutes"

#: State partitions for keyless window aggregates (P01-P03): one state row per
#: open window, so this does not grow with the input.
KEYLESS_STATE_PARTITIONS = 8


def _framed(tx_stream: DataFrame, frame: str, slide: str | None, watermark: str, keys: list[str],
            sums: dict[str, Column]) -> DataFrame:
    """``window``, ``keys`` and ``sums`` (aggregates that add up over parts of a group) of every frame."""
    rows = tx_stream.withWatermark(BLOCK_TIMESTAMP, watermark)
    sums = [c.alias(name) for name, c in sums.items()], [F.sum(name).alias(name) for name in sums]
    if slide is None or seconds(slide) == seconds(frame):
        return rows.groupBy(F.window(BLOCK_TIMESTAMP, frame).alias("window"), *keys).agg(*sums[0])
    pane = f"{math.gcd(seconds(frame), seconds(slide))} seconds"
    panes = rows.groupBy(F.window(BLOCK_TIMESTAMP, pane).alias("pane"), *keys).agg(*sums[0])
    return panes.groupBy(F.window(F.window_time("pane"), frame, slide).alias("window"), *keys).agg(*sums[1])


def _mean_parts(c) -> dict[str, Column]:
    return {"_sum": exact_sum(c), "_known": F.count(c)}


def _mean() -> Column:
    return F.try_divide(F.col("_sum").cast("double"), F.col("_known").cast("double"))


def _bounds():
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def tx_count_stream(tx_stream: DataFrame, frame: str, slide: str | None = None,
                    watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """P01 stream: transactions per event-time window."""
    counts = {"transaction_count": F.count(F.lit(1))}
    return _framed(tx_stream, frame, slide, watermark, [], counts).select(*_bounds(), "transaction_count")


def gas_price_trend_stream(tx_stream: DataFrame, granularity: str, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """P02 stream: mean gas price per ``granularity`` window (sort only on read)."""
    return (_framed(tx_stream, granularity, None, watermark, [], _mean_parts(GAS_PRICE))
            .select(*_bounds(), _mean().alias("average_gas_price")))


def new_contracts_stream(tx_stream: DataFrame, frame: str, slide: str | None = None,
                         watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """P03 stream: contract creations and their mean gas used per window.

    All rows move the watermark, so a window closes with the next transaction
    of any kind, not only with a later creation.
    """
    created = F.col(TO_ADDRESS).isNull() & F.col(INPUT).isNotNull()
    rows = tx_stream.withColumn("_gas", F.when(created, F.col(RECEIPT_GAS_USED)))
    return (_framed(rows, frame, slide, watermark, [], {"contract_count": F.count_if(created), **_mean_parts("_gas")})
            .where(F.col("contract_count") > 0)
            .select(*_bounds(), "contract_count", _mean().alias("average_initial_gas_usage")))


def large_transfers_stream(tx_stream: DataFrame, threshold: float) -> DataFrame:
    """P04 stream: stateless filter, every large transfer emitted as it arrives."""
    return tx_stream.where(F.col(VALUE) > F.lit(float(threshold))).select(
        F.col(HASH).alias("transaction_id"), F.col(VALUE), F.col(BLOCK_TIMESTAMP))


def suspicious_activity_stream(tx_stream: DataFrame, frame: str, max_count: int, max_avg_gas_price: float,
                               slide: str | None = None, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """P05 stream: per window and (sender, receiver), HAVING count > t1 OR mean price > t2."""
    agg = (_framed(tx_stream, frame, slide, watermark, [FROM_ADDRESS, TO_ADDRESS],
                   {"transaction_count": F.count(F.lit(1)), **_mean_parts(GAS_PRICE)})
           .withColumn("average_gas_price", _mean()))
    return (agg.where((F.col("transaction_count") > F.lit(int(max_count)))
                      | (F.col("average_gas_price") > F.lit(float(max_avg_gas_price))))
            .select(*_bounds(), FROM_ADDRESS, TO_ADDRESS, "transaction_count", "average_gas_price"))


def dedup_transactions(tx_stream: DataFrame, watermark: str = "20 minutes", key: str = HASH,
                       time_col: str = BLOCK_TIMESTAMP) -> DataFrame:
    """Opt-in: drop replayed copies of a transaction seen within the watermark delay.

    The poller's frames overlap, so most transactions arrive twice; the
    delay must exceed that overlap.
    """
    return tx_stream.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key])
