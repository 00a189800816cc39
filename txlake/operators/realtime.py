"""Real-time queries of the slides, batch form.

``NOW()`` becomes the explicit ``as_of`` timestamp; ``BETWEEN`` is inclusive
at both ends. The frame also bounds the ``date`` partition column, so a scan
of the lake only lists the partitions of the frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import exact_mean
from txlake.schema import (BLOCK_TIMESTAMP, DATE, FROM_ADDRESS, GAS_PRICE, HASH, INPUT, RECEIPT_GAS_USED,
                           TO_ADDRESS, VALUE)


def _interval(frame: str):
    return F.expr(f"INTERVAL '{frame}'")


def in_frame(tx: DataFrame, as_of, frame: str) -> DataFrame:
    """Rows with ``as_of - frame <= block_timestamp <= as_of``."""
    hi = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    lo = hi - _interval(frame)
    ts = F.col(BLOCK_TIMESTAMP)
    out = tx.where(ts.between(lo, hi))
    if DATE in tx.columns:
        # ``date`` is a UTC day and the bounds are written in the session's zone: a day more on
        # either side prunes as well and loses no row; the exact filter is the one above.
        d, day = F.col(DATE), F.expr("INTERVAL '1 day'")
        out = out.where(d.isNull() | d.between(F.date_format(lo - day, "yyyy-MM-dd"), F.date_format(hi + day, "yyyy-MM-dd")))
    return out


def tx_count_in_frame(tx: DataFrame, as_of, frame: str) -> DataFrame:
    """Number of transactions in the last ``frame``."""
    return in_frame(tx, as_of, frame).agg(F.count(F.lit(1)).alias("transaction_count"))


def gas_price_trend(tx: DataFrame, as_of, frame: str, granularity: str | None = None,
                    sort: bool = False) -> DataFrame:
    """Mean gas price per block timestamp (or per ``granularity`` bucket) in the frame."""
    rows = in_frame(tx, as_of, frame)
    if granularity is None:
        out = rows.groupBy(BLOCK_TIMESTAMP).agg(exact_mean(GAS_PRICE).alias("average_gas_price"))
    else:
        out = (rows.groupBy(F.window(BLOCK_TIMESTAMP, granularity).start.alias(BLOCK_TIMESTAMP))
               .agg(exact_mean(GAS_PRICE).alias("average_gas_price")))
    return out.orderBy(F.col(BLOCK_TIMESTAMP).desc()) if sort else out


def new_contracts(tx: DataFrame, as_of, frame: str) -> DataFrame:
    """Contract creations (no receiver, some input) and their mean gas used."""
    rows = in_frame(tx, as_of, frame).where(F.col(TO_ADDRESS).isNull() & F.col(INPUT).isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("contract_count"),
                    exact_mean(RECEIPT_GAS_USED).alias("average_initial_gas_usage"))


def large_transfers(tx: DataFrame, threshold: float, as_of, frame: str = "1 minute") -> DataFrame:
    """Transactions moving more than ``threshold`` wei in the frame."""
    rows = in_frame(tx, as_of, frame).where(F.col(VALUE) > F.lit(float(threshold)))
    return rows.select(F.col(HASH).alias("transaction_id"), F.col(VALUE))


def suspicious_activity(tx: DataFrame, as_of, frame: str, max_count: int, max_avg_gas_price: float) -> DataFrame:
    """(sender, receiver) pairs with more than ``max_count`` transactions or a
    mean gas price above ``max_avg_gas_price`` in the frame (HAVING ... OR ...)."""
    agg = (in_frame(tx, as_of, frame).groupBy(FROM_ADDRESS, TO_ADDRESS)
           .agg(F.count(F.lit(1)).alias("transaction_count"), exact_mean(GAS_PRICE).alias("average_gas_price")))
    return agg.where((F.col("transaction_count") > F.lit(int(max_count)))
                     | (F.col("average_gas_price") > F.lit(float(max_avg_gas_price))))
