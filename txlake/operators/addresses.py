"""Address-level analytics.

All are hash aggregations with map-side partial aggregation, so a hot
sender is combined inside each map task before the shuffle: a key holding a
third of all rows costs one row per task on the wire, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import exact_mean
from txlake.operators.common import top_k
from txlake.schema import FROM_ADDRESS, GAS, HASH, TO_ADDRESS


def address_transaction_volume(tx: DataFrame, n: int | None = None, method: str = "explode") -> DataFrame:
    """Appearances of each address as sender or receiver.

    A self-transfer counts twice and the NULL receiver (contract creation)
    is its own group, as with UNION ALL. ``method="explode"`` reads the two
    columns in one scan; ``"union"`` is the literal two-scan form.
    """
    if method == "union":
        addrs = tx.select(F.col(FROM_ADDRESS)).union(tx.select(F.col(TO_ADDRESS).alias(FROM_ADDRESS)))
    else:
        addrs = tx.select(F.explode(F.array(F.col(FROM_ADDRESS), F.col(TO_ADDRESS))).alias(FROM_ADDRESS))
    out = addrs.groupBy(FROM_ADDRESS).agg(F.count(F.lit(1)).alias("count"))
    return top_k(out, n, F.col("count").desc(), F.col(FROM_ADDRESS).asc_nulls_last())


def most_active_pairs(tx: DataFrame, n: int | None = None) -> DataFrame:
    """Transaction count per (sender, receiver)."""
    out = tx.groupBy(FROM_ADDRESS, TO_ADDRESS).agg(F.count(F.lit(1)).alias("total_transactions"))
    return top_k(out, n, F.col("total_transactions").desc(), F.col(FROM_ADDRESS), F.col(TO_ADDRESS))


def gas_usage_by_address(tx: DataFrame) -> DataFrame:
    """Mean / max / min gas per sender.

    Same rows as three whole-partition window aggregates plus DISTINCT, but
    as one hash aggregation: no full shuffle + sort of every row.
    """
    return tx.groupBy(FROM_ADDRESS).agg(
        exact_mean(GAS).alias("avg_gas_used"),
        F.max(GAS).alias("max_gas_used"),
        F.min(GAS).alias("min_gas_used"),
    )


def address_activity(tx: DataFrame, n: int | None = None) -> DataFrame:
    """Transactions (non-NULL hash) per sender."""
    out = tx.groupBy(FROM_ADDRESS).agg(F.count(HASH).alias("transaction_count"))
    return top_k(out, n, F.col("transaction_count").desc(), F.col(FROM_ADDRESS))
