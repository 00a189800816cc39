"""Temp views for SQL users: every batch analytic over one transactions frame.

``register_views(spark, tx)`` creates ``transactions`` plus one view per
analytic (``block_utilization``, ``most_active_pairs``, ...), so
``spark.sql("SELECT * FROM block_utilization WHERE utilization > 90")`` plans
through Catalyst exactly like the DataFrame call (views are lazy plans, not
materialised copies). Parameterised analytics use their defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlake import operators as ops

BATCH_VIEWS = {
    "unit_conversions": ops.unit_conversions,
    "avg_gas_price": ops.avg_gas_price,
    "avg_transaction_price": ops.avg_transaction_price,
    "biggest_transactions": ops.biggest_transactions,
    "address_transaction_volume": ops.address_transaction_volume,
    "failed_transaction_pct": ops.failed_transaction_pct,
    "transaction_status_counts": ops.transaction_status_counts,
    "avg_gas_used": ops.avg_gas_used,
    "contract_vs_transfer_pct": ops.contract_vs_transfer_pct,
    "block_utilization": ops.block_utilization,
    "hourly_activity": ops.hourly_activity,
    "gas_pricing": ops.gas_pricing,
    "most_active_pairs": ops.most_active_pairs,
    "gas_usage_by_address": ops.gas_usage_by_address,
    "address_activity": ops.address_activity,
    "hourly_gas_usage": ops.hourly_gas_usage,
    "cumulative_gas_in_hour": ops.cumulative_gas_in_hour,
    "fee_stats_by_type": ops.fee_stats_by_type,
    "transaction_category_counts": ops.transaction_category_counts,
    "categorize_transactions": ops.categorize_transactions,
}


def register_views(spark: SparkSession, tx: DataFrame, prefix: str = "") -> list[str]:
    """Create (or replace) the temp views; returns their names."""
    names = [f"{prefix}transactions"]
    tx.createOrReplaceTempView(names[0])
    if "last_modified" in tx.columns:
        ops.transaction_speed_by_gas_price(tx).createOrReplaceTempView(f"{prefix}transaction_speed_by_gas_price")
        names.append(f"{prefix}transaction_speed_by_gas_price")
    for name, fn in BATCH_VIEWS.items():
        fn(tx).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
