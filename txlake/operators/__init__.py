"""Batch analytics: pure functions ``f(tx: DataFrame, ...) -> DataFrame``."""

from txlake.operators.addresses import (  # noqa: F401
    address_activity,
    address_transaction_volume,
    gas_usage_by_address,
    most_active_pairs,
)
from txlake.operators.blocks import (  # noqa: F401
    block_utilization,
    cumulative_gas_in_hour,
    cumulative_gas_in_hour_window,
    hourly_activity,
    hourly_gas_usage,
)
from txlake.operators.expand import repeat_rows  # noqa: F401
from txlake.operators.outcomes import (  # noqa: F401
    avg_gas_used,
    categorize_transactions,
    contract_vs_transfer_pct,
    failed_transaction_pct,
    fee_stats_by_type,
    transaction_category_counts,
    transaction_status_counts,
)
from txlake.operators.pricing import (  # noqa: F401
    avg_gas_price,
    avg_transaction_price,
    biggest_transactions,
    gas_pricing,
    transaction_speed_by_gas_price,
    unit_conversions,
)
