from txlake.functions.units import (  # noqa: F401
    exact_mean,
    exact_sum,
    percent,
    total_cost_wei,
    wei_to_eth,
    wei_to_eur,
    wei_to_gwei,
)
