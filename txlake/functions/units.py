"""Column expressions for unit conversion and exact aggregation.

All helpers return ``Column`` objects built from JVM-side functions, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.schema import EUR_PER_ETH, WEI_PER_ETH, WEI_PER_GWEI


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wei_to_gwei(c) -> Column:
    return _c(c) / F.lit(WEI_PER_GWEI)


def wei_to_eth(c) -> Column:
    return _c(c) / F.lit(WEI_PER_ETH)


def wei_to_eur(c, eur_rate: float = EUR_PER_ETH) -> Column:
    # (x / 1e18) * rate, in this order: the two steps are not folded, so the
    # rounding of each step is the reference's.
    return (_c(c) / F.lit(WEI_PER_ETH)) * F.lit(float(eur_rate))


def total_cost_wei(gas="gas", gas_price="gas_price") -> Column:
    """gas * gas_price, exact: decimal(38,0) never wraps nor raises for on-chain ranges."""
    return (_c(gas).cast("decimal(20,0)") * _c(gas_price).cast("decimal(20,0)")).cast("decimal(38,0)")


#: Low bits kept apart by :func:`exact_sum`.
_LOW_BITS = 20


def exact_sum(c) -> Column:
    """Exact sum of an integral column, as decimal(38,0).

    Each value is split as ``x = (x >> 20) * 2^20 + (x & (2^20 - 1))`` (exact
    in two's complement, negatives included) and both parts are summed as
    ``bigint``: primitive adds in the map-side partial aggregation (a
    decimal(38,0) sum runs on BigDecimal and is ~5x slower per row). The low
    sum stays below 2^63 up to 2^43 rows, the high sum while
    sum(|x|) < 2^83; past that ANSI mode raises instead of wrapping.
    The parts are combined once per group in decimal.
    """
    x = _c(c).cast("long")
    high = F.sum(F.shiftright(x, _LOW_BITS)).cast("decimal(38,0)")
    low = F.sum(x.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(38,0)")
    return high * F.lit(1 << _LOW_BITS).cast("decimal(38,0)") + low


def exact_mean(c) -> Column:
    """Mean of an integral column as double.

    The sum is exact, so the result does not depend on how rows are spread
    over partitions, unlike a floating-point running sum.
    """
    return F.try_divide(exact_sum(c).cast("double"), F.count(_c(c)).cast("double"))


def percent(part: Column, total: Column, digits: int = 4) -> Column:
    """round(part / total * 100, digits); NULL when total is 0 or NULL."""
    return F.round(F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0), digits)


def floored(a: Column, b: int) -> Column:
    """floor(a / b) of whole numbers, without the rounding of a double."""
    return F.call_function("div", a - F.pmod(a, F.lit(b).cast("long")), F.lit(b).cast("long"))
