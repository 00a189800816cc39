"""Fee and value pricing analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import exact_mean, total_cost_wei, wei_to_eth, wei_to_eur, wei_to_gwei
from txlake.operators.common import top_k
from txlake.schema import (BLOCK_TIMESTAMP, EUR_PER_ETH, GAS, GAS_PRICE, HASH, LAST_MODIFIED, TOP_N,
                           VALUE, WEI_PER_ETH)


def unit_conversions(tx: DataFrame, eur_rate: float = EUR_PER_ETH) -> DataFrame:
    """Per-transaction gas price in gwei/ETH/EUR, fee in EUR, value in ETH/EUR."""
    price_eur = wei_to_eur(GAS_PRICE, eur_rate)
    return tx.select(
        F.col(GAS), F.col(GAS_PRICE), F.col(VALUE),
        wei_to_gwei(GAS_PRICE).alias("gas_price_gwei"),
        wei_to_eth(GAS_PRICE).alias("gas_price_eth"),
        price_eur.alias("gas_price_euro"),
        F.round(price_eur * F.col(GAS), 2).alias("gas_price_total_units_euro"),
        wei_to_eth(VALUE).alias("eth_transfered"),
        wei_to_eur(VALUE, eur_rate).alias("euro_transfered"),
    )


def avg_gas_price(tx: DataFrame) -> DataFrame:
    """Mean gas price in gwei (one row)."""
    return tx.agg((exact_mean(GAS_PRICE) / F.lit(1e9)).alias("avg_gas_price_gwei"))


def avg_transaction_price(tx: DataFrame, eur_rate: float = EUR_PER_ETH) -> DataFrame:
    """Mean fee (gas * gas price) in EUR (one row).

    The fee in wei is summed exactly (decimal) and converted once, so the
    result is independent of partitioning.
    """
    cost = total_cost_wei(GAS, GAS_PRICE)
    mean_wei = F.try_divide(F.sum(cost).cast("double"), F.count(cost).cast("double"))
    return tx.agg((mean_wei / F.lit(WEI_PER_ETH) * F.lit(float(eur_rate))).alias("avg_transaction_price_euro"))


def biggest_transactions(tx: DataFrame, eur_rate: float = EUR_PER_ETH, n: int | None = TOP_N) -> DataFrame:
    """Value-carrying transactions ranked by fee in EUR (top ``n``; ties by hash).

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each task keeps its
    own n best rows, only n x tasks rows reach the final merge.
    """
    price_eur = wei_to_eur(GAS_PRICE, eur_rate)
    df = tx.where(F.col(VALUE) != F.lit(0.0)).select(
        F.col(HASH), F.col(GAS_PRICE), F.col(GAS), F.col(VALUE),
        wei_to_gwei(GAS_PRICE).alias("gas_price_gwei"),
        wei_to_eth(GAS_PRICE).alias("gas_price_eth"),
        price_eur.alias("gas_price_euro"),
        (F.col(GAS) * price_eur).alias("total_price_euro"),
        wei_to_eur(VALUE, eur_rate).alias("value_euro"),
    )
    return top_k(df, n, F.col("total_price_euro").desc(), F.col(HASH).asc())


def gas_pricing(tx: DataFrame, eur_rate: float = EUR_PER_ETH, sort: bool = False) -> DataFrame:
    """Total gas cost per transaction in wei (exact decimal), gwei, ETH, EUR.

    Sorting 100 TB globally only to write it to an unordered sink is wasted
    work, so the sort (range exchange) is opt-in.
    """
    cost = total_cost_wei(GAS, GAS_PRICE)
    df = tx.select(
        F.col(HASH), F.col(GAS), F.col(GAS_PRICE),
        cost.alias("total_gas_cost_wei"),
        (cost.cast("double") / F.lit(1e9)).alias("gas_price_gwei"),
        (cost.cast("double") / F.lit(WEI_PER_ETH)).alias("gas_price_eth"),
        (cost.cast("double") / F.lit(WEI_PER_ETH) * F.lit(float(eur_rate))).alias("gas_price_euro"),
    )
    return df.orderBy(F.col("gas_price_euro").desc(), F.col(HASH)) if sort else df


def transaction_speed_by_gas_price(tx: DataFrame, end_col: str = LAST_MODIFIED,
                                   start_col: str = BLOCK_TIMESTAMP) -> DataFrame:
    """Mean seconds between ``start_col`` and ``end_col`` per gas price (gwei).

    Grouped on the integral ``gas_price`` (exact keys), gwei derived after the
    aggregation; the duration is integral, so its mean is exact.
    """
    dur = (F.unix_seconds(F.col(end_col).cast("timestamp"))
           - F.unix_seconds(F.col(start_col).cast("timestamp"))).alias("d")
    return (tx.select(F.col(GAS_PRICE), dur)
            .groupBy(GAS_PRICE)
            .agg(exact_mean("d").alias("average_duration"))
            .select(wei_to_gwei(GAS_PRICE).alias("gas_price_gwei"), "average_duration"))
