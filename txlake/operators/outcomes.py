"""Status, call-data category and fee statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import exact_mean, percent
from txlake.schema import (CONTRACT_INTERACTION, EMPTY_CALL_DATA, GAS, GAS_PRICE, INPUT, MAX_FEE_PER_GAS,
                           RECEIPT_GAS_USED, RECEIPT_STATUS, SIMPLE_TRANSFER, TRANSACTION_TYPE)


def failed_transaction_pct(tx: DataFrame) -> DataFrame:
    """Share of failed transactions (status 0) among status 0 and 1, in percent.

    One pass with conditional counts keyed by the status value (not by the
    order in which groups come back).
    """
    status = F.col(RECEIPT_STATUS)
    failed = F.count_if(status == F.lit(0))
    success = F.count_if(status == F.lit(1))
    return tx.agg(
        percent(failed, failed + success).alias("failed_pct"),
        failed.alias("failed_count"),
        success.alias("success_count"),
    )


def transaction_status_counts(tx: DataFrame) -> DataFrame:
    """Rows per receipt status."""
    return tx.groupBy(RECEIPT_STATUS).agg(F.count(F.lit(1)).alias("count"))


def avg_gas_used(tx: DataFrame) -> DataFrame:
    """Mean gas supplied per transaction, rounded to 2 places (one row)."""
    return tx.agg(F.round(exact_mean(GAS), 2).alias("avg_gas"))


def contract_vs_transfer_pct(tx: DataFrame) -> DataFrame:
    """Percent of contract calls (input != '0x') vs plain transfers (input = '0x').

    Both counts come from one scan; NULL input is in neither.
    """
    inp = F.col(INPUT)
    contract = F.count_if(inp != F.lit(EMPTY_CALL_DATA))
    simple = F.count_if(inp == F.lit(EMPTY_CALL_DATA))
    return tx.agg(
        percent(contract, contract + simple).alias("contract_interaction_pct"),
        percent(simple, contract + simple).alias("simple_transfer_pct"),
    )


def _category() -> F.Column:
    return (F.when(F.col(INPUT) == F.lit(EMPTY_CALL_DATA), F.lit(SIMPLE_TRANSFER))
            .otherwise(F.lit(CONTRACT_INTERACTION)))


def categorize_transactions(tx: DataFrame) -> DataFrame:
    """Every row plus ``type``; NULL input counts as a contract interaction."""
    return tx.withColumn("type", _category())


def transaction_category_counts(tx: DataFrame) -> DataFrame:
    """Rows per category."""
    return tx.select(_category().alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("count"))


def fee_stats_by_type(tx: DataFrame) -> DataFrame:
    """Gas used, gas price and max fee statistics per transaction type.

    ``efficiency_ratio = avg_gas_used / avg_gas_price`` is NULL when the
    mean price is 0 or NULL (no division error).
    """
    agg = tx.groupBy(TRANSACTION_TYPE).agg(
        exact_mean(RECEIPT_GAS_USED).alias("avg_gas_used"),
        F.max(RECEIPT_GAS_USED).alias("max_gas_used"),
        F.min(RECEIPT_GAS_USED).alias("min_gas_used"),
        exact_mean(GAS_PRICE).alias("avg_gas_price"),
        F.max(GAS_PRICE).alias("max_gas_price"),
        F.min(GAS_PRICE).alias("min_gas_price"),
        exact_mean(MAX_FEE_PER_GAS).alias("avg_fee"),
        F.max(MAX_FEE_PER_GAS).alias("max_fee"),
        F.min(MAX_FEE_PER_GAS).alias("min_fee"),
    )
    return agg.withColumn("efficiency_ratio", F.try_divide(F.col("avg_gas_used"), F.col("avg_gas_price")))
