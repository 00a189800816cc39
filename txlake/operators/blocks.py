"""Block and hour level gas analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.operators.common import top_k
from txlake.operators.expand import repeat_rows
from txlake.operators.prefix import running_sum, split_crowded
from txlake.schema import (BLOCK_GAS_LIMIT, BLOCK_NUMBER, BLOCK_TIMESTAMP, HASH, RECEIPT_CUMULATIVE_GAS_USED,
                           RECEIPT_GAS_USED)


def block_utilization(tx: DataFrame, gas_limit: int = BLOCK_GAS_LIMIT,
                      min_utilization: float | None = None) -> DataFrame:
    """Gas used per block and its percentage of the block gas limit.

    A block's sum is bounded by the gas limit, so ``bigint`` cannot overflow.
    ``min_utilization`` (percent) keeps only blocks at or above it.
    """
    out = (tx.groupBy(BLOCK_NUMBER)
           .agg(F.sum(RECEIPT_GAS_USED).alias("total_gas_used"))
           .withColumn("utilization", F.col("total_gas_used") / F.lit(int(gas_limit)) * F.lit(100)))
    if min_utilization is not None:
        out = out.where(F.col("utilization") >= F.lit(float(min_utilization)))
    return out


def hourly_activity(tx: DataFrame, n: int | None = None) -> DataFrame:
    """Transactions per hour of day (session time zone, UTC by default)."""
    out = (tx.select(F.hour(BLOCK_TIMESTAMP).alias("hour"))
           .groupBy("hour").agg(F.count(F.lit(1)).alias("num_transactions")))
    return top_k(out, n, F.col("num_transactions").desc(), F.col("hour"))


def cumulative_gas_in_hour(tx: DataFrame, column: str = RECEIPT_CUMULATIVE_GAS_USED, collapse_copies: bool = False,
                           split_rows: int | None = None) -> DataFrame:
    """Running sum of ``column`` within each (date, hour), ordered by
    ``(block_timestamp, hash)``, one output row per transaction.

    A plain window partitioned by (date, hour) sends a whole hour to one task.
    Here rows get their running sum inside a bucket, by default their minute, and the sums of the
    buckets before it as offsets (:func:`running_sum`); rows are shuffled once. A minute with more than
    ``split_rows`` rows is cut into its instants, and those by the first digits of the hash, so that even
    rows of a single second spread over tasks. Where replays deliver the same transactions many times,
    ``collapse_copies`` first collapses exact copies to one row with a count
    and expands them again at the end.
    """
    ts = F.col(BLOCK_TIMESTAMP)
    # Keys are never NULL, so the join is a plain equi-join. Rows without a block time form their own
    # group through the impossible hour -1, like the (NULL, NULL) window partition.
    hour, minute = ["_day", "_hr"], ["_min"]
    rows = tx.select(
        F.coalesce(F.to_date(ts), F.lit("1970-01-01").cast("date")).alias("_day"),
        F.coalesce(F.hour(ts), F.lit(-1)).alias("_hr"),
        F.coalesce(F.minute(ts), F.lit(0)).alias("_min"),
        ts.alias("_ts"), F.col(HASH), F.col(column).cast("long").alias("_v"))
    rows = rows.groupBy(*hour, *minute, "_ts", HASH, "_v").agg(F.count(F.lit(1)).alias("_c")) if collapse_copies \
        else rows.withColumn("_c", F.lit(1).cast("long"))
    rows = split_crowded(rows, [*hour, *minute], HASH, split_rows)
    # The instants of a minute that was not cut are one.
    instant = F.when(F.col("_crowded"), F.unix_micros("_ts"))
    rows = rows.withColumn("_instant", F.coalesce(instant, F.lit(0).cast("long")))
    order = ["_ts", F.col(HASH).asc_nulls_first(), F.col("_v").asc_nulls_first()]
    summed = running_sum(rows, hour, [minute, ["_instant", "_part"]], order, F.col("_v") * F.col("_c"), "_total")

    out = summed.select(HASH, F.col("_ts").alias(BLOCK_TIMESTAMP), F.when(F.col("_hr") >= 0, F.col("_hr")).alias("hour"),
                        "_v", "_c", "_total")
    if not collapse_copies:
        return out.select(HASH, BLOCK_TIMESTAMP, "hour", F.col("_total").alias("cumulative_gas_used"))
    # ``_total`` is the running total with all copies of the row.
    later = F.coalesce(F.col("_v") * (F.col("_c") - F.col("_k")), F.lit(0).cast("long"))
    return repeat_rows(out.withColumn("_n", F.col("_c")), "_n", "_k").select(
        HASH, BLOCK_TIMESTAMP, "hour", (F.col("_total") - later).alias("cumulative_gas_used"))


def cumulative_gas_in_hour_window(tx: DataFrame, column: str = RECEIPT_CUMULATIVE_GAS_USED) -> DataFrame:
    """B16b, literal form: one window per (date, hour). Kept for equivalence tests."""
    ts = F.col(BLOCK_TIMESTAMP)
    w = (Window.partitionBy(F.to_date(ts), F.hour(ts)).orderBy(ts, F.col(HASH))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return tx.select(HASH, BLOCK_TIMESTAMP, F.hour(ts).alias("hour"),
                     F.sum(F.col(column).cast("long")).over(w).alias("cumulative_gas_used"))


def hourly_gas_usage(tx: DataFrame, column: str = RECEIPT_CUMULATIVE_GAS_USED,
                     assume_non_negative: bool = True) -> DataFrame:
    """Per hour of day, the largest (date, hour) running total of ``column``.

    For non-negative input a running sum peaks at its last row, so the peak
    is the (date, hour) group sum: two small hash aggregations instead of a
    sorted window over every row. Gas amounts are non-negative by definition;
    the same aggregation carries each group's minimum and the query fails
    (instead of answering wrongly) if a negative value ever appears.
    ``assume_non_negative=False`` takes the exact running-sum path.
    """
    if assume_non_negative:
        ts = F.col(BLOCK_TIMESTAMP)
        per_hour = (tx.select(F.to_date(ts).alias("_day"), F.hour(ts).alias("hour"), F.col(column))
                    .groupBy("_day", "hour").agg(F.sum(column).alias("_total"), F.min(column).alias("_min")))
        ok = (F.col("_min") >= F.lit(0)) | F.col("_min").isNull()
        checked = per_hour.select("hour", F.when(
            F.assert_true(ok, F.lit(f"negative {column}: use assume_non_negative=False")).isNull(),
            F.col("_total")).alias("_total"))
        return checked.groupBy("hour").agg(F.max("_total").alias("total_gas_used"))
    return (cumulative_gas_in_hour(tx, column)
            .groupBy("hour").agg(F.max("cumulative_gas_used").alias("total_gas_used")))
