"""Per-micro-batch analytics R01-R05 over exploded envelope rows (column ``transaction``).

The reference writes them as window functions. Windows partitioned by a
transaction type, a hash or a sender put one whole group into one task, and
an unpartitioned window puts the whole batch into one task. Each output
here only depends on per-group facts, so those facts come from a hash
aggregation (map-side combine) and rows are replicated back to their
original multiplicity with :func:`repeat_rows`: same output rows, no group
sorted in one task. The literal window forms are kept for equivalence tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.functions.units import exact_mean
from txlake.operators.expand import repeat_rows
from txlake.operators.prefix import log_scale, running_sum, value_bins
from txlake.schema import DEFAULT_TX_TYPE

T = "transaction."


def _type_label(raw):
    # Empty and missing types are shown as 2; the string type is kept (no cast to int).
    return F.when(raw != F.lit(""), raw).otherwise(F.lit(DEFAULT_TX_TYPE))


def rt_transaction_type_count(batch: DataFrame) -> DataFrame:
    """``row_number()`` within each raw ``txType`` ordered by hash, labelled
    by the display type. '' , NULL and '2' are separate groups that all show
    as '2', so numbers repeat under that label.

    Group of n rows -> numbers 1..n: count per raw type, then generate.
    """
    counts = (batch.select(F.col(T + "txType").alias("_raw"))
              .groupBy("_raw").agg(F.count(F.lit(1)).alias("_n"))
              .select(_type_label(F.col("_raw")).alias("txType"), "_raw", "_n"))
    return repeat_rows(counts, "_n", "running_count").select("txType", "running_count")


def rt_transaction_type_count_window(batch: DataFrame) -> DataFrame:
    w = Window.partitionBy(T + "txType").orderBy(T + "hash")
    return batch.select(_type_label(F.col(T + "txType")).alias("txType"),
                        F.row_number().over(w).cast("long").alias("running_count"))


def rt_average_gas(batch: DataFrame) -> DataFrame:
    """Mean gas and gas price of the batch (one row)."""
    return batch.agg(F.avg(T + "gas").alias("average_gas"), F.avg(T + "gasPrice").alias("average_gas_price"))


def rt_transactions_value(batch: DataFrame, partition_by: str = "hash", top: int | None = None,
                          split_rows: int | None = None) -> DataFrame:
    """``rank()`` by ``gasValue`` descending within ``partition_by`` (default: the hash).

    rank = 1 + number of rows of the group with a larger value. Rows are
    first reduced to (group, value, count), the rank is a running count over
    those few distinct values, then rows are replicated back. ``top`` keeps
    ranks <= top. With the default key (the hash) a group's distinct values
    are the versions of one transaction, so the rank window is tiny; with a
    coarser ``partition_by`` (e.g. the sender) a group with more than ``split_rows`` distinct values
    is cut by a histogram of its values, twice, and counts of the bins above are added: no window holds the group.
    """
    pairs = batch.select(F.col(T + "hash").alias("hash"), F.col(T + "gasValue").alias("gasValue"))
    if partition_by in ("hash", T + "hash"):
        # (hash, value) rows are unique after the aggregation: rank them directly, no join back. Dealt by the hash
        # alone, the rows are shuffled once for the aggregation and the ranks.
        grouped = pairs.repartition("hash").groupBy("hash", "gasValue").agg(F.count(F.lit(1)).alias("_c"))
        w = (Window.partitionBy("hash").orderBy(F.col("gasValue").desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
        ranked = grouped.select("hash", "gasValue", "_c",
                                (F.coalesce(F.sum("_c").over(w), F.lit(0)) + 1).alias("gas_value_rank"))
        if top is not None:
            ranked = ranked.where(F.col("gas_value_rank") <= F.lit(int(top)))
        return repeat_rows(ranked, "_c").select("hash", "gasValue", "gas_value_rank")
    key = F.col(partition_by if partition_by.startswith(T) else T + partition_by)
    # The key as text, never NULL: it only tells groups apart.
    grouped = (batch.select(F.coalesce(key.cast("string"), F.lit("\x00")).alias("_g"), F.col(T + "hash").alias("hash"),
                            F.col(T + "gasValue").alias("gasValue"))
               .groupBy("_g", "hash", "gasValue").agg(F.count(F.lit(1)).alias("_c")))
    per_value = grouped.groupBy("_g", "gasValue").agg(F.sum("_c").alias("_vc"))
    binned = value_bins(per_value, ["_g"], "gasValue", "_coarse", log_scale, split_rows)
    binned = value_bins(binned, ["_g", "_coarse"], "gasValue", "_fine", None, split_rows)
    counted = running_sum(binned, ["_g"], [["_coarse"], ["_fine"]], [F.col("gasValue").desc_nulls_last()], F.col("_vc"), "_upto")
    ranks = counted.select("_g", "gasValue", (F.col("_upto") - F.col("_vc") + 1).alias("gas_value_rank"))
    if top is not None:
        ranks = ranks.where(F.col("gas_value_rank") <= F.lit(int(top)))
    g, r = grouped.alias("g"), ranks.alias("r")
    joined = g.join(r, (F.col("g._g") == F.col("r._g"))
                    & F.col("g.gasValue").eqNullSafe(F.col("r.gasValue")), "inner")
    out = joined.select(F.col("g.hash").alias("hash"), F.col("g.gasValue").alias("gasValue"),
                        F.col("r.gas_value_rank").alias("gas_value_rank"), F.col("g._c").alias("_c"))
    return repeat_rows(out, "_c").select("hash", "gasValue", "gas_value_rank")


def rt_transactions_value_window(batch: DataFrame) -> DataFrame:
    w = Window.partitionBy(T + "hash").orderBy(F.desc(T + "gasValue"))
    return batch.select(F.col(T + "hash").alias("hash"), F.col(T + "gasValue").alias("gasValue"),
                        F.rank().over(w).cast("long").alias("gas_value_rank"))


def rt_transactions_by_sender(batch: DataFrame) -> DataFrame:
    """Per row, the batch's count of (non-NULL) hashes of its sender.

    The name says "cumulative" but the frame is the whole group.
    """
    per_sender = (batch.select(F.col(T + "sender.address").alias("address"), F.col(T + "hash").alias("h"))
                  .groupBy("address").agg(F.count("h").alias("cumulative_count"), F.count(F.lit(1)).alias("_n")))
    return repeat_rows(per_sender, "_n").select("address", "cumulative_count")


def rt_transactions_by_sender_window(batch: DataFrame) -> DataFrame:
    w = Window.partitionBy(T + "sender.address").orderBy(T + "hash").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return batch.select(F.col(T + "sender.address").alias("address"),
                        F.count(T + "hash").over(w).alias("cumulative_count"))


def rt_nonce_summary(batch: DataFrame) -> DataFrame:
    """Batch-wide min / max / mean nonce attached to every row.

    The three values come from one global aggregation (partial per task,
    one row final) used as a scalar subquery; no row leaves its partition.
    """
    summary = batch.agg(F.struct(F.min(T + "nonce").alias("mn"), F.max(T + "nonce").alias("mx"),
                                 exact_mean(T + "nonce").alias("av")).alias("s")).scalar()
    return batch.select(
        F.col(T + "hash").alias("hash"),
        F.col(T + "sender.address").alias("address"),
        summary.getField("mn").alias("running_min_nonce"),
        summary.getField("mx").alias("running_max_nonce"),
        summary.getField("av").alias("running_avg_nonce"),
    )


def rt_nonce_summary_window(batch: DataFrame) -> DataFrame:
    w = Window.orderBy(T + "hash").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return batch.select(F.col(T + "hash").alias("hash"), F.col(T + "sender.address").alias("address"),
                        F.min(T + "nonce").over(w).alias("running_min_nonce"),
                        F.max(T + "nonce").over(w).alias("running_max_nonce"),
                        F.avg(T + "nonce").over(w).alias("running_avg_nonce"))


MICROBATCH_ANALYTICS = {
    "rt_transaction_type_count": rt_transaction_type_count,
    "rt_average_gas": rt_average_gas,
    "rt_transactions_value": rt_transactions_value,
    "rt_transactions_by_sender": rt_transactions_by_sender,
    "rt_nonce_summary": rt_nonce_summary,
}
