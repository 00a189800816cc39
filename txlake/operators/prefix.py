"""Running sums inside a key, without a task that holds the whole key.

The rows of a key are dealt to buckets that follow the order of the sum. A row's sum is its running sum inside its
bucket plus what the buckets before it hold, and those are windows over one aggregated row a bucket, level by level
(an hour's minutes, a minute's instants). Buckets come from the data alone, so a recomputed task finds the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A bucket with more rows is cut by the first characters of the rows' hashes.
SPLIT_ROWS = 1 << 20


def split_crowded(rows: DataFrame, keys: list[str], hash_col: str, limit: int | None = None, name: str = "_part") -> DataFrame:
    """Adds ``_crowded`` and ``name``: '' for rows of a group (non-null ``keys``) with at most ``limit`` rows, else the first characters of
    ``hash_col``, one hexadecimal digit for each sixteenfold excess (and one to spare) behind the ``0x``.

    The order by (``name``, ``hash_col``) is the order by ``hash_col``, null and '' first. The broadcast table has one row a crowded
    group, at most one for every ``limit`` rows."""
    limit = int(limit or SPLIT_ROWS)
    crowded = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    crowded = crowded.select(*keys, (F.ceil(F.log(16.0, F.col("_n") / limit)) + 3).cast("int").alias("_length"))
    start = F.coalesce(F.substring(F.col(hash_col), F.lit(1), F.col("_length")), F.lit(""))
    part = F.when(F.col("_length").isNull(), F.lit("")).otherwise(start)
    found = rows.join(F.broadcast(crowded), keys, "left")
    return found.withColumns({name: part, "_crowded": F.col("_length").isNotNull()}).drop("_length")


def running_sum(rows: DataFrame, keys: list[str], levels: list[list[str]], order: list, weight: Column, name: str,
                counted: DataFrame | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over the rows of ``keys`` up to this one, NULL while all of them are NULL.

    ``levels`` are the columns of the buckets from coarse to fine, all non-null like ``keys``; rows are ordered by them
    and inside a bucket by ``order``. Rows are shuffled once, by bucket; the offsets join on that partitioning.
    Where ``rows`` are dealt to their buckets already, ``counted`` are the same rows before that, to be added up where they are."""
    path = [*keys, *(c for level in levels for c in level)]
    inside = Window.partitionBy(*path).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (rows if counted is None else counted).groupBy(*path).agg(F.sum(weight).alias("_total"))
    offsets, before = None, []
    for depth in reversed(range(len(levels))):
        outer = [*keys, *(c for level in levels[:depth] for c in level)]
        earlier = Window.partitionBy(*outer).orderBy(*levels[depth]).rowsBetween(Window.unboundedPreceding, -1)
        here = [*outer, *levels[depth]]
        found = totals.select(*here, F.sum("_total").over(earlier).alias(f"_before{depth}"))
        offsets = found if offsets is None else offsets.join(found, here)
        before.append(F.col(f"_before{depth}"))
        if depth:
            totals = totals.groupBy(*outer).agg(F.sum("_total").alias("_total"))
    parts = [F.col("_inside"), *before]
    total = F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0))))
    # Every row has its offsets; the left join keeps the rows from ever being the broadcast side.
    joined = rows.withColumn("_inside", F.sum(weight).over(inside)).join(offsets, path, "left")
    return joined.withColumn(name, total.cast("long")).drop("_inside", *(f"_before{d}" for d in range(len(levels))))


#: Bins that a crowded group's values are dealt to at a time.
BINS = 1024


def log_scale(value: Column) -> Column:
    """A scale on which values of very different sizes lie apart; never turns the order of two values round."""
    return F.signum(value) * F.log1p(F.abs(value) * 1e9)


def value_bins(rows: DataFrame, keys: list[str], value: str, name: str, scale=None, limit: int | None = None) -> DataFrame:
    """Adds ``name``: 0 for rows of a group (non-null ``keys``) with at most ``limit`` rows, else the bin of ``value`` between the
    group's least and greatest, by falling value, null last and NaN first. A histogram from exact bounds: the same
    bins whenever it is computed. The broadcast table has at most one row for every ``limit`` rows."""
    limit = int(limit or SPLIT_ROWS)
    at = (scale or (lambda v: v))(F.col(value).cast("double"))
    real = F.when(~F.isnan(at), at)
    crowded = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(real).alias("_lo"), F.max(real).alias("_hi"))
    crowded = crowded.where(F.col("_n") > limit).drop("_n")
    found = rows.join(F.broadcast(crowded.withColumn("_crowded", F.lit(True))), keys, "left")
    place = F.floor(F.try_divide(at - F.col("_lo"), F.col("_hi") - F.col("_lo")) * BINS).cast("int")
    bin_ = F.when(F.col("_crowded").isNull(), 0).when(F.col(value).isNull(), 1).when(F.isnan(at), -BINS - 1).otherwise(F.coalesce(-place, F.lit(0)))
    return found.withColumn(name, bin_).drop("_lo", "_hi", "_crowded")
