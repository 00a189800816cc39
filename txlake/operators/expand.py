"""Distributed row replication.

Several analytics emit one output row per input row but only need
per-group facts (a count, a rank, a total). They are computed on the
aggregated table and then replicated back to the original multiplicity with
:func:`repeat_rows`, which never lets one task generate a hot group alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.session import default_parallelism

#: Rows one task generates for one span of a large group.
SPAN_ROWS = 1 << 20


def repeat_rows(df: DataFrame, count_col: str, index_col: str | None = None, span_rows: int | None = None,
                partitions: int | None = None) -> DataFrame:
    """Emit every row ``count_col`` times, optionally with ``index_col`` = 1..count.

    Rows with count <= ``span_rows`` explode in place (no shuffle). Larger
    counts are cut into spans of ``span_rows``; only the span descriptors
    (one small row per span) are hash-partitioned across ``partitions``
    tasks, each of which then generates its own span. Deterministic under
    task retry (no random or id-based partitioning). ``count_col`` is dropped.
    """
    span_rows = int(span_rows or SPAN_ROWS)
    idx = index_col or "_txlake_idx"
    cols = [c for c in df.columns if c != count_col]
    n = F.col(count_col)
    small = (df.where((n >= 1) & (n <= F.lit(span_rows)))
             .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), n.cast("long"))).alias(idx)))
    parts = partitions or default_parallelism(df.sparkSession)
    span = F.col("_txlake_span")
    big = (df.where(n > F.lit(span_rows))
           .select(*cols, n.cast("long").alias("_txlake_n"),
                   F.explode(F.sequence(F.lit(0).cast("long"),
                                        F.floor((n.cast("long") - 1) / F.lit(span_rows)).cast("long")))
                   .alias("_txlake_span"))
           .repartition(parts, *[F.col(c) for c in cols], span)
           .select(*cols, F.explode(F.sequence(span * F.lit(span_rows) + 1,
                                               F.least(span * F.lit(span_rows) + F.lit(span_rows),
                                                       F.col("_txlake_n")))).alias(idx)))
    out = small.unionByName(big)
    return out if index_col else out.drop(idx)
