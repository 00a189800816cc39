"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlake.session import checkpoint_root, default_parallelism

#: Rows of a file of ``stored``: about 10 MB of the widest ones, a class of near-duplicates with its registers.
FILE_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` computed once into the shared folder of ``spark.checkpoint.dir``; later reads survive lost executors.

    With ``rows``, the most rows that ``df`` can have, its last step has a task and a file for ``FILE_ROWS`` of them, at
    least one for each core and at most as many as ``df`` has partitions. On a mounted folder executors start processes
    (chmod) for every file, so a few rows in hundreds of partitions cost more than many rows.
    """
    checkpoint_root(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(default_parallelism(df.sparkSession), -(-rows // FILE_ROWS)))
    return df.checkpoint()


def width(df: DataFrame) -> int:
    """The number of shuffle partitions that the session plans with."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str, buckets: int) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 inside each value of ``group``, of any size.

    Rows of a group are dealt to ``buckets`` by a hash of ``order``; a row's number is the count of the group's
    earlier buckets (a window over one row per group and bucket) plus its place in its own bucket. No task ever
    holds a whole group. ``order`` must tell rows apart for the numbers to be reproducible.
    """
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = df.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(group).alias("__group"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order)) - 1
    return (
        df.withColumn("__place", place)
        .join(sizes, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__bucket") == F.col("__b")))
        .withColumn(name, (F.col("__before") + F.col("__place")).cast("long"))
        .drop("__bucket", "__group", "__b", "__before", "__place")
    )


def process_cache(name: str, build):
    """``build()`` once per Python worker process; a worker keeps it for all tasks that it runs."""
    import sys
    import types

    home = sys.modules.setdefault("txlake_process_cache", types.ModuleType("txlake_process_cache"))
    if not hasattr(home, name):
        setattr(home, name, build())
    return getattr(home, name)


def give_back() -> None:
    """Returns the memory that this Python worker has freed to the system: workers live on from task to task."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only; elsewhere freed pages go back by themselves
    if trim is not None:
        trim(0)


def forget_process_cache() -> None:
    """Gives back what earlier operators left in this Python worker: workers live on from stage to stage."""
    import sys

    home = sys.modules.pop("txlake_process_cache", None)
    if home is not None:
        vars(home).clear()
        give_back()
