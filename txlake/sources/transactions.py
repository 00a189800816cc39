"""Batch source (S01) and lake landing job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.schema import BLOCK_TIMESTAMP, DATE, HASH, LAST_MODIFIED, TX_SCHEMA, TX_SCHEMA_EXT
from txlake.session import path_exists


def scan_transactions(spark: SparkSession, path: str, start_date: str | None = None,
                      end_date: str | None = None, with_last_modified: bool = False) -> DataFrame:
    """Read the ``date``-partitioned Parquet lake with a declared schema.

    No footer inference: ``date`` stays a string (inference would make it a
    date). An optional inclusive ``date`` range prunes partitions at listing
    time; every later filter/projection is pushed into the scan by Catalyst.
    """
    schema = TX_SCHEMA_EXT if with_last_modified else TX_SCHEMA
    df = spark.read.schema(schema).parquet(path)
    if start_date is not None:
        df = df.where(F.col(DATE) >= F.lit(start_date))
    if end_date is not None:
        df = df.where(F.col(DATE) <= F.lit(end_date))
    return df


def read_lake_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     **options) -> DataFrame:
    """The lake as a stream of newly landed files (input of the event-time monitors).

    Declared schema (``block_timestamp`` is ``timestamp``, as watermarks
    require). There is no cap by default: with ``max_files_per_trigger`` a
    backlog is read in several batches, and a batch whose rows are older than
    the watermark of an earlier one loses them. Set it only where files come
    in time order within the watermark.
    """
    opts = {k: str(v) for k, v in options.items()}
    if max_files_per_trigger is not None:
        opts["maxFilesPerTrigger"] = str(int(max_files_per_trigger))
    return spark.readStream.schema(TX_SCHEMA_EXT).options(**opts).parquet(path)


def conform_transactions(raw: DataFrame, with_last_modified: bool | None = None) -> DataFrame:
    """Cast a raw frame to the transaction schema; derive ``date`` when absent."""
    schema = TX_SCHEMA_EXT if (with_last_modified or (with_last_modified is None and LAST_MODIFIED in raw.columns)) \
        else TX_SCHEMA
    missing = [f.name for f in schema.fields if f.name not in raw.columns and f.name not in (DATE, LAST_MODIFIED)]
    if missing:
        raise ValueError(f"not a transaction frame, it lacks: {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        if f.name == DATE and DATE not in raw.columns:
            cols.append(F.date_format(F.col(BLOCK_TIMESTAMP).cast("timestamp"), "yyyy-MM-dd").alias(DATE))
        elif f.name in raw.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def row_key() -> Column:
    """A transaction's hash; one without a hash is told by its content."""
    content = F.sha2(F.to_json(F.struct(*[F.col(f.name) for f in TX_SCHEMA.fields])), 256)
    return F.coalesce(F.col(HASH), content)


def without_landed(conformed: DataFrame, path: str) -> DataFrame:
    """Rows whose transaction the lake at ``path`` does not have yet on their date.

    Only the partitions of the rows' own dates are read (their list comes to the driver: one value a calendar day), and of
    them only dates and hashes. The anti-join's keys are (date, hash), so a date with a third of all rows is spread; where
    those dates are empty, the join vanishes at run time."""
    spark = conformed.sparkSession
    if not path_exists(spark, path):
        return conformed
    dates = [r[0] for r in conformed.select(DATE).distinct().collect()]
    day = F.coalesce(F.col(DATE), F.lit(""))
    landed = spark.read.schema(TX_SCHEMA).parquet(path).where(F.col(DATE).isin([d for d in dates if d is not None]) | F.col(DATE).isNull())
    landed = landed.select(day.alias("_day"), row_key().alias("_key"))
    new = conformed.withColumns({"_day": day, "_key": row_key()})
    return new.join(landed, ["_day", "_key"], "left_anti").drop("_day", "_key")


def land_transactions(raw: DataFrame, path: str, mode: str = "append",
                      with_last_modified: bool | None = None, skip_landed: bool = True) -> None:
    """Conform raw rows and write them ``date``-partitioned.

    Rows are rebalanced on ``date`` (``REBALANCE`` hint): one shuffle, after
    which AQE splits a skewed date (one holding a third of all rows) into
    advisory-size partitions and merges small ones, so every directory gets
    a few files of sensible size, without the extra sampling pass over the
    input that a range repartition runs first. With ``mode="overwrite"`` and
    dynamic partition overwrite only the dates present in ``raw`` are
    replaced; with ``append`` and ``skip_landed`` transactions that the lake has are left out (the lake's row stays, if the
    contents differ). So a re-run after a failure is idempotent either way. Copies inside ``raw`` are kept.
    """
    conformed = conform_transactions(raw, with_last_modified)
    if mode == "append" and skip_landed:
        conformed = without_landed(conformed, path)
    (conformed.hint("rebalance", DATE)
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(DATE)
     .parquet(path))


FILE_FACTS = ["path", "length", "modificationTime"]


def land_folder(spark: SparkSession, source: str, path: str, with_last_modified: bool | None = None) -> int:
    """Lands the Parquet files under ``source`` that were not landed before; returns how many.

    The lake keeps a table of the files it has (path, length, time) in its folder ``_landing``, which readers of the lake
    do not see. It is written after the rows: a run that dies in between finds its files again and leaves out their rows by hash."""
    known = f"{path.rstrip('/')}/_landing"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(source).select(*FILE_FACTS))
    if path_exists(spark, known):
        files = files.join(spark.read.parquet(known), FILE_FACTS, "left_anti")
    found = files.collect()  # the list that the reader needs as well
    if found:
        raw = spark.read.option("basePath", source).parquet(*[r.path for r in found])
        land_transactions(raw, path, "append", with_last_modified)
        spark.createDataFrame(found, files.schema).coalesce(1).write.mode("append").parquet(known)
    return len(found)
