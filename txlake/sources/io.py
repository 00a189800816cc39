"""Stream source (S03) and result sinks.

Sources and sinks are chosen by format name and options, so any connector
on the classpath (message bus, document store) plugs in unchanged; Parquet
is the default. Connector options are never logged (they may hold keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.schema import RAW_MESSAGE_SCHEMA

FILE_FORMATS = {"parquet", "json", "orc", "csv", "text", "delta"}
DOCUMENT_STORES = {"mongo", "mongodb"}
#: Formats that keep nothing, or keep it under a query's name.
WITHOUT_TARGET = {"noop", "console", "memory"}


def read_tx_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, schema=None,
                   **options) -> DataFrame:
    """Raw message stream with columns ``value`` and ``timestamp``.

    ``fmt="kafka"`` needs e.g. ``subscribe=...`` and
    ``kafka.bootstrap.servers=...`` (``startingOffsets`` defaults to
    ``latest`` as in the reference; a checkpoint makes restarts resume instead).
    File formats read ``path`` with ``schema`` (default: value string +
    timestamp), e.g. JSON lines written by :func:`encode_envelope`.
    """
    reader = spark.readStream.format(fmt)
    # No cap on a micro-batch unless the caller names one (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``):
    # the analytics are per micro-batch, so a cap changes their numbers.
    if fmt == "kafka":
        options.setdefault("startingOffsets", "latest")
    else:
        reader = reader.schema(schema or RAW_MESSAGE_SCHEMA)
    reader = reader.options(**{k: str(v) for k, v in options.items()})
    df = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"), F.col("timestamp"))
    return df


def target_options(fmt: str, name: str, options: dict) -> dict:
    """Options of a sink that is neither files nor a document store, with ``{name}`` filled in. Without a
    ``{name}`` all results would overwrite one target."""
    if fmt in WITHOUT_TARGET:
        return dict(options)
    if not any("{name}" in str(v) for v in options.values()):
        raise ValueError(f"format {fmt!r} needs an option with {{name}}, so that every result has its own target")
    return {k: str(v).replace("{name}", name) for k, v in options.items()}


def write_result(df: DataFrame, name: str, base: str | None = None, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None, **options) -> None:
    """Write one named result ("collection").

    File formats go to ``{base}/{name}``; document stores (``mongo``,
    ``mongodb``) get ``collection=name``; every other format must carry its
    own connection options, one of them with ``{name}`` in it.
    """
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt in FILE_FORMATS:
        if base is None:
            raise ValueError("file sinks need a base path")
        w.options(**options).save(f"{base.rstrip('/')}/{name}")
    else:
        if fmt in DOCUMENT_STORES:
            options.setdefault("collection", name)
        else:
            options = target_options(fmt, name, options)
        w.options(**options).save()


def publish_envelopes(messages: DataFrame, fmt: str = "kafka", topic: str | None = None, path: str | None = None,
                      mode: str = "append", **options) -> None:
    """S12 sink side: publish encoded messages (``value`` JSON text).

    ``fmt="kafka"`` writes ``value`` to ``topic`` (connection options such as
    ``kafka.bootstrap.servers`` passed through); file formats write ``value``
    and ``timestamp`` under ``path`` (one record per message), which the file
    stream source of :func:`read_tx_stream` reads back.
    """
    if fmt == "kafka":
        if not topic:
            raise ValueError("kafka needs a topic")
        (messages.select(F.col("value").cast("string").alias("value"))
         .write.format("kafka").option("topic", topic).options(**options).save())
        return
    if path is None:
        raise ValueError("file formats need a path")
    cols = [c for c in ("value", "timestamp") if c in messages.columns]
    messages.select(*cols).write.format(fmt).mode(mode).options(**options).save(path)
