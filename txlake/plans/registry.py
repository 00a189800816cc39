"""Registered queries over the driver's tables, and their DuckDB oracles.

Every query reads ``events`` (or data Spark derives from it: the landed lake,
stream envelopes) through the fixture mapping of :mod:`txlake.sources.fixtures`,
so its work grows with the table. Oracle SQL reuses the very same mapping
text as the CTE ``tx``. Timestamps are returned as ``timestamp_ntz`` so both
engines report a zone-less timestamp.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake import operators as ops
from txlake.operators import realtime as rt
from txlake.plans.batch_job import JOB_OUTPUTS, run_batch_job
from txlake.schema import TX_SCHEMA_EXT
from txlake.session import ensure_utc, input_version, partitions_for_input, path_exists, scratch_path
from txlake.sources.commits import CommitLog
from txlake.sources.envelope import (decode_envelope, encode_envelope, error_envelope_filter, error_response,
                                     explode_transactions, flatten_transaction, poll_window_extract)
from txlake.sources.fixtures import (ENVELOPE_FROM_EVENTS, envelope_rows_from_events, load_transactions, read_table,
                                     tx_from_events, tx_sql_select)
from txlake.sources.io import read_tx_stream
from txlake.sources.poll import poll_messages, publish_once
from txlake.sources.transactions import land_transactions, read_lake_stream, scan_transactions
from txlake.streaming import eventtime as et
from txlake.streaming import microbatch as mb
from txlake.streaming.bus import land_bus, read_bus_stream, read_gas_price_view, run_gas_price_view
from txlake.streaming.runner import run_stream, run_to_completion, write_stream

Query = Callable[[SparkSession, str], DataFrame]


def zone_less(df: DataFrame) -> DataFrame:
    """Cast session-zone timestamps to ``timestamp_ntz`` (UTC wall clock)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _batch(fn, **kwargs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return zone_less(fn(load_transactions(spark, sf_dir), **kwargs))
    run.__name__ = fn.__name__
    return run


TX_CTE = "WITH tx AS (SELECT\n  " + tx_sql_select() + "\nFROM events)\n"

# Shared SQL fragments of the oracles.
_EUR = "1851.0"
_MEAN = "CAST(sum({c}) AS DOUBLE) / CAST(count({c}) AS DOUBLE)"
_PCT = "round(CAST({a} AS DOUBLE) / CAST({a} + {b} AS DOUBLE) * 100.0, 4)"


def _mean(c: str) -> str:
    return _MEAN.format(c=c)


BATCH_QUERIES: dict[str, Query] = {
    "unit_conversions": _batch(ops.unit_conversions),
    "avg_gas_price": _batch(ops.avg_gas_price),
    "avg_transaction_price": _batch(ops.avg_transaction_price),
    "biggest_transactions": _batch(ops.biggest_transactions),
    "address_transaction_volume": _batch(ops.address_transaction_volume),
    "failed_transaction_pct": _batch(ops.failed_transaction_pct),
    "transaction_status_counts": _batch(ops.transaction_status_counts),
    "avg_gas_used": _batch(ops.avg_gas_used),
    "contract_vs_transfer_pct": _batch(ops.contract_vs_transfer_pct),
    "block_utilization": _batch(ops.block_utilization),
    "hourly_activity": _batch(ops.hourly_activity),
    "transaction_speed_by_gas_price": _batch(ops.transaction_speed_by_gas_price),
    "gas_pricing": _batch(ops.gas_pricing),
    "most_active_pairs": _batch(ops.most_active_pairs),
    "gas_usage_by_address": _batch(ops.gas_usage_by_address),
    "address_activity": _batch(ops.address_activity),
    "hourly_gas_usage": _batch(ops.hourly_gas_usage),
    "cumulative_gas_in_hour": _batch(ops.cumulative_gas_in_hour),
    "fee_stats_by_type": _batch(ops.fee_stats_by_type),
    "transaction_category_counts": _batch(ops.transaction_category_counts),
    "categorize_transactions": _batch(ops.categorize_transactions),
    "show_top": _batch(ops.address_transaction_volume, n=10),
}

_CATEGORY = "CASE WHEN input = '0x' THEN 'simple_transfer' ELSE 'contract_interaction' END"

BATCH_ORACLE: dict[str, str] = {
    "unit_conversions": f"""
SELECT gas, gas_price, value,
  gas_price / 1e9 AS gas_price_gwei,
  gas_price / 1e18 AS gas_price_eth,
  gas_price / 1e18 * {_EUR} AS gas_price_euro,
  round(gas_price / 1e18 * {_EUR} * gas, 2) AS gas_price_total_units_euro,
  value / 1e18 AS eth_transfered,
  value / 1e18 * {_EUR} AS euro_transfered
FROM tx""",
    "avg_gas_price": f"SELECT {_mean('gas_price')} / 1e9 AS avg_gas_price_gwei FROM tx",
    "avg_transaction_price": f"""
SELECT CAST(sum(CAST(gas AS HUGEINT) * gas_price) AS DOUBLE)
       / CAST(count(CAST(gas AS HUGEINT) * gas_price) AS DOUBLE) / 1e18 * {_EUR} AS avg_transaction_price_euro
FROM tx""",
    "biggest_transactions": f"""
SELECT hash, gas_price, gas, value,
  gas_price / 1e9 AS gas_price_gwei,
  gas_price / 1e18 AS gas_price_eth,
  gas_price / 1e18 * {_EUR} AS gas_price_euro,
  gas * (gas_price / 1e18 * {_EUR}) AS total_price_euro,
  value / 1e18 * {_EUR} AS value_euro
FROM tx WHERE value <> 0.0
ORDER BY total_price_euro DESC, hash ASC LIMIT 10""",
    "address_transaction_volume": """
SELECT from_address, count(*) AS count
FROM (SELECT from_address FROM tx UNION ALL SELECT to_address FROM tx)
GROUP BY from_address""",
    "failed_transaction_pct": f"""
SELECT {_PCT.format(a='count_if(receipt_status = 0)', b='count_if(receipt_status = 1)')} AS failed_pct,
  CAST(count_if(receipt_status = 0) AS BIGINT) AS failed_count,
  CAST(count_if(receipt_status = 1) AS BIGINT) AS success_count
FROM tx""",
    "transaction_status_counts": "SELECT receipt_status, count(*) AS count FROM tx GROUP BY receipt_status",
    "avg_gas_used": f"SELECT round({_mean('gas')}, 2) AS avg_gas FROM tx",
    "contract_vs_transfer_pct": f"""
SELECT {_PCT.format(a="count_if(input <> '0x')", b="count_if(input = '0x')")} AS contract_interaction_pct,
  {_PCT.format(a="count_if(input = '0x')", b="count_if(input <> '0x')")} AS simple_transfer_pct
FROM tx""",
    "block_utilization": """
SELECT block_number, CAST(sum(receipt_gas_used) AS BIGINT) AS total_gas_used,
  CAST(sum(receipt_gas_used) AS BIGINT) / 30000000 * 100 AS utilization
FROM tx GROUP BY block_number""",
    "hourly_activity": """
SELECT CAST(hour(block_timestamp) AS INTEGER) AS hour, count(*) AS num_transactions
FROM tx GROUP BY 1""",
    "transaction_speed_by_gas_price": f"""
SELECT gas_price / 1e9 AS gas_price_gwei, {_mean('d')} AS average_duration
FROM (SELECT gas_price,
        CAST(epoch(date_trunc('second', last_modified)) AS BIGINT)
        - CAST(epoch(date_trunc('second', block_timestamp)) AS BIGINT) AS d FROM tx)
GROUP BY gas_price""",
    "gas_pricing": f"""
SELECT hash, gas, gas_price,
  CAST(CAST(gas AS HUGEINT) * gas_price AS DECIMAL(38,0)) AS total_gas_cost_wei,
  CAST(CAST(gas AS HUGEINT) * gas_price AS DOUBLE) / 1e9 AS gas_price_gwei,
  CAST(CAST(gas AS HUGEINT) * gas_price AS DOUBLE) / 1e18 AS gas_price_eth,
  CAST(CAST(gas AS HUGEINT) * gas_price AS DOUBLE) / 1e18 * {_EUR} AS gas_price_euro
FROM tx""",
    "most_active_pairs": """
SELECT from_address, to_address, count(*) AS total_transactions FROM tx GROUP BY from_address, to_address""",
    "gas_usage_by_address": f"""
SELECT from_address, {_mean('gas')} AS avg_gas_used, max(gas) AS max_gas_used, min(gas) AS min_gas_used
FROM tx GROUP BY from_address""",
    "address_activity": "SELECT from_address, count(hash) AS transaction_count FROM tx GROUP BY from_address",
    "hourly_gas_usage": """
SELECT hour, CAST(max(running) AS BIGINT) AS total_gas_used
FROM (SELECT CAST(hour(block_timestamp) AS INTEGER) AS hour,
             sum(receipt_cumulative_gas_used) OVER (
               PARTITION BY CAST(block_timestamp AS DATE), hour(block_timestamp) ORDER BY block_timestamp
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
      FROM tx)
GROUP BY hour""",
    "cumulative_gas_in_hour": """
SELECT hash, block_timestamp, CAST(hour(block_timestamp) AS INTEGER) AS hour,
  CAST(sum(receipt_cumulative_gas_used) OVER (
    PARTITION BY CAST(block_timestamp AS DATE), hour(block_timestamp)
    ORDER BY block_timestamp ASC NULLS FIRST, hash ASC NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_gas_used
FROM tx""",
    "fee_stats_by_type": f"""
SELECT *, CASE WHEN avg_gas_price = 0 THEN NULL ELSE avg_gas_used / avg_gas_price END AS efficiency_ratio
FROM (SELECT transaction_type,
        {_mean('receipt_gas_used')} AS avg_gas_used,
        max(receipt_gas_used) AS max_gas_used, min(receipt_gas_used) AS min_gas_used,
        {_mean('gas_price')} AS avg_gas_price,
        max(gas_price) AS max_gas_price, min(gas_price) AS min_gas_price,
        {_mean('max_fee_per_gas')} AS avg_fee,
        max(max_fee_per_gas) AS max_fee, min(max_fee_per_gas) AS min_fee
      FROM tx GROUP BY transaction_type)""",
    "transaction_category_counts": f"SELECT {_CATEGORY} AS type, count(*) AS count FROM tx GROUP BY 1",
    "categorize_transactions": f"SELECT *, {_CATEGORY} AS type FROM tx",
    "show_top": """
SELECT from_address, count(*) AS count
FROM (SELECT from_address FROM tx UNION ALL SELECT to_address FROM tx)
GROUP BY from_address ORDER BY count DESC, from_address ASC NULLS LAST LIMIT 10""",
}



# ---------------------------------------------------------------------------
# Lake landing and scan (S01, S02): events -> conformed, date-partitioned lake.
# ---------------------------------------------------------------------------

_WRITTEN: dict[tuple, str] = {}


def _derived_table(spark: SparkSession, sf_dir: str, kind: str, write, fresh: bool = False) -> str:
    """Path of a table Spark derived from ``sf_dir`` into the shared scratch area.

    Written once per (application, input, kind) and reused while it exists
    and the input's files stay the same, so queries that only *read* the
    landed data do not pay for landing it.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, input_version(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    path = _WRITTEN.get(key)
    if fresh or path is None or not path_exists(spark, path):
        path = scratch_path(spark, kind)
        write(path)
        _WRITTEN[key] = path
    return path


def _landed(spark: SparkSession, sf_dir: str, fresh: bool = False) -> str:
    def write(path: str) -> None:
        land_transactions(tx_from_events(read_table(spark, sf_dir, "events")), path, mode="overwrite")
    return _derived_table(spark, sf_dir, "lake", write, fresh)


def q_land_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return zone_less(scan_transactions(spark, _landed(spark, sf_dir, fresh=True), with_last_modified=True))


def q_scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return zone_less(scan_transactions(spark, _landed(spark, sf_dir)))


def q_scan_transactions_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return zone_less(scan_transactions(spark, _landed(spark, sf_dir), "2024-01-10", "2024-01-20"))


# ---------------------------------------------------------------------------
# Stream envelopes (S04, S05, S11, S12, S13) and micro-batch analytics.
# ---------------------------------------------------------------------------

ERROR_EVERY = 7  # every 7th message (id % 7 = 3) is an API error response in the fixture


def encoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus records (``message_id, value, timestamp``) encoded from ``events``."""
    rows = envelope_rows_from_events(read_table(spark, sf_dir, "events"))
    return encode_envelope(rows, "message_id", tx_type=F.col("txType")).drop("message_no")


#: A reader takes up to 4096 rows of a file at a time, which are too many messages of a hundred transactions.
MESSAGE_FILES = {"compression": "zstd", "maxRecordsPerFile": 1024}
MESSAGE_SCHEMA = "message_id bigint, value string, timestamp timestamp"


def message_table(spark: SparkSession, sf_dir: str) -> str:
    """The encoded messages written once to the shared scratch area (the "bus" the
    consuming queries read, like a topic they subscribe to)."""
    return _derived_table(spark, sf_dir, "messages",
                          lambda p: encoded_messages(spark, sf_dir).write.options(**MESSAGE_FILES).parquet(p))


def raw_messages(spark: SparkSession, sf_dir: str, with_errors: bool = False) -> DataFrame:
    """Bus records read back from the message table; optionally every
    ``ERROR_EVERY``-th message replaced by an API error response."""
    msgs = spark.read.schema(MESSAGE_SCHEMA).parquet(message_table(spark, sf_dir))
    if with_errors:
        bad = (F.col("message_id") % ERROR_EVERY) == F.lit(3)
        msgs = msgs.withColumn("value", F.when(bad, error_response(
            F.concat(F.lit("rate limit exceeded for message "), F.col("message_id").cast("string"))))
            .otherwise(F.col("value")))
    return msgs


def exploded_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fixture as one micro-batch: decode + explode of every message."""
    return explode_transactions(decode_envelope(raw_messages(spark, sf_dir).drop("message_id")))


def _mb(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(exploded_batch(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def q_decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    dec = decode_envelope(raw_messages(spark, sf_dir).drop("message_id"))
    return zone_less(dec.select("timestamp", F.size("data.data.ethereum.transactions").cast("long")
                                .alias("n_transactions")))


def q_explode_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    dec = decode_envelope(raw_messages(spark, sf_dir).drop("message_id"))
    return zone_less(flatten_transaction(explode_transactions(dec, keep=("timestamp",)), keep=("timestamp",)))


def q_encode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip rows -> JSON messages -> decode -> explode -> flat rows (encoded fresh)."""
    ensure_utc(spark)
    dec = decode_envelope(encoded_messages(spark, sf_dir).drop("message_id"))
    return zone_less(flatten_transaction(explode_transactions(dec)))


def q_error_envelope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ok, _dead = error_envelope_filter(raw_messages(spark, sf_dir, with_errors=True))
    dec = decode_envelope(ok.drop("message_id"))
    return zone_less(dec.select("timestamp", F.size("data.data.ethereum.transactions").cast("long")
                                .alias("n_transactions")))


POLL_SINCE, POLL_TILL = "2024-01-15 00:00:00", "2024-01-16 00:00:00"


def q_poll_window_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return zone_less(flatten_transaction(poll_window_extract(load_transactions(spark, sf_dir), POLL_SINCE,
                                                             POLL_TILL)))


ENV_CTE = ("WITH tx AS (SELECT\n  " + tx_sql_select() + ",\n  event_id,\n  "
           + ",\n  ".join(f"{e} AS {n}" for n, e in ENVELOPE_FROM_EVENTS) + "\nFROM events),\n"
           "env AS (SELECT *, max(block_timestamp) OVER (PARTITION BY message_id) AS msg_time FROM tx)\n")

_FLAT = ("hash, nonce, from_address AS sender, to_address AS receiver, CAST(gas AS DOUBLE) AS gas, "
         "CAST(gas_price AS DOUBLE) AS gasPrice, gas * gas_price / 1e18 AS gasValue, {t} AS txType, "
         "date_trunc('second', block_timestamp) AS block_time")

ENVELOPE_QUERIES: dict[str, Query] = {
    "land_transactions": q_land_transactions,
    "scan_transactions": q_scan_transactions,
    "scan_transactions_date_range": q_scan_transactions_date_range,
    "decode_envelope": q_decode_envelope,
    "explode_transactions": q_explode_transactions,
    "encode_envelope": q_encode_envelope,
    "error_envelope_filter": q_error_envelope_filter,
    "poll_window_extract": q_poll_window_extract,
    "rt_transaction_type_count": _mb(mb.rt_transaction_type_count),
    "rt_average_gas": _mb(mb.rt_average_gas),
    "rt_transactions_value": _mb(mb.rt_transactions_value),
    "rt_transactions_by_sender": _mb(mb.rt_transactions_by_sender),
    "rt_nonce_summary": _mb(mb.rt_nonce_summary),
}

ENVELOPE_ORACLE: dict[str, str] = {
    "land_transactions": TX_CTE + "SELECT * FROM tx",
    "scan_transactions": TX_CTE + "SELECT * EXCLUDE (last_modified) FROM tx",
    "scan_transactions_date_range": TX_CTE + "SELECT * EXCLUDE (last_modified) FROM tx WHERE date BETWEEN '2024-01-10' AND '2024-01-20'",
    "decode_envelope": ENV_CTE + "SELECT max(block_timestamp) AS timestamp, count(*) AS n_transactions "
                                 "FROM env GROUP BY message_id",
    "explode_transactions": ENV_CTE + "SELECT " + _FLAT.format(t="txType") + ", msg_time AS timestamp FROM env",
    "encode_envelope": ENV_CTE + "SELECT " + _FLAT.format(t="txType") + " FROM env",
    "error_envelope_filter": ENV_CTE + "SELECT max(block_timestamp) AS timestamp, count(*) AS n_transactions "
                                       f"FROM env WHERE message_id % {ERROR_EVERY} <> 3 GROUP BY message_id",
    "poll_window_extract": TX_CTE + "SELECT " + _FLAT.format(t="CAST(transaction_type AS VARCHAR)") + f"""
FROM tx WHERE block_timestamp BETWEEN TIMESTAMP '{POLL_SINCE}' AND TIMESTAMP '{POLL_TILL}'
ORDER BY block_timestamp DESC, hash ASC LIMIT 100""",
    "rt_transaction_type_count": ENV_CTE + """
SELECT CASE WHEN raw_type <> '' THEN raw_type ELSE '2' END AS txType, rn AS running_count
FROM (SELECT txType AS raw_type, row_number() OVER (PARTITION BY txType ORDER BY hash) AS rn FROM env)""",
    "rt_average_gas": ENV_CTE + """
SELECT avg(CAST(gas AS DOUBLE)) AS average_gas, avg(CAST(gas_price AS DOUBLE)) AS average_gas_price FROM env""",
    "rt_transactions_value": ENV_CTE + """
SELECT hash, gas * gas_price / 1e18 AS gasValue,
  rank() OVER (PARTITION BY hash ORDER BY gas * gas_price / 1e18 DESC NULLS LAST) AS gas_value_rank
FROM env""",
    "rt_transactions_by_sender": ENV_CTE + """
SELECT from_address AS address, count(hash) OVER (PARTITION BY from_address) AS cumulative_count FROM env""",
    "rt_nonce_summary": ENV_CTE + """
SELECT hash, from_address AS address,
  min(nonce) OVER () AS running_min_nonce, max(nonce) OVER () AS running_max_nonce,
  CAST(sum(nonce) OVER () AS DOUBLE) / CAST(count(nonce) OVER () AS DOUBLE) AS running_avg_nonce
FROM env""",
}


# ---------------------------------------------------------------------------
# Real-time queries of the slides, batch form (P01-P05). NOW() = AS_OF.
# ---------------------------------------------------------------------------

AS_OF = "2024-01-29 00:00:00"
P_PARAMS = {
    "tx_count_in_frame": {"frame": "7 days"},
    "gas_price_trend": {"frame": "1 day"},
    "new_contracts": {"frame": "7 days"},
    "large_transfers": {"frame": "1 day", "threshold": 2.5e20},
    "suspicious_activity": {"frame": "30 days", "max_count": 1, "max_avg_gas_price": 85e9},
}


def _p(fn, name) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return zone_less(fn(load_transactions(spark, sf_dir), as_of=AS_OF, **P_PARAMS[name]))
    run.__name__ = name
    return run


def _frame(name: str) -> str:
    return (f"block_timestamp BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '{P_PARAMS[name]['frame']}' "
            f"AND TIMESTAMP '{AS_OF}'")


REALTIME_QUERIES: dict[str, Query] = {
    "tx_count_in_frame": _p(rt.tx_count_in_frame, "tx_count_in_frame"),
    "gas_price_trend": _p(rt.gas_price_trend, "gas_price_trend"),
    "new_contracts": _p(rt.new_contracts, "new_contracts"),
    "large_transfers": _p(rt.large_transfers, "large_transfers"),
    "suspicious_activity": _p(rt.suspicious_activity, "suspicious_activity"),
}

REALTIME_ORACLE: dict[str, str] = {
    "tx_count_in_frame": f"SELECT count(*) AS transaction_count FROM tx WHERE {_frame('tx_count_in_frame')}",
    "gas_price_trend": f"""
SELECT block_timestamp, {_mean('gas_price')} AS average_gas_price
FROM tx WHERE {_frame('gas_price_trend')} GROUP BY block_timestamp""",
    "new_contracts": f"""
SELECT count(*) AS contract_count, {_mean('receipt_gas_used')} AS average_initial_gas_usage
FROM tx WHERE to_address IS NULL AND input IS NOT NULL AND {_frame('new_contracts')}""",
    "large_transfers": f"""
SELECT hash AS transaction_id, value FROM tx
WHERE value > {P_PARAMS['large_transfers']['threshold']!r} AND {_frame('large_transfers')}""",
    "suspicious_activity": f"""
SELECT from_address, to_address, count(*) AS transaction_count, {_mean('gas_price')} AS average_gas_price
FROM tx WHERE {_frame('suspicious_activity')}
GROUP BY from_address, to_address
HAVING count(*) > {P_PARAMS['suspicious_activity']['max_count']}
    OR {_mean('gas_price')} > {P_PARAMS['suspicious_activity']['max_avg_gas_price']!r}""",
}



# ---------------------------------------------------------------------------
# Streaming forms (P01-P05 on event time; R06 consumer end to end).
# Sources are files Spark writes from ``events`` into the shared scratch area;
# each query runs with trigger(availableNow=True) and returns its sink. With
# one input batch the watermark ends at max(event time) - delay and the
# closing no-data batch emits exactly the windows whose end is <= that.
# ---------------------------------------------------------------------------

STREAM_WATERMARK = "10 minutes"
STREAM_PARAMS = {
    "tx_count_in_frame_stream": {"frame": "1 hour"},
    "gas_price_trend_stream": {"granularity": "1 hour"},
    "new_contracts_stream": {"frame": "1 day"},
    "large_transfers_stream": {"threshold": 2.5e20},
    "suspicious_activity_stream": {"frame": "1 day", "max_count": 1, "max_avg_gas_price": 85e9},
    "tx_count_sliding_stream": {"frame": "6 hours", "slide": "1 hour"},
    "new_contracts_sliding_stream": {"frame": "1 day", "slide": "6 hours"},
    "tx_count_on_bus_stream": {"frame": "1 hour"},
    "gas_price_trend_on_bus_stream": {"granularity": "1 hour"},
    "suspicious_activity_on_bus_stream": {"frame": "1 day", "slide": "12 hours", "max_count": 1, "max_avg_gas_price": 85e9},
}


def _tx_stream_source(spark: SparkSession, sf_dir: str) -> str:
    return _derived_table(spark, sf_dir, "tx-stream-src", lambda p: load_transactions(spark, sf_dir).write.parquet(p))


def _stream(fn, name, stateful: bool = True, keyless: bool = False, on_bus: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        params = dict(STREAM_PARAMS[name])
        if stateful:
            params["watermark"] = STREAM_WATERMARK
        src = _bus_landed(spark, sf_dir) if on_bus else _tx_stream_source(spark, sf_dir)
        read = read_bus_stream if on_bus else read_lake_stream
        out, ck = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
        # Keyless windows: a few state partitions; keyed state grows with the input, so size it from it.
        parts = et.KEYLESS_STATE_PARTITIONS if keyless else partitions_for_input(spark, src)
        q = write_stream(fn(read(spark, src), **params), out, ck,
                         trigger={"availableNow": True}, state_partitions=parts)
        run_to_completion(q)
        return zone_less(spark.read.schema(q_schema(fn, spark, params)).parquet(out))
    run.__name__ = name
    return run


def q_schema(fn, spark: SparkSession, params: dict):
    """Output schema of a streaming query (same function over an empty batch frame), so
    that a sink with no emitted rows still reads back with the right columns."""
    return fn(spark.createDataFrame([], TX_SCHEMA_EXT), **params).schema  # the bus has fewer columns of the same types


def _consumer_sinks(spark: SparkSession, sf_dir: str, fresh: bool = False) -> str:
    """R06 + S03 + S08: message files -> stream -> decode -> foreachBatch R01-R05
    -> batch_id-partitioned sinks (one input batch)."""
    src = message_table(spark, sf_dir)

    def write(sinks: str) -> None:
        q = run_stream(read_tx_stream(spark, "parquet", src, schema=MESSAGE_SCHEMA), sinks, scratch_path(spark, "rt-ckpt"),
                       trigger={"availableNow": True}, parallel_jobs=len(mb.MICROBATCH_ANALYTICS),
                       sink_options={"compression": "zstd"})
        run_to_completion(q)
    return _derived_table(spark, sf_dir, "rt-sinks", write, fresh)


def _sink(name: str, fresh: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return spark.read.parquet(f"{_consumer_sinks(spark, sf_dir, fresh)}/{name}").drop("batch_id")
    run.__name__ = f"stream_consumer_{name}"
    return run


# ---------------------------------------------------------------------------
# The poll chain (S11 -> S12 -> S13) and the consumer behind it.
# ---------------------------------------------------------------------------

POLLS = {"first": dt.datetime(2024, 1, 2), "polls": 60, "every": "12 hours", "frame": "1 day", "delay": "5 minutes"}
POLLED_SCHEMA = "poll_id bigint, message_no bigint, value string, timestamp timestamp"


def polled_messages(spark: SparkSession, sf_dir: str) -> str:
    """The messages of 60 polls with frames that overlap by half."""
    return _derived_table(spark, sf_dir, "polled",
                          lambda p: poll_messages(load_transactions(spark, sf_dir), **POLLS).write.options(**MESSAGE_FILES).parquet(p))


def q_poll_publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames -> pages of 100 -> JSON messages -> error filter -> decode -> explode -> flat rows."""
    ensure_utc(spark)
    raw = spark.read.schema(POLLED_SCHEMA).parquet(polled_messages(spark, sf_dir))
    good, _errors = error_envelope_filter(raw)
    keys = ("poll_id", "message_no")
    return zone_less(flatten_transaction(explode_transactions(decode_envelope(good, keep=keys), keep=keys), keep=keys))


def q_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer with dedup over overlapping polls; then all messages come again, and the stream starts again from
    its checkpoint. Returns the committed R01 output: every transaction once."""
    ensure_utc(spark)
    messages = spark.read.schema(POLLED_SCHEMA).parquet(polled_messages(spark, sf_dir))
    bus, sinks, ck = (scratch_path(spark, n) for n in ("dedup-bus", "dedup-sinks", "dedup-ckpt"))
    for epoch in range(2):
        publish_once(messages, "parquet", bus, epoch)
        q = run_stream(read_tx_stream(spark, "parquet", bus), sinks, ck, trigger={"availableNow": True}, dedup="1 day",
                       committed=True, parallel_jobs=len(mb.MICROBATCH_ANALYTICS),
                       state_partitions=partitions_for_input(spark, bus))
        run_to_completion(q)
    return CommitLog(spark, sinks).read("rt_transaction_type_count").drop("batch_id")


def _bus_landed(spark: SparkSession, sf_dir: str) -> str:
    """The polled messages decoded once, each transaction once: what the monitors of the bus read."""
    bus = polled_messages(spark, sf_dir)

    def write(path: str) -> None:
        run_to_completion(land_bus(read_tx_stream(spark, "parquet", bus, schema=POLLED_SCHEMA), path, scratch_path(spark, "bus-ckpt"),
                                   dedup="1 day", trigger={"availableNow": True}, state_partitions=partitions_for_input(spark, bus)))
    return _derived_table(spark, sf_dir, "bus-landed", write)


GAS_VIEW = {"granularity": "1 hour", "frame": "2 days"}


def q_gas_price_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P02 with the newest window first, open windows included."""
    ensure_utc(spark)
    base = scratch_path(spark, "gas-view")
    run_to_completion(run_gas_price_view(read_lake_stream(spark, _tx_stream_source(spark, sf_dir)), base, scratch_path(spark, "gas-view-ckpt"),
                                         watermark=STREAM_WATERMARK, trigger={"availableNow": True}, **GAS_VIEW))
    return zone_less(read_gas_price_view(spark, base))


# ---------------------------------------------------------------------------
# The ten outputs of the batch job (S06), committed together and read back.
# ---------------------------------------------------------------------------

def _job_output(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        base = _derived_table(spark, sf_dir, "batch-job",
                              lambda p: run_batch_job(load_transactions(spark, sf_dir), p, committed=True))
        return zone_less(CommitLog(spark, base).read(name))
    run.__name__ = f"batch_job_{name}"
    return run


#: Output of the job -> key of the query whose oracle it shares.
JOB_KEYS = {name: name for name in JOB_OUTPUTS} | {
    "efficiency_analysis": "fee_stats_by_type", "transaction_counts": "transaction_category_counts"}


STREAM_QUERIES: dict[str, Query] = {
    "tx_count_in_frame_stream": _stream(et.tx_count_stream, "tx_count_in_frame_stream", keyless=True),
    "gas_price_trend_stream": _stream(et.gas_price_trend_stream, "gas_price_trend_stream", keyless=True),
    "new_contracts_stream": _stream(et.new_contracts_stream, "new_contracts_stream", keyless=True),
    "large_transfers_stream": _stream(et.large_transfers_stream, "large_transfers_stream", stateful=False),
    "suspicious_activity_stream": _stream(et.suspicious_activity_stream, "suspicious_activity_stream"),
    "stream_consumer": _sink("rt_transaction_type_count", fresh=True),
    **{f"stream_consumer_{name}": _sink(name) for name in mb.MICROBATCH_ANALYTICS if name != "rt_transaction_type_count"},
    "poll_publish_round_trip": q_poll_publish_round_trip,
    "dedup_stream": q_dedup_stream,
    "tx_count_sliding_stream": _stream(et.tx_count_stream, "tx_count_sliding_stream", keyless=True),
    "new_contracts_sliding_stream": _stream(et.new_contracts_stream, "new_contracts_sliding_stream", keyless=True),
    "tx_count_on_bus_stream": _stream(et.tx_count_stream, "tx_count_on_bus_stream", keyless=True, on_bus=True),
    "gas_price_trend_on_bus_stream": _stream(et.gas_price_trend_stream, "gas_price_trend_on_bus_stream", keyless=True, on_bus=True),
    "suspicious_activity_on_bus_stream": _stream(et.suspicious_activity_stream, "suspicious_activity_on_bus_stream", on_bus=True),
    "gas_price_view": q_gas_price_view,
}

JOB_QUERIES: dict[str, Query] = {f"batch_job_{name}": _job_output(name) for name in JOB_OUTPUTS}

_POLL_END = f"TIMESTAMP '{POLLS['first']}' - INTERVAL '{POLLS['delay']}'"
POLL_ORACLE: dict[str, str] = {
    "poll_publish_round_trip": f"""
SELECT poll_id, CAST(place // 100 AS BIGINT) AS message_no, {_FLAT.format(t="CAST(transaction_type AS VARCHAR)")}
FROM (SELECT tx.*, poll_id, row_number() OVER (PARTITION BY poll_id ORDER BY block_timestamp DESC, hash) - 1 AS place
      FROM tx JOIN (SELECT range AS poll_id, {_POLL_END} + range * INTERVAL '{POLLS['every']}' AS till
                    FROM range({POLLS['polls']})) p
      ON block_timestamp BETWEEN till - INTERVAL '{POLLS['frame']}' AND till)""",
    "dedup_stream": f"""
SELECT CAST(transaction_type AS VARCHAR) AS txType, row_number() OVER (PARTITION BY transaction_type ORDER BY hash) AS running_count
FROM tx WHERE block_timestamp BETWEEN {_POLL_END} - INTERVAL '{POLLS['frame']}'
                                  AND {_POLL_END} + {POLLS['polls'] - 1} * INTERVAL '{POLLS['every']}'""",
}

_EMITTED = f"window_end <= (SELECT max(block_timestamp) FROM tx) - INTERVAL '{STREAM_WATERMARK}'"


def _win(width: str) -> str:
    unit = width.split()[1].rstrip("s")
    return (f"date_trunc('{unit}', block_timestamp) AS window_start, "
            f"date_trunc('{unit}', block_timestamp) + INTERVAL '{width}' AS window_end")


STREAM_ORACLE: dict[str, str] = {
    "tx_count_in_frame_stream": f"""
SELECT * FROM (SELECT {_win('1 hour')}, count(*) AS transaction_count FROM tx GROUP BY 1, 2)
WHERE {_EMITTED}""",
    "gas_price_trend_stream": f"""
SELECT * FROM (SELECT {_win('1 hour')}, {_mean('gas_price')} AS average_gas_price FROM tx GROUP BY 1, 2)
WHERE {_EMITTED}""",
    "new_contracts_stream": f"""
SELECT * FROM (SELECT {_win('1 day')}, count(*) AS contract_count,
                      {_mean('receipt_gas_used')} AS average_initial_gas_usage
               FROM tx WHERE to_address IS NULL AND input IS NOT NULL GROUP BY 1, 2)
WHERE {_EMITTED}""",
    "large_transfers_stream": f"""
SELECT hash AS transaction_id, value, block_timestamp FROM tx
WHERE value > {STREAM_PARAMS['large_transfers_stream']['threshold']!r}""",
    "suspicious_activity_stream": f"""
SELECT * FROM (SELECT {_win('1 day')}, from_address, to_address, count(*) AS transaction_count,
                      {_mean('gas_price')} AS average_gas_price
               FROM tx GROUP BY 1, 2, 3, 4
               HAVING count(*) > {STREAM_PARAMS['suspicious_activity_stream']['max_count']}
                   OR {_mean('gas_price')} > {STREAM_PARAMS['suspicious_activity_stream']['max_avg_gas_price']!r})
WHERE {_EMITTED}""",
}


#: What the polls bring to the bus, each transaction once.
_BUS = f"""(SELECT * FROM tx WHERE block_timestamp BETWEEN {_POLL_END} - INTERVAL '{POLLS['frame']}'
                                  AND {_POLL_END} + {POLLS['polls'] - 1} * INTERVAL '{POLLS['every']}')"""
_EMITTED_ON_BUS = f"window_end <= (SELECT max(block_timestamp) FROM {_BUS}) - INTERVAL '{STREAM_WATERMARK}'"


def _frames(rows: str, frame: str, slide: str, n: int) -> str:
    """``rows`` once for each of the ``n`` sliding frames that hold them."""
    return f"""(SELECT *, time_bucket(INTERVAL '{slide}', block_timestamp) - k * INTERVAL '{slide}' AS window_start,
        time_bucket(INTERVAL '{slide}', block_timestamp) - k * INTERVAL '{slide}' + INTERVAL '{frame}' AS window_end
      FROM {rows}, range({n}) AS slides(k))"""


STREAM_ORACLE |= {
    "tx_count_sliding_stream": f"""
SELECT window_start, window_end, count(*) AS transaction_count FROM {_frames('tx', '6 hours', '1 hour', 6)}
WHERE {_EMITTED} GROUP BY 1, 2""",
    "new_contracts_sliding_stream": f"""
SELECT window_start, window_end, count(*) AS contract_count, {_mean('receipt_gas_used')} AS average_initial_gas_usage
FROM {_frames('tx', '1 day', '6 hours', 4)}
WHERE {_EMITTED} AND to_address IS NULL AND input IS NOT NULL GROUP BY 1, 2""",
    "tx_count_on_bus_stream": f"""
SELECT * FROM (SELECT {_win('1 hour')}, count(*) AS transaction_count FROM {_BUS} GROUP BY 1, 2)
WHERE {_EMITTED_ON_BUS}""",
    "gas_price_trend_on_bus_stream": f"""
SELECT * FROM (SELECT {_win('1 hour')}, {_mean('gas_price')} AS average_gas_price FROM {_BUS} GROUP BY 1, 2)
WHERE {_EMITTED_ON_BUS}""",
    "suspicious_activity_on_bus_stream": f"""
SELECT window_start, window_end, from_address, to_address, count(*) AS transaction_count, {_mean('gas_price')} AS average_gas_price
FROM {_frames(_BUS, '1 day', '12 hours', 2)}
WHERE {_EMITTED_ON_BUS} GROUP BY 1, 2, 3, 4
HAVING count(*) > {STREAM_PARAMS['suspicious_activity_on_bus_stream']['max_count']}
    OR {_mean('gas_price')} > {STREAM_PARAMS['suspicious_activity_on_bus_stream']['max_avg_gas_price']!r}""",
    "gas_price_view": f"""
SELECT * FROM (SELECT {_win('1 hour')}, {_mean('gas_price')} AS average_gas_price FROM tx GROUP BY 1, 2)
WHERE window_start > (SELECT date_trunc('hour', max(block_timestamp)) FROM tx) - INTERVAL '{GAS_VIEW['frame']}'""",
}


def prepare_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Write the inputs Spark derives from ``sf_dir`` once (the landed lake, the
    message table, the transaction file stream); queries that read them reuse them."""
    _landed(spark, sf_dir)
    message_table(spark, sf_dir)
    _tx_stream_source(spark, sf_dir)
    polled_messages(spark, sf_dir)
    _bus_landed(spark, sf_dir)


def queries() -> dict[str, Query]:
    out = dict(BATCH_QUERIES)
    out.update(ENVELOPE_QUERIES)
    out.update(REALTIME_QUERIES)
    out.update(STREAM_QUERIES)
    out.update(JOB_QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {k: TX_CTE + v.strip() for k, v in BATCH_ORACLE.items()}
    out.update({k: v.strip() for k, v in ENVELOPE_ORACLE.items()})
    out.update({k: TX_CTE + v.strip() for k, v in REALTIME_ORACLE.items()})
    out.update({k: TX_CTE + v.strip() for k, v in STREAM_ORACLE.items()})
    out["stream_consumer"] = ENVELOPE_ORACLE["rt_transaction_type_count"].strip()
    out.update({k: ENVELOPE_ORACLE[k.removeprefix("stream_consumer_")].strip() for k in STREAM_QUERIES
                if k.startswith("stream_consumer_")})
    out.update({k: TX_CTE + v.strip() for k, v in POLL_ORACLE.items()})
    out.update({f"batch_job_{name}": out[key] for name, key in JOB_KEYS.items()})
    return out
