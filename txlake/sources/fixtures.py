"""Deterministic mapping of the driver's ``events`` table onto the transaction
schema (and onto stream envelopes).

Each expression is SQL text that Spark and DuckDB both evaluate to the same
value, so the oracle queries reuse the very same text as a CTE. Integer ``/``
is avoided where the engines differ; products stay far below 2^63.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed values of the fixture mapping (must be identical in both engines).
TX_FROM_EVENTS = [
    ("date", "substr(cast(cast(ts as date) as varchar(10)), 1, 10)"),
    ("hash", "concat('0x', md5(concat('t', cast(event_id as varchar(20)))))"),
    ("nonce", "cast(event_id % 97 as bigint)"),
    ("transaction_index", "cast(event_id % 10 as bigint)"),
    ("from_address", "concat('0x', md5(concat('a', cast(user_id as varchar(20)))))"),
    ("to_address", "case when event_type = 'signup' and event_id % 3 = 0 then null "
                   "else concat('0x', md5(concat('a', cast((user_id * 7 + event_id) % 150 as varchar(20))))) end"),
    ("value", "case when event_type in ('error', 'view') then 0.0e0 else value * 1e18 end"),
    ("gas", "cast(21000 + (event_id * 7919) % 1000000 as bigint)"),
    ("gas_price", "cast(1000000000 + 1000000000 * ((event_id * 104729) % 90) as bigint)"),
    ("input", "case when event_type in ('purchase', 'view') then '0x' "
              "when event_type = 'click' and event_id % 11 = 0 then null else concat('0x', md5(event_type)) end"),
    ("receipt_cumulative_gas_used", "cast((event_id % 10 + 1) * 500000 + event_id % 1000 as bigint)"),
    ("receipt_gas_used", "cast(21000 + (event_id * 7919) % 1000000 - (event_id * 31) % 21000 as bigint)"),
    ("receipt_contract_address", "case when event_type = 'signup' and event_id % 3 = 0 "
                                 "then concat('0x', md5(concat('c', cast(event_id as varchar(20))))) else null end"),
    ("receipt_status", "cast(case when event_type = 'error' then 0 else 1 end as bigint)"),
    ("block_timestamp", "ts"),
    ("block_number", "cast(17000000 + (event_id - event_id % 10) / 10 as bigint)"),
    ("block_hash", "concat('0x', md5(concat('b', cast(event_id - event_id % 10 as varchar(20)))))"),
    ("max_fee_per_gas", "cast(case when event_id % 3 = 0 then null "
                        "else 40000000000 + (event_id * 15485863) % 60000000000 end as bigint)"),
    ("max_priority_fee_per_gas", "cast(case when event_id % 3 = 0 then null else 1000000000 + event_id % 1000 end as bigint)"),
    ("transaction_type", "cast(event_id % 3 as bigint)"),
    ("receipt_effective_gas_price", "cast(1000000000 + 1000000000 * ((event_id * 104729) % 90) as bigint)"),
    ("last_modified", "ts + interval '1' minute * (event_id % 30)"),
]

# Stream-envelope view of a transaction (F3). ``message_id`` groups up to 100
# consecutive events into one message; ``txType`` carries '' and NULL cases.
ENVELOPE_FROM_EVENTS = [
    ("message_id", "cast((event_id - event_id % 100) / 100 as bigint)"),
    ("txType", "case when event_id % 13 = 0 then '' when event_id % 17 = 0 then null "
               "else cast(event_id % 3 as varchar(4)) end"),
]


def tx_sql_select() -> str:
    """``SELECT`` list of the mapping (for an oracle CTE over ``events``)."""
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in TX_FROM_EVENTS)


def tx_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transactions derived row by row from ``events`` (narrow projection, no shuffle).

    ``block_timestamp``/``last_modified`` are cast from ``timestamp_ntz`` to
    ``timestamp`` (session zone UTC) so that watermarks accept them.
    """
    cols = [F.expr(expr).alias(name) for name, expr in TX_FROM_EVENTS]
    cols += [F.col(k) for k in keep]
    out = events.select(*cols)
    return out.withColumns({
        "block_timestamp": F.col("block_timestamp").cast("timestamp"),
        "last_modified": F.col("last_modified").cast("timestamp"),
    })


def envelope_rows_from_events(events: DataFrame) -> DataFrame:
    """Flat rows carrying everything a stream envelope needs, plus ``message_id``."""
    tx = tx_from_events(events, keep=("event_id",))
    extra = [F.expr(expr).alias(name) for name, expr in ENVELOPE_FROM_EVENTS]
    return tx.select("*", *extra)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_transactions(spark, sf_dir: str) -> DataFrame:
    return tx_from_events(read_table(spark, sf_dir, "events"))
