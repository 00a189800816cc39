"""Schemas and domain constants.

The batch table follows the documented 21-field transaction layout (plus the
optional ``last_modified`` column); the stream envelope is the nested JSON
shape published by the poller (one message = up to 100 transactions).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
WEI_PER_GWEI = 1e9
WEI_PER_ETH = 1e18
EUR_PER_ETH = 1851.0          # hard-coded exchange rate; exposed as ``eur_rate``
BLOCK_GAS_LIMIT = 30_000_000  # gas limit of one block
EMPTY_CALL_DATA = "0x"        # input of a plain value transfer
DEFAULT_TX_TYPE = "2"         # label for an empty / missing stream txType
TOP_N = 10                    # rows shown by the console reports
POLL_LIMIT = 100              # newest transactions per poll frame
POLL_FRAME = "10 minutes"     # poll frame length
POLL_DELAY = "5 minutes"      # frame end = now - 5 minutes
POLL_EVERY = "5 minutes"      # time between two polls
SIMPLE_TRANSFER = "simple_transfer"
CONTRACT_INTERACTION = "contract_interaction"

# Column names of the batch table.
DATE = "date"
HASH = "hash"
NONCE = "nonce"
TRANSACTION_INDEX = "transaction_index"
FROM_ADDRESS = "from_address"
TO_ADDRESS = "to_address"
VALUE = "value"
GAS = "gas"
GAS_PRICE = "gas_price"
INPUT = "input"
RECEIPT_CUMULATIVE_GAS_USED = "receipt_cumulative_gas_used"
RECEIPT_GAS_USED = "receipt_gas_used"
RECEIPT_CONTRACT_ADDRESS = "receipt_contract_address"
RECEIPT_STATUS = "receipt_status"
BLOCK_TIMESTAMP = "block_timestamp"
BLOCK_NUMBER = "block_number"
BLOCK_HASH = "block_hash"
MAX_FEE_PER_GAS = "max_fee_per_gas"
MAX_PRIORITY_FEE_PER_GAS = "max_priority_fee_per_gas"
TRANSACTION_TYPE = "transaction_type"
RECEIPT_EFFECTIVE_GAS_PRICE = "receipt_effective_gas_price"
LAST_MODIFIED = "last_modified"

_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

TX_FIELDS = [
    (DATE, _S),
    (HASH, _S),
    (NONCE, _L),
    (TRANSACTION_INDEX, _L),
    (FROM_ADDRESS, _S),
    (TO_ADDRESS, _S),
    (VALUE, _D),
    (GAS, _L),
    (GAS_PRICE, _L),
    (INPUT, _S),
    (RECEIPT_CUMULATIVE_GAS_USED, _L),
    (RECEIPT_GAS_USED, _L),
    (RECEIPT_CONTRACT_ADDRESS, _S),
    (RECEIPT_STATUS, _L),
    (BLOCK_TIMESTAMP, _TS),
    (BLOCK_NUMBER, _L),
    (BLOCK_HASH, _S),
    (MAX_FEE_PER_GAS, _L),
    (MAX_PRIORITY_FEE_PER_GAS, _L),
    (TRANSACTION_TYPE, _L),
    (RECEIPT_EFFECTIVE_GAS_PRICE, _L),
]

#: Documented transaction table (``date`` is the partition column, kept a string).
TX_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TX_FIELDS])

#: Same, with the optional ``last_modified`` column used by the speed analytic.
TX_SCHEMA_EXT = T.StructType(TX_SCHEMA.fields + [T.StructField(LAST_MODIFIED, _TS, True)])

_ADDR = T.StructType([T.StructField("address", _S, True)])

#: One transaction inside a stream envelope.
ENVELOPE_TX = T.StructType(
    [
        T.StructField(
            "block",
            T.StructType(
                [T.StructField("timestamp", T.StructType([T.StructField("iso8601", _S, True)]), True)]
            ),
            True,
        ),
        T.StructField("gas", _D, True),
        T.StructField("gasPrice", _D, True),
        T.StructField("gasValue", _D, True),
        T.StructField("hash", _S, True),
        T.StructField("nonce", _L, True),
        T.StructField("sender", _ADDR, True),
        T.StructField("to", _ADDR, True),
        T.StructField("txType", _S, True),
    ]
)

#: Whole message: ``{"data": {"ethereum": {"transactions": [...]}}}``.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "ethereum",
                        T.StructType([T.StructField("transactions", T.ArrayType(ENVELOPE_TX, True), True)]),
                        True,
                    )
                ]
            ),
            True,
        )
    ]
)

#: Raw record of the message bus (Kafka-shaped): payload plus broker time.
RAW_MESSAGE_SCHEMA = T.StructType([T.StructField("value", _S, True), T.StructField("timestamp", _TS, True)])
