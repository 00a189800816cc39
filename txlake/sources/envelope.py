"""Stream envelopes: encode (S12), error filter (S13), decode (S04),
explode (S05) and the poller's frame extract (S11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.functions.units import floored
from txlake.operators.prefix import running_sum, split_crowded
from txlake.schema import (BLOCK_TIMESTAMP, ENVELOPE_SCHEMA, FROM_ADDRESS, GAS, GAS_PRICE, HASH, NONCE,
                           POLL_LIMIT, TO_ADDRESS, TRANSACTION_TYPE, WEI_PER_ETH)

MESSAGE_NO = "message_no"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


#: Keys with more rows are cut into pages without a task that holds a key's rows.
CROWDED_ROWS = 4096


def envelope_tx_struct(tx_type: Column | None = None, of=F.col) -> Column:
    """One transaction in the poller's nested shape; ``of`` gives the columns of the transaction table by name."""
    if tx_type is None:
        tx_type = of(TRANSACTION_TYPE).cast("string")
    return F.struct(
        F.struct(F.struct(F.date_format(of(BLOCK_TIMESTAMP), ISO_FORMAT).alias("iso8601")).alias("timestamp"))
        .alias("block"),
        of(GAS).cast("double").alias("gas"),
        of(GAS_PRICE).cast("double").alias("gasPrice"),
        # A decimal product: two bigints may exceed a bigint.
        ((of(GAS).cast("decimal(19,0)") * of(GAS_PRICE).cast("decimal(19,0)")).cast("double") / F.lit(WEI_PER_ETH))
        .alias("gasValue"),
        of(HASH).alias("hash"),
        of(NONCE).cast("long").alias("nonce"),
        F.struct(of(FROM_ADDRESS).alias("address")).alias("sender"),
        F.struct(of(TO_ADDRESS).alias("address")).alias("to"),
        tx_type.alias("txType"),
    )


def _hex_text(raw: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(raw)))


def packed_text(text: Column) -> Column:
    """A string as bytes for a shuffle: ``0x`` and lower-case hexadecimal digits at half the length, any other as it is."""
    raw = F.unhex(F.substring(text, 3, _LONGEST))
    return F.when(text == _hex_text(raw), F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpacked_text(packed: Column) -> Column:
    rest = F.substring(packed, 2, _LONGEST)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), _hex_text(rest)).otherwise(rest.cast("string"))


_LONGEST = (1 << 31) - 1


def paged(rows: DataFrame, keys: list[str], page_rows: int, split_rows: int | None = None) -> DataFrame:
    """Adds ``message_no`` to rows of ``_tx``, ``_ts`` and ``_hash``: newest first, ``page_rows`` rows a page, from 0 for each key.

    Rows are counted by instant and, in crowded instants, by the first digits of the hash, so no task holds a key. They
    travel with the hash as bytes and the time as part of their bucket."""
    ids = [f"_key{i}" for i in range(len(keys))]
    # Newest first; rows without a time are the oldest.
    known = {i: F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for i, k in zip(ids, keys)}
    oldest = F.lit((1 << 63) - 1)
    rows = rows.withColumns({**known, "_back": F.coalesce(-F.unix_micros("_ts"), oldest)})
    rows = rows.withColumn("_day", floored(F.col("_back"), 86_400_000_000))
    rows = split_crowded(rows, [*ids, "_day", "_back"], "_hash", split_rows).drop("_crowded")
    kinds, dealt = {f.name: f.dataType for f in rows.schema}, rows
    if isinstance(kinds["_hash"], T.StringType) and isinstance(kinds["_ts"], T.TimestampType):
        dealt = rows.withColumn("_hash", packed_text(F.col("_hash"))).drop("_ts").repartition(*ids, "_day", "_back", "_part")
        dealt = dealt.withColumns({"_hash": unpacked_text(F.col("_hash")),
                                   "_ts": F.when(F.col("_back") != oldest, F.timestamp_micros(-F.col("_back")))})
    order = [F.col("_hash").asc_nulls_first()]
    counted = running_sum(dealt, ids, [["_day"], ["_back", "_part"]], order, F.lit(1).cast("long"), "_place", rows)
    return counted.withColumn(MESSAGE_NO, floored(F.col("_place") - 1, page_rows))


def encode_envelope(rows: DataFrame, message_key: str | list[str] | None = "message_id",
                    tx_type: Column | None = None, page_rows: int | None = POLL_LIMIT) -> DataFrame:
    """Pack transactions into JSON messages ``{"data":{"ethereum":{"transactions":[...]}}}``.

    ``rows`` are transaction-table rows or carry nested transactions in a column ``transaction`` (as
    :func:`poll_window_extract` gives them). A message holds rows of one ``message_key`` value (a column, several, or
    None for all rows), transactions newest first (as the
    poller returns them), plus ``timestamp`` = newest block time. The rows of a key are cut into messages of at most
    ``page_rows`` transactions, numbered by ``message_no`` from the newest on; with ``page_rows=None`` the key itself must
    bound the message. The key columns are kept; drop them for a bus record of ``value, timestamp``.
    """
    keys = [] if message_key is None else [message_key] if isinstance(message_key, str) else list(message_key)
    nested = "transaction" in rows.columns
    if nested:
        tx = F.col("transaction")
        ts, hash_ = F.try_to_timestamp("transaction.block.timestamp.iso8601"), F.col("transaction.hash")
    else:
        # The flat columns travel, and the nested shape is made of them where a message is put together.
        carried = [GAS, GAS_PRICE, NONCE, FROM_ADDRESS, TO_ADDRESS]
        texts = {f.name for f in rows.select(*carried, HASH).schema if isinstance(f.dataType, T.StringType)}
        fields = [(packed_text(F.col(c)) if c in texts else F.col(c)).alias(c) for c in carried]
        tx = F.struct(*fields, (F.col(TRANSACTION_TYPE).cast("string") if tx_type is None else tx_type).alias("_type"))
        ts, hash_ = F.col(BLOCK_TIMESTAMP), F.col(HASH)
    short_hash = not nested and HASH in texts

    def hash_of(row: Column) -> Column:
        return unpacked_text(row["hash"]) if short_hash else row["hash"]

    def transaction_of(row: Column) -> Column:
        if nested:
            return row["tx"]

        def column(name: str) -> Column:
            if name in (HASH, BLOCK_TIMESTAMP):
                return hash_of(row) if name == HASH else row["ts"]
            return unpacked_text(row["tx"][name]) if name in texts else row["tx"][name]
        return envelope_tx_struct(row["tx"]["_type"], column)

    flat = rows.select(*keys, tx.alias("_tx"), ts.alias("_ts"), hash_.alias("_hash"))
    row = F.struct(F.col("_ts").alias("ts"), (packed_text(F.col("_hash")) if short_hash else F.col("_hash")).alias("hash"), F.col("_tx").alias("tx"))

    def together(numbered: DataFrame) -> DataFrame:
        return numbered.groupBy(*keys, MESSAGE_NO).agg(F.collect_list(row).alias("_page"))

    if page_rows is None:
        pages = together(flat.withColumn(MESSAGE_NO, F.lit(0).cast("long")))
    elif not keys:
        pages = together(paged(flat, keys, int(page_rows)))
    else:
        # Most keys fit into a task: their rows are shuffled once and cut there. The broadcast table has at most one
        # row for every CROWDED_ROWS.
        crowded = flat.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(CROWDED_ROWS, int(page_rows)))
        crowded = F.broadcast(crowded.select(*[F.col(k).alias(f"_crowded{i}") for i, k in enumerate(keys)]))
        same = [flat[k].eqNullSafe(F.col(f"_crowded{i}")) for i, k in enumerate(keys)]
        few = flat.join(crowded, same, "left_anti").groupBy(*keys).agg(F.collect_list(row).alias("_rows"))
        pages = cut(few, keys, int(page_rows), hash_of).unionByName(together(paged(flat.join(crowded, same, "left_semi"), keys, int(page_rows))))
    txs = F.transform("_page", transaction_of)
    txs = F.sort_array(F.filter(txs, lambda t: t.isNotNull()) if nested else txs, asc=False)
    value = F.to_json(F.struct(F.struct(F.struct(txs.alias("transactions")).alias("ethereum")).alias("data")))
    return pages.select(*keys, MESSAGE_NO, value.alias("value"), F.array_max(F.transform("_page", lambda r: r["ts"])).alias("timestamp"))


def cut(groups: DataFrame, keys: list[str], page_rows: int, hash_of) -> DataFrame:
    """The ``_rows`` of each key as pages (``_page``) in the order of :func:`paged`, numbered by ``message_no``."""
    back = lambda r: F.coalesce(-F.unix_micros(r["ts"]), F.lit((1 << 63) - 1))
    ordered = F.sort_array(F.transform("_rows", lambda r: F.struct(back(r).alias("back"), hash_of(r).alias("text"), r.alias("row"))))
    # The variable of a lambda is computed once: the rows are not sorted again for each page.
    pages = F.transform(F.array(ordered), lambda rows: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / page_rows).cast("int")),
        lambda i: F.transform(F.slice(rows, i * page_rows + 1, F.lit(page_rows)), lambda r: r["row"])))[0]
    found = groups.select(*keys, F.posexplode(pages).alias("_no", "_page"))
    return found.select(*keys, F.col("_no").cast("long").alias(MESSAGE_NO), "_page")


def error_response(message: Column) -> Column:
    """JSON of an API error response (what the poller must not publish)."""
    return F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("errors")))


def is_error_envelope(value: Column) -> Column:
    """Is there a top-level ``errors`` key, whatever its value? False for text that is no JSON object."""
    keys = F.json_object_keys(value.cast("string"))
    return F.coalesce(F.array_contains(keys, "errors"), F.lit(False))


def error_envelope_filter(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw messages into (publishable, dead-letter) by the ``errors`` key."""
    err = is_error_envelope(F.col(value_col))
    return raw.where(~err), raw.where(err)


def decode_envelope(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """bytes/string payload -> parsed struct ``data``; NULL parses dropped.

    ``from_json`` is NULL exactly for a NULL or blank (JSON whitespace only)
    payload, so those are filtered on the raw text: a filter on the parsed
    column would be pushed below the projection and parse every message
    twice. Malformed text yields a struct with NULL ``data`` (kept here,
    dropped by the explode), exactly as the reference's NULL filter behaves.
    """
    keep_cols = [F.col(k) for k in keep if k in raw.columns]
    text = F.col(value_col).cast("string")
    present = raw.where(text.isNotNull() & text.rlike(r"[^ \t\n\r]"))
    return present.select(F.from_json(text, ENVELOPE_SCHEMA).alias("data"), *keep_cols)


def undecodable(decoded: DataFrame) -> DataFrame:
    """Dead-letter view: parsed rows without a transactions array."""
    return decoded.where(F.col("data.data.ethereum.transactions").isNull())


def explode_transactions(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per transaction, column ``transaction`` (NULL/empty arrays vanish)."""
    keep_cols = [F.col(k) for k in keep if k in decoded.columns]
    return decoded.select(F.explode(F.col("data.data.ethereum.transactions")).alias("transaction"), *keep_cols)


def flatten_transaction(exploded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat columns of an exploded transaction; ``block_time`` parsed from ISO-8601."""
    t = "transaction."
    keep_cols = [F.col(k) for k in keep if k in exploded.columns]
    return exploded.select(
        F.col(t + "hash").alias("hash"),
        F.col(t + "nonce").alias("nonce"),
        F.col(t + "sender.address").alias("sender"),
        F.col(t + "to.address").alias("receiver"),
        F.col(t + "gas").alias("gas"),
        F.col(t + "gasPrice").alias("gasPrice"),
        F.col(t + "gasValue").alias("gasValue"),
        F.col(t + "txType").alias("txType"),
        F.try_to_timestamp(F.col(t + "block.timestamp.iso8601")).alias("block_time"),
        *keep_cols,
    )


def poll_window_extract(tx: DataFrame, since, till, limit: int | None = POLL_LIMIT) -> DataFrame:
    """Transactions with ``since <= block_timestamp <= till``, newest first,
    at most ``limit`` (the poller's page), in the nested envelope shape.

    The time filter reaches the Parquet scan; ``orderBy().limit()`` is a
    per-task top-k, so only ``limit`` x tasks rows are merged.
    """
    ts = F.col(BLOCK_TIMESTAMP)
    lo, hi = F.to_timestamp(F.lit(since)), F.to_timestamp(F.lit(till))
    df = tx.where((ts >= lo) & (ts <= hi))
    if limit is not None:
        df = df.orderBy(ts.desc(), F.col(HASH).asc()).limit(int(limit))
    return df.select(envelope_tx_struct().alias("transaction"))
