"""Faults of the first round: caps that lost rows, session zones, overflow, malformed times, sparse windows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import txlake.operators as ops
from conftest import SF_SMALL, df_multiset
from txlake.operators import realtime as rt
from txlake.session import scratch_path
from txlake.sources.envelope import encode_envelope, error_envelope_filter, flatten_transaction, poll_window_extract
from txlake.sources.fixtures import load_transactions
from txlake.sources.io import write_result
from txlake.sources.transactions import land_transactions, read_lake_stream
from txlake.streaming import eventtime as et
from txlake.streaming.runner import run_to_completion, write_stream


@pytest.fixture(scope="module")
def tx(spark):
    return load_transactions(spark, SF_SMALL).cache()


def streamed(spark, tx, fn, **options):
    """The rows that a monitor emits over ``tx`` written as eight files in no order of time."""
    src, out, ck = (scratch_path(spark, n) for n in ("unsorted", "out", "ck"))
    tx.repartition(8, "hash").write.parquet(src)
    stream = fn(read_lake_stream(spark, src, **options))
    run_to_completion(write_stream(stream, out, ck, trigger={"availableNow": True}))
    return spark.read.schema(stream.schema).parquet(out)


def test_unsorted_files_lose_nothing_by_default(spark, tx):
    out = streamed(spark, tx, lambda s: et.tx_count_stream(s, "1 hour", watermark="1 minute"))
    last = tx.agg(F.max("block_timestamp")).first()[0].replace(minute=0, second=0, microsecond=0)
    closed = tx.where(F.col("block_timestamp") < F.lit(last)).count()
    assert out.agg(F.sum("transaction_count")).first()[0] == closed


def test_a_cap_that_loses_rows_fails_loudly(spark, tx):
    with pytest.raises(RuntimeError, match="dropped"):
        streamed(spark, tx, lambda s: et.tx_count_stream(s, "1 hour", watermark="1 minute"), max_files_per_trigger=1)


def test_creation_window_closes_with_any_later_transaction(spark, tx):
    t0 = dt.datetime(2024, 1, 5)
    one = tx.limit(1).withColumn("input", F.lit("0x6000"))
    rows = one.withColumn("to_address", F.lit(None).cast("string")).withColumn("block_timestamp", F.lit(t0 + dt.timedelta(minutes=10)).cast("timestamp"))
    rows = rows.unionByName(one.withColumn("to_address", F.lit("0x1")).withColumn("block_timestamp", F.lit(t0 + dt.timedelta(hours=9)).cast("timestamp")))
    out = streamed(spark, rows, lambda s: et.new_contracts_stream(s, "1 hour", watermark="1 minute")).collect()
    assert [r.contract_count for r in out] == [1]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
def test_frames_in_another_session_zone(spark, tx, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    as_of = tx.agg(F.max(F.col("block_timestamp"))).first()[0]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        with_date = rt.in_frame(tx, as_of, "5 hours").count()
        without = rt.in_frame(tx.drop("date"), as_of, "5 hours").count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert with_date == without > 0


def test_gas_value_beyond_a_bigint(spark, tx):
    big = tx.limit(1).withColumn("gas", F.lit(30_000_000).cast("long")).withColumn("gas_price", F.lit(10**12).cast("long")).withColumn("message_id", F.lit(1))
    value = poll_window_extract(big, "2000-01-01", "2100-01-01").select("transaction.gasValue").first()[0]
    assert value == 30.0
    assert encode_envelope(big).count() == 1


def test_malformed_block_time_is_null(spark):
    kind = "transaction struct<hash:string,nonce:long,sender:struct<address:string>,to:struct<address:string>,gas:double,gasPrice:double,gasValue:double,txType:string,block:struct<timestamp:struct<iso8601:string>>>"
    row = (("0x1", 1, ("a",), ("b",), 1.0, 1.0, 1.0, "2", (("no time",),)),)
    assert flatten_transaction(spark.createDataFrame([row], kind)).first()["block_time"] is None


def test_errors_key_counts_whatever_its_value(spark):
    raw = spark.createDataFrame([(v,) for v in ('{"errors": null}', '{"errors": [1]}', '{"data": {"errors": 1}}', "garbage", None)], "value string")
    good, bad = error_envelope_filter(raw)
    assert sorted(r.value for r in bad.collect()) == ['{"errors": [1]}', '{"errors": null}']
    assert good.count() == 3


def test_landing_needs_all_columns(spark, tx):
    with pytest.raises(ValueError, match="gas_price"):
        land_transactions(tx.drop("gas_price"), scratch_path(spark, "bad"))


def test_one_target_for_all_results_is_refused(tx):
    with pytest.raises(ValueError, match="name"):
        write_result(tx, "a", fmt="jdbc", dbtable="t")


def test_running_sum_in_a_hot_hour_needs_few_offsets(spark, tx):
    hot = tx.withColumn("block_timestamp", F.timestamp_seconds(F.lit(1704438000) + F.pmod(F.xxhash64("hash"), F.lit(3600))))
    assert hot.select(F.minute("block_timestamp")).distinct().count() <= 60
    assert df_multiset(ops.cumulative_gas_in_hour(hot)) == df_multiset(ops.cumulative_gas_in_hour_window(hot))
