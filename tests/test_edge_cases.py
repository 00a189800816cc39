"""Hand-made rows (FIXTURES F4): NULLs, overflow-size products, empty input, ties."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from txlake import operators as ops
from txlake.schema import RAW_MESSAGE_SCHEMA, TX_SCHEMA_EXT
from txlake.sources.envelope import decode_envelope, explode_transactions, flatten_transaction, undecodable
from txlake.streaming import microbatch as mb


def tx_rows(spark, rows):
    """Build transaction rows from partial dicts (missing fields NULL)."""
    names = [f.name for f in TX_SCHEMA_EXT.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TX_SCHEMA_EXT)


T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_overflow_size_fee_is_exact(spark):
    df = tx_rows(spark, [{"hash": "0xa", "gas": 30_000_000, "gas_price": 10**12}])
    r = ops.gas_pricing(df).collect()[0]
    assert r.total_gas_cost_wei == Decimal(30_000_000 * 10**12)
    assert r.gas_price_gwei == 30_000_000 * 10**12 / 1e9


def test_zero_gas_price_gives_null_ratio(spark):
    df = tx_rows(spark, [{"transaction_type": 2, "receipt_gas_used": 21000, "gas_price": 0}])
    assert ops.fee_stats_by_type(df).collect()[0].efficiency_ratio is None


def test_only_successful_rows(spark):
    df = tx_rows(spark, [{"receipt_status": 1}, {"receipt_status": 1}])
    r = ops.failed_transaction_pct(df).collect()[0]
    assert (r.failed_pct, r.failed_count, r.success_count) == (0.0, 0, 2)


def test_empty_table_percentages_are_null(spark):
    df = tx_rows(spark, [])
    assert ops.failed_transaction_pct(df).collect()[0].failed_pct is None
    r = ops.contract_vs_transfer_pct(df).collect()[0]
    assert r.contract_interaction_pct is None and r.simple_transfer_pct is None
    assert ops.avg_gas_price(df).collect()[0].avg_gas_price_gwei is None


def test_other_status_values_do_not_shift_counts(spark):
    # The reference read group rows by position; a third status would break it.
    df = tx_rows(spark, [{"receipt_status": 0}, {"receipt_status": 1}, {"receipt_status": 1}, {"receipt_status": None}])
    r = ops.failed_transaction_pct(df).collect()[0]
    assert (r.failed_count, r.success_count) == (1, 2)
    assert r.failed_pct == pytest.approx(33.3333)


def test_same_hour_on_two_dates_takes_larger_day(spark):
    df = tx_rows(spark, [
        {"hash": "0x1", "block_timestamp": T0, "receipt_cumulative_gas_used": 5},
        {"hash": "0x2", "block_timestamp": T0 + dt.timedelta(minutes=1), "receipt_cumulative_gas_used": 7},
        {"hash": "0x3", "block_timestamp": T0 + dt.timedelta(days=1), "receipt_cumulative_gas_used": 20},
    ])
    fast = {r.hour: r.total_gas_used for r in ops.hourly_gas_usage(df).collect()}
    exact = {r.hour: r.total_gas_used for r in ops.hourly_gas_usage(df, assume_non_negative=False).collect()}
    assert fast == exact == {10: 20}


def test_tied_timestamps_keep_hourly_max(spark):
    df = tx_rows(spark, [{"hash": f"0x{i}", "block_timestamp": T0, "receipt_cumulative_gas_used": i} for i in range(5)])
    assert ops.hourly_gas_usage(df).collect()[0].total_gas_used == 10
    cum = sorted(r.cumulative_gas_used for r in ops.cumulative_gas_in_hour(df).collect())
    assert cum == [0, 1, 3, 6, 10]


def test_running_sum_with_nulls_matches_window(spark):
    rows = [{"hash": f"0x{i:02x}", "block_timestamp": T0 + dt.timedelta(seconds=i // 3),
             "receipt_cumulative_gas_used": None if i % 4 == 0 else i} for i in range(20)]
    rows.append({"hash": None, "block_timestamp": T0, "receipt_cumulative_gas_used": 3})
    # Rows without a block time form their own running-sum group (hour NULL).
    rows += [{"hash": "0xn1", "block_timestamp": None, "receipt_cumulative_gas_used": 5},
             {"hash": "0xn2", "block_timestamp": None, "receipt_cumulative_gas_used": 7},
             {"hash": "0xn3", "block_timestamp": None, "receipt_cumulative_gas_used": None}]
    df = tx_rows(spark, rows)
    a = sorted(map(tuple, ops.cumulative_gas_in_hour(df).collect()), key=str)
    b = sorted(map(tuple, ops.cumulative_gas_in_hour_window(df).collect()), key=str)
    assert a == b


def test_self_transfer_counts_twice_and_null_receiver_group(spark):
    df = tx_rows(spark, [{"from_address": "0xa", "to_address": "0xa"}, {"from_address": "0xb", "to_address": None}])
    got = {r.from_address: r["count"] for r in ops.address_transaction_volume(df).collect()}
    assert got == {"0xa": 2, "0xb": 1, None: 1}
    assert {r.from_address: r["count"] for r in ops.address_transaction_volume(df, method="union").collect()} == got


def test_null_input_categories(spark):
    df = tx_rows(spark, [{"input": None}, {"input": "0x"}, {"input": "0xab"}])
    got = {r.type: r["count"] for r in ops.transaction_category_counts(df).collect()}
    assert got == {"contract_interaction": 2, "simple_transfer": 1}
    r = ops.contract_vs_transfer_pct(df).collect()[0]  # NULL input is in neither share
    assert (r.contract_interaction_pct, r.simple_transfer_pct) == (50.0, 50.0)


def _raw(spark, values):
    return spark.createDataFrame([(v, T0) for v in values], RAW_MESSAGE_SCHEMA)


def test_malformed_error_empty_and_bad_scalar_messages(spark):
    good = ('{"data":{"ethereum":{"transactions":[{"hash":"0x1","nonce":"x","txType":"0x7e",'
            '"sender":{"address":"0xs"},"gas":21000}]}}}')
    raw = _raw(spark, [good, "not json", '{"errors":[{"message":"limit"}]}', None, ""])
    dec = decode_envelope(raw)
    # NULL and empty strings parse to NULL and are dropped; garbage / error bodies are kept with NULL data.
    assert dec.count() == 3
    assert undecodable(dec).count() == 2
    flat = flatten_transaction(explode_transactions(dec)).collect()
    assert len(flat) == 1
    assert flat[0].nonce is None and flat[0].txType == "0x7e" and flat[0].gas == 21000.0


def test_type_label_keeps_strings_and_maps_empty(spark):
    raw = _raw(spark, ['{"data":{"ethereum":{"transactions":[{"hash":"0x1","txType":"0x7e"},'
                       '{"hash":"0x2","txType":""},{"hash":"0x3"},{"hash":"0x4","txType":"2"}]}}}'])
    batch = explode_transactions(decode_envelope(raw))
    got = sorted(map(tuple, mb.rt_transaction_type_count(batch).collect()))
    assert got == [("0x7e", 1), ("2", 1), ("2", 1), ("2", 1)]
    assert got == sorted(map(tuple, mb.rt_transaction_type_count_window(batch).collect()))


def test_top_k_ties_broken_by_hash(spark):
    df = tx_rows(spark, [{"hash": f"0x{i}", "gas": 1, "gas_price": 10**9, "value": 1.0} for i in range(5)])
    got = [r.hash for r in ops.biggest_transactions(df, n=3).collect()]
    assert got == ["0x0", "0x1", "0x2"]


def test_unit_conversion_values(spark):
    df = tx_rows(spark, [{"gas": 21000, "gas_price": 2 * 10**10, "value": 1e18}])
    r = ops.unit_conversions(df).collect()[0]
    assert r.gas_price_gwei == 20.0
    assert r.eth_transfered == 1.0
    assert r.euro_transfered == 1851.0
    assert r.gas_price_total_units_euro == pytest.approx(round(2e10 / 1e18 * 1851 * 21000, 2))


def test_speed_by_gas_price(spark):
    df = tx_rows(spark, [
        {"gas_price": 10**9, "block_timestamp": T0, "last_modified": T0 + dt.timedelta(seconds=30)},
        {"gas_price": 10**9, "block_timestamp": T0, "last_modified": T0 + dt.timedelta(seconds=60)},
    ])
    r = ops.transaction_speed_by_gas_price(df).collect()[0]
    assert (r.gas_price_gwei, r.average_duration) == (1.0, 45.0)


def test_block_utilization_threshold(spark):
    df = tx_rows(spark, [{"block_number": 1, "receipt_gas_used": 15_000_000},
                         {"block_number": 2, "receipt_gas_used": 3_000_000}])
    got = {r.block_number: r.utilization for r in ops.block_utilization(df, min_utilization=40).collect()}
    assert got == {1: 50.0}


def test_frame_is_inclusive(spark):
    from txlake.operators import realtime as rt
    df = tx_rows(spark, [{"block_timestamp": T0}, {"block_timestamp": T0 - dt.timedelta(hours=1)},
                         {"block_timestamp": T0 - dt.timedelta(hours=1, seconds=1)}])
    got = rt.tx_count_in_frame(df, "2024-01-01 10:00:00", "1 hour").collect()[0].transaction_count
    assert got == 2


def test_exact_sum_and_mean_against_python_ints(spark):
    from decimal import Decimal as D
    from txlake.functions.units import exact_mean, exact_sum
    vals = [(1, 2**40 + 12345), (1, -(2**40) - 7), (1, None), (1, 999_999_999_999), (2, -1), (2, -(2**20)), (3, None)]
    df = spark.createDataFrame(vals, "k int, x long")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}
    for k in (1, 2):
        xs = [x for kk, x in vals if kk == k and x is not None]
        assert got[k][0] == D(sum(xs))
        assert got[k][1] == float(sum(xs)) / len(xs)
    assert got[3] == (None, None)


def test_decode_filter_equals_from_json_not_null(spark):
    from pyspark.sql import functions as F
    from txlake.schema import ENVELOPE_SCHEMA
    vals = [None, "", " ", "  \n", "\t", "\r\n", "\f", "null", "garbage", "{}", "[]", "1", '{"data":null}', "{bad",
            ' {"data":{"ethereum":{"transactions":[{"hash":"0x1"}]}}} ']
    raw = _raw(spark, vals)
    want = sorted(str(r.value) for r in raw.where(F.from_json("value", ENVELOPE_SCHEMA).isNotNull()).collect())
    got = decode_envelope(raw, keep=("timestamp", "value"))
    assert sorted(str(r.value) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1  # parsed once


def test_gas_pricing_sorted_and_poll_extract_without_limit(spark):
    from pyspark.sql import functions as F
    from conftest import SF_SMALL
    from txlake.sources.envelope import poll_window_extract
    from txlake.sources.fixtures import load_transactions
    tx = load_transactions(spark, SF_SMALL)
    eur = [r.gas_price_euro for r in ops.gas_pricing(tx, sort=True).collect()]
    assert eur == sorted(eur, reverse=True) and len(eur) == tx.count()
    since, till = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
    allrows = poll_window_extract(tx, since, till, limit=None)
    n = tx.where(F.col("block_timestamp").between(F.lit(since).cast("timestamp"), F.lit(till).cast("timestamp"))).count()
    assert allrows.count() == n > 0
    assert poll_window_extract(tx, since, till, limit=5).count() == min(5, n)


def test_hourly_gas_usage_refuses_negative_values_on_the_fast_path(spark):
    df = tx_rows(spark, [{"hash": "0x1", "block_timestamp": T0, "receipt_cumulative_gas_used": 5},
                         {"hash": "0x2", "block_timestamp": T0 + dt.timedelta(minutes=1), "receipt_cumulative_gas_used": -3}])
    with pytest.raises(Exception, match="assume_non_negative"):
        ops.hourly_gas_usage(df).collect()
    # Exact path: running sums 5, 2 -> peak 5 (the group sum would say 2).
    assert ops.hourly_gas_usage(df, assume_non_negative=False).collect()[0].total_gas_used == 5
