"""Physical-plan properties the scale design depends on."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from txlake import operators as ops
from txlake.operators import realtime as rt
from txlake.plans.registry import exploded_batch
from txlake.session import scratch_path
from txlake.sources.fixtures import load_transactions
from txlake.sources.transactions import land_transactions, scan_transactions
from txlake.streaming import microbatch as mb


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    path = scratch_path(spark, "lake")
    land_transactions(load_transactions(spark, SF_SMALL), path, mode="overwrite")
    return path


def test_groupby_rewrites_have_no_window(spark, lake):
    tx = scan_transactions(spark, lake)
    for df in (ops.gas_usage_by_address(tx), ops.address_activity(tx), ops.hourly_gas_usage(tx)):
        p = plan(df)
        assert "Window" not in p
        assert "HashAggregate" in p


def test_r05_has_no_single_partition_exchange(spark):
    p = plan(mb.rt_nonce_summary(exploded_batch(spark, SF_SMALL)))
    assert "Window" not in p
    assert "Subquery" in p
    # Only the global aggregate's partial results (one row per task) meet in one partition.
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "functions=[partial_" in lines[i + 1]


def test_r01_r04_have_no_window(spark):
    b = exploded_batch(spark, SF_SMALL)
    for df in (mb.rt_transaction_type_count(b), mb.rt_transactions_by_sender(b)):
        assert "Window" not in plan(df)


def test_filters_and_columns_reach_the_scan(spark, lake):
    tx = scan_transactions(spark, lake)
    p = plan(ops.biggest_transactions(tx))
    assert "PushedFilters: [IsNotNull(value), Not(EqualTo(value,0.0))]" in p
    assert "TakeOrderedAndProject" in p
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "input" not in scan.split("ReadSchema:")[1]  # only the needed columns are read


def test_date_range_prunes_partitions(spark, lake):
    df = scan_transactions(spark, lake, "2024-01-10", "2024-01-12")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(date" in p
    assert {r.date for r in df.select("date").distinct().collect()} <= {"2024-01-10", "2024-01-11", "2024-01-12"}


def test_frame_filter_prunes_partitions(spark, lake):
    df = rt.tx_count_in_frame(scan_transactions(spark, lake), "2024-01-20 00:00:00", "2 days")
    assert "PartitionFilters" in plan(df)


def test_chunked_running_sum_does_not_partition_by_hour_only(spark, lake):
    p = plan(ops.cumulative_gas_in_hour(scan_transactions(spark, lake)))
    # The row-level exchange is keyed by the minute; the rows are not shuffled again.
    assert any("hashpartitioning(_day" in line and "_min" in line for line in p.splitlines())
