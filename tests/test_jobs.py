"""Landing, the ten-output batch job and the command-line entry points."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, df_multiset
from txlake import cli
from txlake import operators as ops
from txlake.plans.batch_job import JOB_OUTPUTS, run_batch_job
from txlake.session import scratch_path, sizing_conf
from txlake.sources.fixtures import load_transactions
from txlake.sources.transactions import scan_transactions


def _raw_files(spark):
    """Raw transaction files without the ``date`` column, as the public dataset ships them."""
    raw = scratch_path(spark, "raw")
    load_transactions(spark, SF_SMALL).drop("date", "last_modified").write.parquet(raw)
    return raw


def test_land_then_batch_job_from_cli(spark):
    raw, lake, out = _raw_files(spark), scratch_path(spark, "lake"), scratch_path(spark, "out")
    assert cli.main(["land", "--input", raw, "--output", lake, "--mode", "overwrite"]) == 0
    tx = scan_transactions(spark, lake)
    src = load_transactions(spark, SF_SMALL)
    assert tx.count() == src.count()
    # date was derived from block_timestamp (UTC) and is the partition column.
    assert tx.where(F.col("date") != F.date_format("block_timestamp", "yyyy-MM-dd")).count() == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert cli.main(["batch", "--input", lake, "--output", out, "--auto-size"]) == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for name in JOB_OUTPUTS:
        assert spark.read.parquet(f"{out}/{name}").count() > 0
    same_cols, same_rows = df_multiset(spark.read.parquet(f"{out}/block_utilization"))
    assert (same_cols, same_rows) == df_multiset(ops.block_utilization(src))


def test_landing_twice_with_overwrite_is_idempotent(spark):
    raw, lake = _raw_files(spark), scratch_path(spark, "lake")
    cli.main(["land", "--input", raw, "--output", lake, "--mode", "overwrite"])
    cli.main(["land", "--input", raw, "--output", lake, "--mode", "overwrite"])
    assert scan_transactions(spark, lake).count() == load_transactions(spark, SF_SMALL).count()


def test_batch_job_variants_agree(spark):
    tx = load_transactions(spark, SF_SMALL)
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    run_batch_job(tx, a, outputs=["most_active_pairs", "efficiency_analysis"], shared_scan=True, parallel_jobs=1)
    run_batch_job(tx, b, outputs=["most_active_pairs", "efficiency_analysis"])
    t = run_batch_job(tx, b, outputs=["transaction_counts"])
    assert t["categorized_rows"] == tx.count()
    for name in ("most_active_pairs", "efficiency_analysis"):
        assert df_multiset(spark.read.parquet(f"{a}/{name}")) == df_multiset(spark.read.parquet(f"{b}/{name}"))


def test_monitor_available_now(spark):
    lake, out = scratch_path(spark, "lake"), scratch_path(spark, "mon")
    load_transactions(spark, SF_SMALL).write.partitionBy("date").parquet(lake)
    assert cli.main(["monitor", "suspicious_activity", "--input", lake, "--output", out, "--frame", "1 day",
                     "--max-count", "1", "--max-avg-gas-price", "85e9", "--available-now"]) == 0
    got = spark.read.parquet(out)
    assert got.count() > 0
    assert got.where((F.col("transaction_count") <= 1) & (F.col("average_gas_price") <= 85e9)).count() == 0


def test_sizing_conf():
    conf = sizing_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(sizing_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_hot_date_is_split_across_files(spark):
    import glob
    from txlake.sources.transactions import land_transactions
    tx = load_transactions(spark, "/root/testdata/sf0.01")
    # Nine tenths of the rows on one date, read by several tasks (a shuffle is split by its map tasks).
    hot = tx.repartition(8, "hash").withColumn("block_timestamp", F.when(F.col("nonce") % 10 != 0, F.lit("2024-01-07 12:00:00")
                                                  .cast("timestamp")).otherwise(F.col("block_timestamp"))).drop("date")
    lake = scratch_path(spark, "hotlake")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 << 10))
    try:
        land_transactions(hot, lake, mode="overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    local = lake[len("file:"):] if lake.startswith("file:") else lake
    assert len(glob.glob(f"{local}/date=2024-01-07/*.parquet")) > 1
    assert scan_transactions(spark, lake).count() == tx.count()


def test_sql_views(spark):
    from txlake.plans.views import BATCH_VIEWS, register_views
    tx = load_transactions(spark, SF_SMALL)
    names = register_views(spark, tx, prefix="t_")
    assert len(names) == len(BATCH_VIEWS) + 2
    got = spark.sql("SELECT * FROM t_block_utilization WHERE utilization > 50")
    want = ops.block_utilization(tx).where("utilization > 50")
    assert df_multiset(got) == df_multiset(want)
    assert "Window" not in spark.sql("SELECT * FROM t_gas_usage_by_address")._jdf.queryExecution().executedPlan().toString()


def test_cli_stream_available_now(spark):
    from txlake.plans.registry import raw_messages
    from txlake.sources.io import publish_envelopes
    bus, sinks = scratch_path(spark, "bus"), scratch_path(spark, "sinks")
    publish_envelopes(raw_messages(spark, SF_SMALL), fmt="parquet", path=bus)
    assert cli.main(["stream", "--source-format", "parquet", "--source-path", bus, "--sink", sinks,
                     "--checkpoint", scratch_path(spark, "ck"), "--available-now", "--dead-letter"]) == 0
    assert spark.read.parquet(f"{sinks}/rt_nonce_summary").count() == load_transactions(spark, SF_SMALL).count()
