"""The poll chain, dedup in the consumer, commits, landing twice, running sums of a hot instant, the stream listener, the bench."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, df_multiset
from txlake import cli
from txlake.operators import blocks
from txlake.operators.prefix import running_sum, split_crowded
from txlake.plans import batch_job
from txlake.plans.batch_job import JOB_OUTPUTS, run_batch_job
from txlake.session import scratch_path
from txlake.sources import commits
from txlake.sources.commits import APPEND, CommitLog
from txlake.sources.envelope import decode_envelope, encode_envelope, explode_transactions, flatten_transaction, paged, poll_window_extract
from txlake.sources.fixtures import load_transactions
from txlake.sources.io import read_tx_stream
from txlake.sources.poll import Poller, poll_messages, polled, publish_once
from txlake.sources.transactions import land_folder, land_transactions, scan_transactions
from txlake.streaming import eventtime as et
from txlake.streaming import microbatch as mb
from txlake.streaming.runner import late_rows, make_batch_writer, run_stream, run_to_completion, run_totals, write_stream


@pytest.fixture(scope="module")
def tx(spark):
    return load_transactions(spark, SF_SMALL).cache()


def hot_second(tx):
    """Two thirds of the rows in one second."""
    at = F.lit("2024-01-07 12:00:05").cast("timestamp")
    return tx.withColumn("block_timestamp", F.when(F.col("nonce") % 3 != 0, at).otherwise(F.col("block_timestamp")))


# -- running sums ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("split_rows", [None, 60, 3])
def test_running_gas_of_a_hot_second(tx, split_rows):
    hot = hot_second(tx).withColumn("receipt_cumulative_gas_used", F.when(F.col("nonce") % 5 != 0, F.col("receipt_cumulative_gas_used")))
    want = df_multiset(blocks.cumulative_gas_in_hour_window(hot))
    assert df_multiset(blocks.cumulative_gas_in_hour(hot, split_rows=split_rows)) == want
    assert df_multiset(blocks.cumulative_gas_in_hour(hot, split_rows=split_rows, collapse_copies=True)) == want


def test_a_hot_second_is_spread_over_buckets(tx):
    rows = hot_second(tx).select(F.lit(1).alias("k"), "hash", F.col("block_timestamp").alias("t"))
    parts = split_crowded(rows.withColumn("t", F.unix_micros("t")), ["k", "t"], "hash", limit=20).groupBy("k", "t", "_part").count()
    assert parts.agg(F.max("count")).first()[0] <= 20


def test_running_sum_of_nulls_and_missing_hashes(spark):
    rows = spark.createDataFrame([(1, 0, None, None), (1, 0, "", 2), (1, 1, "b", None), (2, 0, "a", None)], "k int, b int, hash string, v long")
    got = running_sum(rows, ["k"], [["b"]], [F.col("hash").asc_nulls_first()], F.col("v"), "s")
    found = {(r.k, r.b, r.hash): r.s for r in got.collect()}
    assert found == {(1, 0, None): None, (1, 0, ""): 2, (1, 1, "b"): 2, (2, 0, "a"): None}


@pytest.mark.parametrize("split_rows", [None, 40, 1])
def test_ranks_of_a_sender_with_most_rows(spark, tx, split_rows):
    from pyspark.sql import Window
    t = "transaction."
    batch = explode_transactions(decode_envelope(encode_envelope(tx.withColumn("message_id", F.lit(1)))))
    hot = F.col("transaction.nonce") % 3 != 0
    value = F.when(F.col("transaction.nonce") % 17 == 0, F.lit(None)).when(F.col("transaction.nonce") % 13 == 0, F.lit(0.5)).otherwise(F.col("transaction.gasValue"))
    odd = F.when(F.col("transaction.nonce") % 31 == 1, F.lit(float("nan"))).when(F.col("transaction.nonce") % 29 == 1, -value).otherwise(value)
    sender = F.when(hot, F.struct(F.lit("0xhot").alias("address"))).otherwise(F.struct(F.when(F.col("transaction.nonce") > 5, F.col("transaction.sender.address")).alias("address")))
    batch = batch.select(F.col("transaction").withField("sender", sender).withField("gasValue", odd).alias("transaction")).cache()
    w = Window.partitionBy(t + "sender.address").orderBy(F.col(t + "gasValue").desc_nulls_last())
    want = batch.select(F.col(t + "hash").alias("hash"), F.col(t + "gasValue").alias("gasValue"), F.rank().over(w).cast("long").alias("gas_value_rank"))
    got = mb.rt_transactions_value(batch, "sender.address", split_rows=split_rows)
    assert df_multiset(got) == df_multiset(want)
    assert df_multiset(mb.rt_transactions_value(batch, "sender.address", top=4, split_rows=split_rows)) == df_multiset(want.where("gas_value_rank <= 4"))


# -- the poll chain ----------------------------------------------------------------------------------------------------

def flat(messages, keep=()):
    return flatten_transaction(explode_transactions(decode_envelope(messages, keep=keep), keep=keep), keep=keep)


def test_encode_takes_what_the_poll_extracts(spark, tx):
    page = poll_window_extract(tx, "2024-01-10", "2024-01-20")
    messages = encode_envelope(page, None)
    assert messages.count() == 1
    assert df_multiset(flat(messages)) == df_multiset(flatten_transaction(page))
    everything = encode_envelope(poll_window_extract(tx, "2024-01-01", "2024-02-01", limit=None), None)
    sizes = [len(json.loads(r.value)["data"]["ethereum"]["transactions"]) for r in everything.orderBy("message_no").collect()]
    assert sizes == [100] * (tx.count() // 100) + [tx.count() % 100] * (tx.count() % 100 > 0)


@pytest.mark.parametrize("split_rows", [None, 10])
def test_pages_of_a_hot_second(spark, tx, split_rows):
    rows = hot_second(tx).select(F.col("transaction_type").alias("key"), F.col("block_timestamp").alias("_ts"), F.col("hash").alias("_hash"), F.lit(0).alias("_tx"))
    rows = rows.withColumn("key", F.when(F.col("key") > 0, F.col("key"))).withColumn("_ts", F.when(F.col("_hash") > "0x1", F.col("_ts")))
    got = sorted((str(r.key), r._hash, r.message_no) for r in paged(rows, ["key"], 7, split_rows).collect())
    want = []
    for key in {r.key for r in rows.collect()}:
        own = sorted((r for r in rows.collect() if r.key == key), key=lambda r: (r._ts is None, -r._ts.timestamp() if r._ts else 0, r._hash))
        want += [(str(key), r._hash, i // 7) for i, r in enumerate(own)]
    assert got == sorted(want)


def test_frames_overlap_as_polled(tx):
    first, polls = dt.datetime(2024, 1, 5), 6
    got = sorted((r.poll_id, r.hash) for r in polled(tx, first, polls, "6 hours", "10 hours", "1 hour").collect())
    want = []
    for r in tx.collect():
        for k in range(polls):
            till = first + dt.timedelta(hours=6 * k - 1)
            if till - dt.timedelta(hours=10) <= r.block_timestamp <= till:
                want.append((k, r.hash))
    assert got == sorted(want) and len(want) > len({h for _, h in want})
    newest = poll_messages(tx, first, polls, "6 hours", "10 hours", "1 hour", page_rows=3, pages=1)
    assert newest.count() == len({k for k, _ in want})


def test_poller_keeps_its_cursor(spark, tx, monkeypatch):
    cursor, bus = scratch_path(spark, "cursor"), scratch_path(spark, "pollbus")
    poller = Poller(tx, cursor, bus, frame="2 days", delay="1 hour", overlap="1 day", page_rows=4)
    first = poller.poll(dt.datetime(2024, 1, 4))
    assert first["epoch"] == 0 and poller.poll(dt.datetime(2024, 1, 4)) is None
    # A poller that dies between publishing and committing publishes the same poll again, without effect.
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            poller.poll(dt.datetime(2024, 1, 12))
    before = spark.read.parquet(bus).count()
    again = Poller(tx, cursor, bus, frame="2 days", delay="1 hour", overlap="1 day", page_rows=4).poll(dt.datetime(2024, 1, 12))
    assert again["epoch"] == 1 and spark.read.parquet(bus).count() == before
    # The outage of eight days left no gap.
    sent = {r.hash for r in flat(spark.read.parquet(bus)).collect()}
    assert sent == {r.hash for r in tx.where(F.col("block_timestamp").between(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 11, 23))).collect()}
    sizes = [len(json.loads(r.value)["data"]["ethereum"]["transactions"]) for r in spark.read.parquet(bus).collect()]
    assert max(sizes) == 4


def test_poll_from_the_command_line(spark, tx):
    lake, cursor, bus = (scratch_path(spark, n) for n in ("lake", "cursor", "bus"))
    land_transactions(tx, lake, "overwrite")
    args = ["poll", "--input", lake, "--cursor", cursor, "--bus", bus, "--frame", "1 day", "--overlap", "1 hour", "--delay", "1 hour", "--every", "1 day"]
    assert cli.main([*args, "--since", "2024-01-03", "--until", "2024-01-06"]) == 0
    sent = flat(spark.read.parquet(bus)).select("hash").distinct().count()
    assert sent == tx.where(F.col("block_timestamp").between(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 5, 23))).count()


def test_error_responses_are_not_polled(spark, tx, monkeypatch):
    from txlake.sources import poll as module
    monkeypatch.setattr(module, "encode_envelope", lambda rows, *a, **k: rows.limit(1).select(F.lit('{"errors":[]}').alias("value")))
    poller = Poller(tx, scratch_path(spark, "c"), scratch_path(spark, "b"), frame="2 days")
    with pytest.raises(RuntimeError, match="error"):
        poller.poll(dt.datetime(2024, 1, 4))
    assert poller.log.last() is None


# -- dedup in the consumer ---------------------------------------------------------------------------------------------

def consume(spark, bus, sinks, ck, **options):
    q = run_stream(read_tx_stream(spark, "parquet", bus, **options), sinks, ck, trigger={"availableNow": True}, dedup="1 day", committed=True,
                   dead_letter=True, state_partitions=4)
    run_to_completion(q)


def test_overlap_restart_and_replay_leave_each_transaction_once(spark, tx):
    bus, sinks, ck = (scratch_path(spark, n) for n in ("bus", "sinks", "ck"))
    messages = poll_messages(tx, dt.datetime(2024, 1, 2), 31, "1 day", "2 days", "1 hour")
    publish_once(messages.where("poll_id < 12"), "parquet", bus, 0)
    publish_once(messages.where("poll_id between 8 and 20"), "parquet", bus, 1)
    consume(spark, bus, sinks, ck, maxFilesPerTrigger=1)
    publish_once(messages.where("poll_id > 18"), "parquet", bus, 2)
    consume(spark, bus, sinks, ck)
    log = CommitLog(spark, sinks)
    before = log.read("rt_transactions_by_sender").count()
    publish_once(messages, "parquet", bus, 3)  # everything again
    odd = spark.createDataFrame([("not json", None), ("not json", None), ('{"errors":[]}', None)], "value string, timestamp timestamp")
    publish_once(odd, "parquet", bus, 4)
    consume(spark, bus, sinks, ck)
    covered = tx.where(F.col("block_timestamp") <= dt.datetime(2024, 1, 31, 23))
    assert before == log.read("rt_transactions_by_sender").count() == covered.count()
    # Per batch the outputs are those of the distinct input.
    seen = log.read("rt_nonce_summary")
    assert seen.select("hash").distinct().count() == seen.count() == covered.count()
    assert seen.select("batch_id").distinct().count() > 2
    assert sorted(r.value for r in log.read("dead_letter").collect()) == ["not json", '{"errors":[]}']


def test_one_batch_of_copies_equals_the_distinct_input(spark, tx):
    bus, sinks, ck = (scratch_path(spark, n) for n in ("bus", "sinks", "ck"))
    messages = encode_envelope(tx.withColumn("message_id", F.floor(F.col("nonce") / 7)))
    messages.unionByName(messages).select("value", "timestamp").write.parquet(bus)
    totals = {}
    q = run_stream(read_tx_stream(spark, "parquet", bus), sinks, ck, trigger={"availableNow": True}, dedup="1 hour", totals=totals, state_partitions=4)
    run_to_completion(q)
    want = explode_transactions(decode_envelope(messages.select("value", "timestamp")))
    for name in ("rt_transaction_type_count", "rt_transactions_by_sender"):
        got = spark.read.parquet(f"{sinks}/{name}").drop("batch_id")
        assert df_multiset(got) == df_multiset(mb.MICROBATCH_ANALYTICS[name](want))
    assert totals["transactions"] == tx.count() and run_totals(q)["read"] == 2 * messages.count()


# -- commits -----------------------------------------------------------------------------------------------------------

def test_a_dead_run_leaves_the_old_ten_outputs(spark, tx, monkeypatch):
    base = scratch_path(spark, "job")
    run_batch_job(tx, base, committed=True)
    log = CommitLog(spark, base)
    old = {name: df_multiset(log.read(name)) for name in JOB_OUTPUTS}
    with monkeypatch.context() as m:
        m.setitem(batch_job.JOB_OUTPUTS, "block_utilization", lambda df: df.select(F.raise_error(F.lit("died"))))
        with pytest.raises(Exception, match="died"):
            run_batch_job(tx.limit(5), base, committed=True, parallel_jobs=1)
    assert {name: df_multiset(log.read(name)) for name in JOB_OUTPUTS} == old
    run_batch_job(tx.limit(5), base, committed=True)
    assert log.read("gas_pricing").count() == 5 and log.epochs() == [0, 1]
    assert log.drop_unused() >= 10
    assert log.read("gas_pricing").count() == 5


def test_a_replayed_batch_adds_no_row(spark, tx):
    sinks = scratch_path(spark, "sinks")
    batch = decode_envelope(encode_envelope(tx.withColumn("message_id", F.lit(1))).select("value", "timestamp"))
    write = make_batch_writer(sinks, committed=True, parallel_jobs=5)
    write(batch, 3)
    write(batch, 3)
    write(batch.limit(0), 4)
    log = CommitLog(spark, sinks)
    assert log.read("rt_nonce_summary").count() == tx.count() and log.epochs() == [3]
    write(batch, 5)
    assert log.read("rt_nonce_summary").count() == 2 * tx.count()


def test_manifests_are_folded(spark, monkeypatch):
    monkeypatch.setattr(commits, "FOLD_EVERY", 3)
    log = CommitLog(spark, scratch_path(spark, "log"))
    one = spark.range(1)
    for epoch in range(9):
        assert log.commit(epoch, {"a": log.stage(one, "a", epoch)}, APPEND)
    assert log.read("a").count() == 9 and len(log.epochs()) <= 4
    assert all(log.is_committed(e) for e in range(9)) and not log.is_committed(9)
    assert not log.commit(2, {}, APPEND)
    log.commit(9, {"a": log.stage(one, "a", 9)})
    assert log.read("a").count() == 1
    with pytest.raises(FileNotFoundError):
        log.read("b")
    assert log.read("b", "id long").count() == 0


# -- landing -----------------------------------------------------------------------------------------------------------

def test_landing_a_folder_twice_gives_the_same_lake(spark, tx):
    raw, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    odd = tx.limit(3).withColumn("hash", F.lit(None).cast("string"))
    frame = tx.unionByName(odd).drop("date", "last_modified")
    frame.repartition(4, "hash").write.parquet(raw)
    assert land_folder(spark, raw, lake) == 4
    want = df_multiset(scan_transactions(spark, lake))
    assert land_folder(spark, raw, lake) == 0
    assert cli.main(["land", "--input", raw, "--output", lake]) == 0
    assert df_multiset(scan_transactions(spark, lake)) == want and len(want[1]) == frame.count()
    # New files come in, also those that repeat what is there.
    frame.limit(50).unionByName(tx.limit(1).withColumn("hash", F.lit("0xnew")).drop("date", "last_modified")).coalesce(1).write.mode("append").parquet(raw)
    assert land_folder(spark, raw, lake) == 1
    assert scan_transactions(spark, lake).count() == frame.count() + 1


def test_landing_again_after_a_death_between_rows_and_list(spark, tx):
    raw, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    tx.drop("date").write.parquet(raw)
    land_transactions(spark.read.parquet(raw), lake)  # the rows are in, the list of files is not
    assert land_folder(spark, raw, lake) >= 1
    assert scan_transactions(spark, lake).count() == tx.count()


# -- listener, sinks, bench --------------------------------------------------------------------------------------------

def test_late_rows_are_counted_over_the_whole_run(spark, tx):
    src, out, ck = (scratch_path(spark, n) for n in ("late", "out", "ck"))
    days = ["2024-01-20", "2024-01-21", "2024-01-02", "2024-01-22", "2024-01-23"]
    for day in days:
        tx.where(F.to_date("block_timestamp") == day).coalesce(1).write.mode("append").parquet(src)
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = write_stream(et.tx_count_stream(stream, "1 hour", watermark="1 minute"), out, ck, trigger={"availableNow": True})
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert late_rows(q) > 0
    totals = run_totals(q)
    assert totals["read"] == tx.where(F.to_date("block_timestamp").isin(days)).count() and totals["batches"] >= 5
    with pytest.raises(RuntimeError, match="dropped"):
        run_to_completion(q)


def test_formats_without_a_target(tx):
    run_batch_job(tx, None, fmt="noop", outputs=["most_active_pairs"])


def test_bench_runs(spark, monkeypatch, capsys):
    import bench
    from txlake.plans import registry
    monkeypatch.setattr(bench, "SF_DIR", SF_SMALL)
    monkeypatch.setenv("BENCH_SKIP_TRAINING", "1")
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    few = {k: q for k, q in registry.queries().items() if k in ("block_utilization", "rt_nonce_summary", "tx_count_in_frame_stream")}
    monkeypatch.setattr(registry, "queries", lambda: dict(few))
    bench.main()
    found = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(found["queries"]) == set(few) and found["value"] > 0
