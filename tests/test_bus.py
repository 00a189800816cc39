"""Panes of sliding frames, the real-time queries over decoded messages, the view with the newest window first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, df_multiset
from txlake import cli
from txlake.schema import TX_SCHEMA_EXT
from txlake.session import scratch_path
from txlake.sources.commits import CommitLog
from txlake.sources.fixtures import load_transactions
from txlake.sources.io import read_tx_stream
from txlake.streaming import bus
from txlake.streaming import eventtime as et
from txlake.streaming.runner import run_to_completion, write_stream

NOW = {"availableNow": True}


def test_rows_are_aggregated_before_they_are_copied_to_frames(spark):
    rows = spark.createDataFrame([], TX_SCHEMA_EXT)
    for frames in (et.tx_count_stream(rows, "1 hour", "1 second"), et.new_contracts_stream(rows, "90 seconds", "1 minute"),
                   et.suspicious_activity_stream(rows, "1 hour", 1, 1.0, "1 minute")):
        steps = [line for line in frames._jdf.queryExecution().analyzed().toString().splitlines() if "Aggregate [" in line or "Expand [" in line]
        copies = [i for i, line in enumerate(steps) if "Expand [" in line]
        assert copies and "Aggregate [" in steps[-1] and max(copies) < len(steps) - 1


def test_frames_that_are_no_multiple_of_the_slide(spark):
    tx = load_transactions(spark, SF_SMALL)
    src = scratch_path(spark, "odd-src")
    tx.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(TX_SCHEMA_EXT).parquet(src)
    out = scratch_path(spark, "odd")
    run_to_completion(write_stream(et.new_contracts_stream(stream, "90 minutes", "1 hour"), out, scratch_path(spark, "odd-ck"), trigger=NOW))
    rows = [(r.block_timestamp, r.receipt_gas_used, r.to_address is None and r.input is not None) for r in tx.collect()]
    last = max(r[0] for r in rows) - dt.timedelta(minutes=10)
    want: dict = {}
    for at, gas, created in rows:
        hour = at.replace(minute=0, second=0, microsecond=0)
        for start in (hour - dt.timedelta(hours=1), hour):
            if created and at < start + dt.timedelta(minutes=90) <= last:
                want.setdefault(start, []).append(gas)
    got = {r.window_start: (r.contract_count, r.average_initial_gas_usage) for r in spark.read.parquet(out).collect()}
    assert want and got == {s: (len(g), float(sum(g)) / len(g)) for s, g in want.items()}


def message(*txs: str) -> str:
    return '{"data":{"ethereum":{"transactions":[' + ",".join(txs) + "]}}}"


def tx_json(name: str, at: str, price: str = "1e9") -> str:
    return (f'{{"hash":"{name}","nonce":1,"gas":21000,"gasPrice":{price},"gasValue":0.1,"txType":"2","sender":{{"address":"s"}},'
            f'"to":{{"address":"t"}},"block":{{"timestamp":{{"iso8601":"{at}"}}}}}}')


def test_monitors_over_messages(spark):
    """Three batches of overlapping polls with a restart, a replay and messages that bring nothing."""
    src, landed, ck = (scratch_path(spark, n) for n in ("bus-src", "bus-out", "bus-ck"))
    a, b, c = (tx_json(f"h{i}", f"2024-01-01T00:{11 * i:02d}:00", p) for i, p in enumerate(("1e9", "2000000000.9", "1e30")))
    batches = [[message(a, b), None, " ", "no json"], [message(b, c, tx_json("x", "yesterday")), message(a)], [message(a, b, c), '{"errors":[]}']]
    for values in batches:
        spark.createDataFrame([(v, None) for v in values], "value string, timestamp timestamp").coalesce(1).write.mode("append").parquet(src)
        run_to_completion(bus.land_bus(read_tx_stream(spark, "parquet", src), landed, ck, dedup="1 day", trigger=NOW))
    rows = {r.hash: (r.gas_price, r.block_timestamp and r.block_timestamp.minute) for r in bus.read_bus(spark, landed).collect()}
    assert bus.read_bus(spark, landed).count() == 4
    assert rows == {"h0": (10**9, 0), "h1": (2 * 10**9, 11), "h2": (None, 22), "x": (10**9, None)}
    assert bus.read_bus(spark, landed).schema == bus.BUS_SCHEMA
    out = scratch_path(spark, "bus-count")
    run_to_completion(write_stream(et.tx_count_stream(bus.read_bus_stream(spark, landed), "10 minutes", watermark="1 second"), out,
                                   scratch_path(spark, "bus-count-ck"), trigger=NOW))
    assert sorted((r.window_start.minute, r.transaction_count) for r in spark.read.parquet(out).collect()) == [(0, 1), (10, 1)]
    kept = scratch_path(spark, "bus-all")  # without dedup every copy is landed
    run_to_completion(bus.land_bus(read_tx_stream(spark, "parquet", src), kept, scratch_path(spark, "bus-all-ck"), trigger=NOW))
    assert bus.read_bus(spark, kept).count() == 9


def test_newest_window_first(spark):
    at = dt.datetime(2024, 1, 1)
    made = [("a", 0, 10), ("b", 1, 30), ("c", 1, 50), ("d", 4, 20), ("e", 3, 60), ("f", 9, 80), ("g", 5, None)]
    rows = spark.createDataFrame([(h, at + dt.timedelta(minutes=m), p) for h, m, p in made], "hash string, block_timestamp timestamp, gas_price long")
    src, base, ck = (scratch_path(spark, n) for n in ("view-src", "view", "view-ck"))
    want = [
        {0: 10.0, 1: 40.0},
        {0: 10.0, 1: 40.0, 3: 60.0, 4: 20.0},
        {4: 20.0, 5: None, 9: 80.0},  # 5 minutes before the newest: out
    ]
    cols = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TX_SCHEMA_EXT]
    for part, state in zip(("abc", "ed", "fg"), want):
        rows.where(F.col("hash").isin(*part)).select(*cols).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(TX_SCHEMA_EXT).parquet(src)
        run_to_completion(bus.run_gas_price_view(stream, base, ck, "1 minute", "6 minutes", trigger=NOW))
        view = bus.read_gas_price_view(spark, base)
        got = [(r.window_start.minute, r.average_gas_price) for r in view.collect()]
        assert got == sorted(state.items(), reverse=True)
        assert "Sort" not in view._jdf.queryExecution().executedPlan().toString()
    # A replayed batch changes nothing.
    log, before = CommitLog(spark, base), df_multiset(bus.read_gas_price_view(spark, base))
    bus._newest_first(base, "6 minutes")(view.withColumn("average_gas_price", F.lit(0.0)), log.epochs()[-1])
    assert df_multiset(bus.read_gas_price_view(spark, base)) == before
    assert bus.read_gas_price_view(spark, scratch_path(spark, "none")).count() == 0


def test_command_line(spark, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda *a, **k: spark)
    src, landed, out, view = (scratch_path(spark, n) for n in ("cli-bus", "cli-landed", "cli-out", "cli-view"))
    spark.createDataFrame([(message(tx_json("h", "2024-01-01T00:00:00"), tx_json("i", "2024-01-01T05:00:00")), None)], "value string, timestamp timestamp").write.parquet(src)
    run = ["--available-now", "--checkpoint"]
    assert cli.main(["bus", "--source-format", "parquet", "--source-path", src, "--output", landed, "--dedup", "1 hour", *run, scratch_path(spark, "c1")]) == 0
    assert cli.main(["monitor", "tx_count", "--bus", "--input", landed, "--output", out, *run, scratch_path(spark, "c2")]) == 0
    assert cli.main(["monitor", "gas_price_view", "--bus", "--input", landed, "--output", view, "--frame", "1 day", *run, scratch_path(spark, "c3")]) == 0
    assert [r.transaction_count for r in spark.read.parquet(out).collect()] == [1]
    assert [r.window_start.hour for r in bus.read_gas_price_view(spark, view).collect()] == [5, 0]
