"""Command-line jobs for ``spark-submit`` (or ``python -m txlake.cli``).

  batch    the ten-output batch job over the lake (S01 + S06)
  land     conform raw Parquet files and write the date-partitioned lake (S02)
  poll     frames of the lake -> pages -> messages on the bus, from a kept cursor (S11, S12, S13)
  stream   message bus -> decode -> foreachBatch R01-R05 -> sinks (R06)
  monitor  one event-time query (P01-P05 stream form) -> streaming sink

Connector options are passed as ``--option key=value`` and never printed.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file (spark-submit txlake/cli.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txlake.schema import POLL_DELAY, POLL_EVERY, POLL_FRAME, POLL_LIMIT  # noqa: E402
from txlake.session import apply_sizing, build_session, checkpoint_root  # noqa: E402


def _opts(pairs: list[str] | None) -> dict:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _trigger(args) -> dict | None:
    if getattr(args, "available_now", False):
        return {"availableNow": True}
    if getattr(args, "interval", None):
        return {"processingTime": args.interval}
    return None


def cmd_batch(spark, args) -> int:
    from txlake.plans.batch_job import run_batch_job
    from txlake.sources.transactions import scan_transactions
    if args.auto_size:
        apply_sizing(spark, args.input)
    tx = scan_transactions(spark, args.input, args.start_date, args.end_date)
    outputs = args.outputs.split(",") if args.outputs else None
    timings = run_batch_job(tx, args.output, fmt=args.format, outputs=outputs, shared_scan=args.shared_scan,
                            parallel_jobs=args.parallel_jobs, committed=args.committed, **_opts(args.option))
    print(json.dumps(timings))
    return 0


def cmd_land(spark, args) -> int:
    from txlake.sources.transactions import land_folder, land_transactions
    if args.auto_size:
        apply_sizing(spark, args.input)
    if args.mode == "append":
        print(f"{land_folder(spark, args.input, args.output)} new files")
    else:
        land_transactions(spark.read.parquet(args.input), args.output, mode=args.mode)
    return 0


def cmd_stream(spark, args) -> int:
    from txlake.sources.io import read_tx_stream
    from txlake.streaming.runner import run_stream
    src = read_tx_stream(spark, args.source_format, args.source_path, **_opts(args.source_option))
    q = run_stream(src, args.sink, args.checkpoint or f"{checkpoint_root(spark)}/txlake-stream",
                   fmt=args.sink_format, trigger=_trigger(args), sink_options=_opts(args.option),
                   parallel_jobs=args.parallel_jobs, dead_letter=args.dead_letter, committed=args.committed,
                   dedup=args.dedup, state_partitions=args.state_partitions)
    q.awaitTermination()
    return 0


def cmd_poll(spark, args) -> int:
    """Polls from the cursor (or ``--since``) up to ``--until``, one poll every ``--every``."""
    import datetime as dt
    from txlake.sources.poll import Poller, seconds
    from txlake.sources.transactions import scan_transactions
    poller = Poller(scan_transactions(spark, args.input), args.cursor, args.bus, args.format, args.frame, args.delay,
                    args.overlap, args.page_rows, **_opts(args.option))
    until = dt.datetime.fromisoformat(args.until) if args.until else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now = dt.datetime.fromisoformat(args.since) if args.since else until
    while now <= until:
        found = poller.poll(now)
        print(f"poll at {now}: {'nothing new' if found is None else found}")
        now += dt.timedelta(seconds=seconds(args.every))
    return 0


MONITORS = {
    "tx_count": ("tx_count_stream", ("frame", "slide")),
    "gas_price_trend": ("gas_price_trend_stream", ("granularity",)),
    "new_contracts": ("new_contracts_stream", ("frame", "slide")),
    "large_transfers": ("large_transfers_stream", ("threshold",)),
    "suspicious_activity": ("suspicious_activity_stream", ("frame", "slide", "max_count", "max_avg_gas_price")),
}


def cmd_bus(spark, args) -> int:
    from txlake.sources.io import read_tx_stream
    from txlake.streaming.bus import land_bus
    src = read_tx_stream(spark, args.source_format, args.source_path, **_opts(args.source_option))
    q = land_bus(src, args.output, args.checkpoint or f"{checkpoint_root(spark)}/txlake-bus", args.dedup, _trigger(args),
                 args.state_partitions)
    q.awaitTermination()
    return 0


def cmd_monitor(spark, args) -> int:
    from txlake.sources.transactions import read_lake_stream
    from txlake.streaming.bus import BUS_MONITORS, read_bus_stream, run_gas_price_view
    from txlake.streaming import eventtime as et
    from txlake.streaming.runner import write_stream
    read = read_bus_stream if args.bus else read_lake_stream
    if args.query == "gas_price_view":
        q = run_gas_price_view(read(spark, args.input, **_opts(args.source_option)), args.output,
                               args.checkpoint or f"{checkpoint_root(spark)}/txlake-monitor-gas_price_view",
                               args.granularity, args.frame, args.watermark, _trigger(args))
        q.awaitTermination()
        return 0
    if args.bus and args.query not in BUS_MONITORS:
        raise SystemExit(f"the bus does not carry what {args.query} needs")
    fn_name, params = MONITORS[args.query]
    kwargs = {}
    for p in params:
        v = getattr(args, p, None)
        if v is not None:
            kwargs[p] = v
    if args.query != "large_transfers":
        kwargs["watermark"] = args.watermark
    stream = read(spark, args.input, **_opts(args.source_option))
    keyless = args.query in ("tx_count", "gas_price_trend", "new_contracts")
    parts = args.state_partitions or (et.KEYLESS_STATE_PARTITIONS if keyless else None)
    q = write_stream(getattr(et, fn_name)(stream, **kwargs), args.output,
                     args.checkpoint or f"{checkpoint_root(spark)}/txlake-monitor-{args.query}",
                     fmt=args.sink_format, trigger=_trigger(args), state_partitions=parts)
    q.awaitTermination()
    return 0


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="txlake")
    ap.add_argument("--master", default=None, help="only when not launched by spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("batch")
    b.add_argument("--input", required=True)
    b.add_argument("--output")
    b.add_argument("--format", default="parquet")
    b.add_argument("--start-date")
    b.add_argument("--end-date")
    b.add_argument("--outputs", help="comma-separated subset of the ten outputs")
    b.add_argument("--shared-scan", action="store_true")
    b.add_argument("--parallel-jobs", type=int, default=4)
    b.add_argument("--option", action="append")
    b.add_argument("--committed", action="store_true", help="the outputs appear together, through a commit log")
    b.add_argument("--auto-size", action="store_true", help="size shuffles from the input's bytes")

    la = sub.add_parser("land")
    la.add_argument("--input", required=True)
    la.add_argument("--output", required=True)
    la.add_argument("--mode", default="append", choices=["append", "overwrite"])
    la.add_argument("--auto-size", action="store_true", help="size shuffles from the input's bytes")

    s = sub.add_parser("stream")
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source-path")
    s.add_argument("--source-option", action="append")
    s.add_argument("--sink")
    s.add_argument("--sink-format", default="parquet")
    s.add_argument("--option", action="append")
    s.add_argument("--checkpoint")
    s.add_argument("--interval")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--parallel-jobs", type=int, default=5)
    s.add_argument("--dedup", metavar="TIME", help="let each transaction through once in this time, e.g. '30 minutes'")
    s.add_argument("--committed", action="store_true", help="all outputs of a batch appear together (file sinks)")
    s.add_argument("--state-partitions", type=int, help="state partitions of --dedup (new checkpoint only)")
    s.add_argument("--dead-letter", action="store_true", help="keep undecodable messages in a dead_letter output")

    p = sub.add_parser("poll")
    p.add_argument("--input", required=True, help="lake directory")
    p.add_argument("--cursor", required=True, help="folder that keeps how far the poller came")
    p.add_argument("--bus", help="folder of a file bus")
    p.add_argument("--format", default="parquet", help="file format, or kafka with --option")
    p.add_argument("--option", action="append")
    p.add_argument("--since", help="time of the first poll; default: one poll at --until")
    p.add_argument("--until", help="time of the last poll; default: now (UTC)")
    p.add_argument("--every", default=POLL_EVERY)
    p.add_argument("--frame", default=POLL_FRAME)
    p.add_argument("--delay", default=POLL_DELAY)
    p.add_argument("--overlap", default=POLL_EVERY)
    p.add_argument("--page-rows", type=int, default=POLL_LIMIT)

    u = sub.add_parser("bus", help="decode the messages of the bus once, for the monitors")
    u.add_argument("--source-format", default="kafka")
    u.add_argument("--source-path")
    u.add_argument("--source-option", action="append")
    u.add_argument("--output", required=True)
    u.add_argument("--checkpoint")
    u.add_argument("--dedup", metavar="TIME", help="let each transaction through once in this time, e.g. '30 minutes'")
    u.add_argument("--state-partitions", type=int, help="state partitions of --dedup (new checkpoint only)")
    u.add_argument("--interval")
    u.add_argument("--available-now", action="store_true")

    m = sub.add_parser("monitor")
    m.add_argument("query", choices=sorted([*MONITORS, "gas_price_view"]))
    m.add_argument("--input", required=True, help="lake directory read as a file stream")
    m.add_argument("--bus", action="store_true", help="the input is the folder that `bus` lands, not a lake")
    m.add_argument("--output", required=True)
    m.add_argument("--sink-format", default="parquet")
    m.add_argument("--source-option", action="append")
    m.add_argument("--checkpoint")
    m.add_argument("--frame", default="10 minutes")
    m.add_argument("--slide")
    m.add_argument("--granularity", default="1 minute")
    m.add_argument("--watermark", default="10 minutes")
    m.add_argument("--threshold", type=float)
    m.add_argument("--max-count", dest="max_count", type=int)
    m.add_argument("--max-avg-gas-price", dest="max_avg_gas_price", type=float)
    m.add_argument("--state-partitions", type=int, help="state partitions of a keyed monitor (new checkpoint only)")
    m.add_argument("--interval")
    m.add_argument("--available-now", action="store_true")
    return ap


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(args.master, app=f"txlake-{args.cmd}")
    return {"batch": cmd_batch, "land": cmd_land, "stream": cmd_stream, "poll": cmd_poll, "bus": cmd_bus, "monitor": cmd_monitor}[args.cmd](spark, args)


if __name__ == "__main__":
    sys.exit(main())
