"""Stream wiring: source -> decode -> foreachBatch fan-out.

Each micro-batch is exploded once, persisted, and fanned out to the R01-R05
analytics. Every result carries ``batch_id``; file sinks are partitioned by
it, and the folder of a batch is put in place whole, so a batch replayed after
a failure replaces its own output instead of appending a second copy
(exactly-once effect on top of the at-least-once ``foreachBatch``). With
``committed`` all outputs of a batch appear together through a commit log,
and with ``dedup`` replayed transactions are dropped ahead of the analytics.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txlake.session import rename, scratch_sibling
from txlake.sources.commits import APPEND, CommitLog
from txlake.sources.envelope import decode_envelope, explode_transactions
from txlake.sources.io import DOCUMENT_STORES, FILE_FORMATS, target_options
from txlake.streaming.microbatch import MICROBATCH_ANALYTICS

LOG = logging.getLogger(__name__)
DEAD_LETTER = "dead_letter"


#: State of the dedup step: on disk, so that it may exceed an executor's heap.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_CONF_LOCK = threading.Lock()
_TX = "data.data.ethereum.transactions"


def make_batch_writer(sink_base: str | None, fmt: str = "parquet",
                      analytics: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
                      sink_options: dict | None = None, parallel_jobs: int = 1,
                      dead_letter: bool = False, committed: bool = False,
                      totals: dict[str, int] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback (S08) over decoded envelope rows, or over rows of :func:`distinct_transactions`.

    ``parallel_jobs > 1`` submits the analytics as concurrent Spark jobs over
    the one persisted batch (each is small next to the cluster).
    ``dead_letter=True`` also writes messages that parsed to no transaction
    array (garbage, API error bodies) with their raw ``value`` to the
    ``dead_letter`` output; the batch needs the ``value`` column for that.
    ``committed=True`` (file formats) writes through the :class:`CommitLog` of ``sink_base``: all outputs of a batch
    appear together, and a replayed batch adds nothing. ``totals`` gets the rows of all batches so far.
    """
    chosen = dict(analytics or MICROBATCH_ANALYTICS)
    opts = dict(sink_options or {})
    if committed and (fmt not in FILE_FORMATS or sink_base is None):
        raise ValueError("commits need a file format and a base path")

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch_df.sparkSession, sink_base, fmt) if committed else None
        if log and log.is_committed(int(batch_id)):
            LOG.info("batch %d was committed before", batch_id)
            return
        keep_dead = dead_letter and "value" in batch_df.columns
        ts = [c for c in ("timestamp",) if c in batch_df.columns]
        bad = None
        if "transaction" in batch_df.columns:
            cached = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
            exploded = cached.where(F.col("transaction").isNotNull()).select("transaction")
            if keep_dead:
                bad = cached.where("undecodable").select("value", *ts)
        elif keep_dead:
            # Persist the decoded batch once (the JSON is parsed once); the raw payload is kept
            # only on rows without a transactions array, which go to the dead-letter output.
            no_tx = F.col(_TX).isNull()
            cached = (batch_df.select("data", F.when(no_tx, F.col("value")).alias("value"), *ts)
                      .persist(StorageLevel.MEMORY_AND_DISK))
            exploded = explode_transactions(cached)
            bad = cached.where(no_tx).select("value", *ts)
        else:
            cached = exploded = explode_transactions(batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        jobs: dict[str, Callable[[], DataFrame]] = {}
        staged: dict[str, str] = {}

        def one(item) -> None:
            name, make = item
            out = make()
            if fmt in FILE_FORMATS and not log:
                # The folder of the batch is written as such: a dynamic partition would sort all rows by one value.
                table = f"{sink_base.rstrip('/')}/{name}"
                draft = scratch_sibling(table, f"_batch-{int(batch_id)}")
                out.write.format(fmt).mode("errorifexists").options(**opts).save(draft)
                rename(out.sparkSession, draft, f"{table}/batch_id={int(batch_id)}", replace=True)
                return
            out = out.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
            if log:
                staged[name] = log.stage(out, name, int(batch_id), **opts)
                return
            w = out.write.format(fmt)
            if fmt in DOCUMENT_STORES:
                w.mode("append").options(**{"collection": name, **opts}).save()
            else:
                w.mode("append").options(**target_options(fmt, name, opts)).save()

        try:
            n_tx = exploded.count()  # fills the cache; a batch without transactions writes no analytics
            n_bad = bad.count() if bad is not None else 0
            if n_tx:
                jobs.update({name: (lambda fn=fn: fn(exploded)) for name, fn in chosen.items()})
            if bad is not None and (n_bad or not committed):
                jobs[DEAD_LETTER] = lambda: bad
            if parallel_jobs > 1 and len(jobs) > 1:
                with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
                    list(pool.map(one, jobs.items()))
            else:
                for item in jobs.items():
                    one(item)
            if staged:
                log.commit(int(batch_id), staged, APPEND)
            if totals is not None:
                for name, n in (("batches", 1), ("transactions", n_tx), ("undecodable", n_bad)):
                    totals[name] = totals.get(name, 0) + n
            LOG.info("batch %d: %d transactions, %d undecodable messages", batch_id, n_tx, n_bad)
        finally:
            cached.unpersist()

    return write_batch


def distinct_transactions(decoded: DataFrame, expiry: str, dead_letter: bool = False, carried: list[Column] | None = None,
                          key: str | None = None) -> DataFrame:
    """The transactions of a decoded stream (N10), each ``hash`` once as long as ``expiry`` after it first came.

    The poller's frames overlap, so most transactions come twice. Keys expire by the time of the batch they came
    in, which the checkpoint records and which never runs backwards: no row is ever late, so none is lost, whatever
    the order of block times. A transaction without a hash is told by its content, an undecodable message (kept with
    ``dead_letter``, column ``undecodable``) by its payload. With ``carried`` the rows have these columns (of
    ``transaction``) in its stead, with ``key`` also the key, under that name.
    """
    no_array = F.col(_TX).isNull()
    kept = [F.when(no_array, F.col("value")).alias("value")] if dead_letter else []
    ts = [F.col("timestamp")] if "timestamp" in decoded.columns else []
    rows = decoded.select(F.explode_outer(_TX).alias("transaction"), no_array.alias("undecodable"), *kept, *ts)
    rows = rows.where(F.col("transaction").isNotNull() | (F.col("undecodable") & F.lit(dead_letter)))
    payload = [F.sha2(F.col("value"), 256)] if dead_letter else []
    told = F.coalesce(F.col("transaction.hash"), F.sha2(F.to_json("transaction"), 256), *payload)
    others = [F.col(c) for c in rows.columns] if carried is None else carried
    rows = rows.select(*others, told.alias("_key"), F.current_timestamp().alias("_came"))
    rows = rows.withWatermark("_came", expiry).dropDuplicatesWithinWatermark(["_key"]).drop("_came")
    return rows.drop("_key") if key is None else rows.withColumnRenamed("_key", key)


def run_stream(raw_stream: DataFrame, sink_base: str | None, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None, analytics: dict | None = None, query_name: str | None = None,
               sink_options: dict | None = None, parallel_jobs: int = 1,
               dead_letter: bool = False, committed: bool = False, dedup: str | None = None,
               state_partitions: int | None = None, totals: dict[str, int] | None = None) -> StreamingQuery:
    """Start the stream; returns the running :class:`StreamingQuery`.

    ``checkpoint`` must be a shared, durable folder: a restart resumes from
    the last committed offsets instead of ``latest``. ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"processingTime": "5 minutes"}`` or
    ``{"availableNow": True}``). ``dead_letter=True`` keeps the raw payload of
    undecodable messages in a ``dead_letter`` output. ``dedup`` (e.g. ``"30 minutes"``, at least the overlap of two
    polls and the time between them) lets each transaction through once; ``committed`` and ``totals`` are those of
    :func:`make_batch_writer`.
    """
    watch(raw_stream.sparkSession)
    decoded = decode_envelope(raw_stream, keep=("timestamp", "value") if dead_letter else ("timestamp",))
    if dedup:
        decoded = distinct_transactions(decoded, dedup, dead_letter)
    writer = make_batch_writer(sink_base, fmt, analytics, sink_options, parallel_jobs, dead_letter, committed, totals)
    w = decoded.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return start_with(w, raw_stream.sparkSession, {**(ROCKSDB if dedup else {}), **state_width(state_partitions)})


def state_width(partitions: int | None) -> dict[str, str]:
    return {} if partitions is None else {"spark.sql.shuffle.partitions": str(int(partitions))}


def start_with(writer, spark: SparkSession, conf: dict[str, str]) -> StreamingQuery:
    """Starts a query that keeps ``conf`` for itself: a stream clones the session's settings when it starts.

    One start at a time, so that no other one of this process sees the settings in between."""
    with _CONF_LOCK:
        before = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            return writer.start()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class StreamTotals(StreamingQueryListener):
    """Rows over whole runs, by run id: progress reports are added up as they come, whatever a query keeps of them."""

    def __init__(self):
        self.runs: dict[str, dict[str, int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _of(self, run: str) -> dict[str, int]:
        self.ended.setdefault(run, threading.Event())
        return self.runs.setdefault(run, {"batches": 0, "read": 0, "written": 0, "late": 0})

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        run = self._of(str(p.runId))
        run["batches"] += 1
        run["read"] += p.numInputRows
        run["written"] += max(0, p.sink.numOutputRows)  # -1 where the sink does not count
        run["late"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        run = str(event.runId)
        self._of(run)
        self.ended[run].set()


_WATCHED: dict[str, StreamTotals] = {}


def watch(spark: SparkSession) -> StreamTotals:
    """The one listener of this application's streams (started before them)."""
    app = spark.sparkContext.applicationId
    with _CONF_LOCK:
        if app not in _WATCHED:
            _WATCHED.clear()
            listener = StreamTotals()
            spark.streams.addListener(listener)
            _WATCHED[app] = listener
    return _WATCHED[app]


def run_totals(query: StreamingQuery, timeout_s: float = 60.0) -> dict[str, int]:
    """batches, read, written and late rows of a query started here; of all its batches if it has ended."""
    listener, run = next(iter(_WATCHED.values())), str(query.runId)
    found = listener._of(run)  # noqa: SLF001
    if not query.isActive and not listener.ended[run].wait(timeout_s):
        raise TimeoutError("the end of the query was not reported")
    return dict(found)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query has dropped so far because they were older than the watermark."""
    return run_totals(query)["late"]


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None, allow_late: bool = False) -> None:
    """Wait for an ``availableNow`` query; fail if it fails, if the time is up, or if it dropped late rows."""
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    if ended is False:
        raise TimeoutError(f"the query still runs after {timeout_s} s")
    if not allow_late and (n := late_rows(query)):
        raise RuntimeError(f"{n} rows came later than the watermark allows and were dropped")


def write_stream(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append", fmt: str = "parquet",
                 trigger: dict | None = None, partition_by: Iterable[str] = (),
                 state_partitions: int | None = None) -> StreamingQuery:
    """Start a plain streaming sink (used by the event-time queries).

    ``state_partitions`` fixes the number of state-store partitions of a new
    query (Spark records it in the checkpoint at the first start and keeps
    it on restarts). Keyless window aggregates hold one state row per open
    window, so a few partitions suffice at any input size; keyed aggregates
    should keep the session's shuffle partitions (the default).
    """
    watch(df.sparkSession)
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger:
        w = w.trigger(**trigger)
    return start_with(w, df.sparkSession, state_width(state_partitions))
