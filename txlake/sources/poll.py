"""The poller as Spark jobs (S11 -> S12 -> S13): frames of the lake, cut into pages, published as messages.

A poll at time ``t`` asks for the frame ``[t - delay - frame, t - delay]``, newest first. Frames are longer than the time between
polls, so they overlap, and consumers drop what comes twice. The interactive API gives only the newest page of a frame;
here all pages of a frame are cut, and ``pages=1`` asks for the API's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.units import floored
from txlake.operators.realtime import in_frame
from txlake.schema import BLOCK_TIMESTAMP, POLL_DELAY, POLL_EVERY, POLL_FRAME, POLL_LIMIT
from txlake.session import path_exists, rename, scratch_sibling
from txlake.sources.commits import APPEND, CommitLog
from txlake.sources.envelope import MESSAGE_NO, encode_envelope, error_envelope_filter
from txlake.sources.io import FILE_FORMATS, publish_envelopes

UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(span: str) -> int:
    """'10 minutes' -> 600."""
    n, unit = span.split()
    return int(n) * UNITS[unit.rstrip("s")]


def polled(tx: DataFrame, first: dt.datetime, polls: int, every: str = POLL_EVERY, frame: str = POLL_FRAME,
           delay: str = POLL_DELAY) -> DataFrame:
    """``tx`` with ``poll_id``: a row for every frame of ``polls`` polls from ``first`` on that it lies in.

    Frames follow from the block time by arithmetic, so there is no join; a row comes at most frame / every + 1 times."""
    step, length = seconds(every) * 1_000_000, seconds(frame) * 1_000_000
    start = int(first.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 - seconds(delay) * 1_000_000
    end = first + dt.timedelta(seconds=(polls - 1) * seconds(every) - seconds(delay))
    rows = in_frame(tx, end.strftime("%Y-%m-%d %H:%M:%S"), f"{(polls - 1) * seconds(every) + seconds(frame)} seconds")
    since = F.unix_micros(BLOCK_TIMESTAMP) - F.lit(start)
    low = F.greatest(F.lit(0).cast("long"), -floored(-since, step))
    high = F.least(F.lit(polls - 1).cast("long"), floored(since + F.lit(length), step))
    return rows.withColumns({"_low": low, "_high": high}).where("_low <= _high").select(
        *tx.columns, F.explode(F.sequence("_low", "_high")).alias("poll_id"))


def poll_messages(tx: DataFrame, first: dt.datetime, polls: int, every: str = POLL_EVERY, frame: str = POLL_FRAME,
                  delay: str = POLL_DELAY, page_rows: int = POLL_LIMIT, pages: int | None = None) -> DataFrame:
    """poll_id, message_no, value, timestamp: the messages of ``polls`` polls, each of at most ``page_rows`` transactions."""
    messages = encode_envelope(polled(tx, first, polls, every, frame, delay), "poll_id", page_rows=page_rows)
    return messages if pages is None else messages.where(F.col(MESSAGE_NO) < int(pages))


def publish_once(messages: DataFrame, fmt: str, path: str | None, epoch: int, **options) -> None:
    """Publishes the messages of one epoch. On a file bus they appear together, as the folder ``poll=<epoch>``, and a
    second attempt adds nothing; a message bus may see them twice, which a consumer with ``dedup`` drops."""
    if fmt not in FILE_FORMATS:
        publish_envelopes(messages, fmt=fmt, **options)
        return
    spark, target = messages.sparkSession, f"{path.rstrip('/')}/poll={epoch}"
    if path_exists(spark, target):
        return
    draft = scratch_sibling(path, f"_poll-{epoch}")
    publish_envelopes(messages, fmt=fmt, path=draft, mode="errorifexists", **options)
    rename(spark, draft, target)


class Poller:
    """Polls a lake up to now and remembers how far it came, in a commit log at ``cursor``.

    A poll begins ``overlap`` before the end of the last one, however long ago that was, so an outage leaves no gap; its
    messages are published first and its end is committed after that."""

    def __init__(self, tx: DataFrame, cursor: str, bus: str | None, fmt: str = "parquet", frame: str = POLL_FRAME,
                 delay: str = POLL_DELAY, overlap: str = POLL_EVERY, page_rows: int = POLL_LIMIT, **options):
        self.tx, self.bus, self.fmt, self.options = tx, bus, fmt, options
        self.frame, self.delay, self.overlap, self.page_rows = frame, delay, overlap, page_rows
        self.log = CommitLog(tx.sparkSession, cursor)

    def next_frame(self, now: dt.datetime) -> tuple[int, dt.datetime, dt.datetime] | None:
        """(epoch, since, till) of the poll at ``now``; None if it would bring nothing new."""
        last = self.log.last()
        till = now - dt.timedelta(seconds=seconds(self.delay))
        since = till - dt.timedelta(seconds=seconds(self.frame))
        if last is None:
            return 0, since, till
        before = dt.datetime.fromisoformat(last["till"])
        if till <= before:
            return None
        return last["epoch"] + 1, min(since, before - dt.timedelta(seconds=seconds(self.overlap))), till

    def poll(self, now: dt.datetime) -> dict | None:
        """One poll; None if there was nothing to ask for. An error response is not published and fails the poll,
        so the next one asks for the same frame again."""
        found = self.next_frame(now)
        if found is None:
            return None
        epoch, since, till = found
        span = int((till - since).total_seconds())
        rows = in_frame(self.tx, till.isoformat(sep=" "), f"{span} seconds").withColumn("poll_id", F.lit(epoch).cast("long"))
        good, errors = error_envelope_filter(encode_envelope(rows, "poll_id", page_rows=self.page_rows))
        if not errors.isEmpty():
            raise RuntimeError(f"the poll of {since} to {till} brought error responses")
        publish_once(good, self.fmt, self.bus, epoch, **self.options)
        facts = {"since": since.isoformat(), "till": till.isoformat()}
        if not self.log.commit(epoch, {}, APPEND, **facts):
            raise RuntimeError(f"another poller committed poll {epoch}")
        return {"epoch": epoch, **facts}
