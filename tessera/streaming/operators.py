"""Structured Streaming building blocks.

Event time replaces the original processing-time batches: windows are
``window(ts, ...)`` groups with a watermark that bounds the state, output
goes out in update mode and the current table is the newest row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def parse_clicks(lines: DataFrame, col: str = "value") -> DataFrame:
    """``epoch_ms area city user ad`` text -> typed columns (+ ts, day).

    Messages with another number of fields, or without a real time, user or
    ad, are dropped; they never end the job."""
    f = lines.select(F.split(F.col(col), " ").alias("f")).where(F.size("f") == 5)
    part = lambda i: F.get("f", F.lit(i))
    p = f.select(part(0).try_cast("bigint").alias("ts_ms"), part(1).alias("area"), part(2).alias("city"),
                 part(3).try_cast("bigint").alias("user"), part(4).try_cast("bigint").alias("ad"))
    p = p.where("ts_ms is not null and user is not null and ad is not null")
    ts = F.timestamp_millis("ts_ms")
    return p.withColumn("ts", ts).withColumn("day", F.date_format(ts, "yyyy-MM-dd"))


def running_count(stream: DataFrame, keys: Sequence[str], alias: str = "n", ts: str | None = None,
                  lateness: str | None = None) -> DataFrame:
    """``updateStateByKey`` running count: a streaming aggregation whose
    state store keeps one row per key (emit in update mode).

    Counts keyed by the day of ``ts`` can give ``lateness``: a day's state
    then goes that long after the day's end, and later rows are dropped (the
    query's progress counts them).  Without it every key stays for ever."""
    if lateness is None:
        return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    day = F.window(ts, "1 day").alias("__day")
    return stream.withWatermark(ts, lateness).groupBy(day, *keys).agg(F.count(F.lit(1)).alias(alias)).drop("__day")


def windowed_count(stream: DataFrame, ts: str, length: str, slide: str | None, keys: Sequence[str],
                   watermark: str) -> DataFrame:
    """Counts per event-time window (tumbling if ``slide`` is None) and key."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (stream.withWatermark(ts, watermark)
                  .groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias("n")))


def bucket_time(ts: str, seconds: int, alias: str) -> F.Column:
    """Floor a timestamp to a multiple of ``seconds`` since the epoch."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts)) / seconds) * seconds).alias(alias)


def processing_time_count(stream: DataFrame, length: str, slide: str | None, keys: Sequence[str]) -> DataFrame:
    """Counts per *arrival-time* window, like the original batch-interval
    windows: ``current_timestamp()`` is fixed per micro-batch, so every row
    of a batch falls in the windows of that batch's start time.  Window
    boundaries depend on when batches run, so results are checked by
    totals, not against an oracle; run in update or complete mode."""
    t = F.current_timestamp()
    w = F.window(t, length, slide) if slide else F.window(t, length)
    return stream.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))


def stop_gracefully(query, should_stop, poll_seconds: float = 0.5, timeout_seconds: float = 600.0) -> bool:
    """Stop ``query`` once ``should_stop()`` is true (e.g. a marker file was
    written), waiting for the running micro-batch to finish first.  Returns
    True when the query was stopped by the flag, False on timeout."""
    import time
    deadline = time.monotonic() + timeout_seconds
    while query.isActive and time.monotonic() < deadline:
        if should_stop():
            while query.isActive and query.status.get("isTriggerActive"):
                time.sleep(poll_seconds / 5)
            query.stop()
            return True
        time.sleep(poll_seconds)
    return False


def marker_exists(path: str):
    """Predicate for ``stop_gracefully``: a marker file on any pyarrow filesystem."""
    def check() -> bool:
        from tessera.streaming.replay import _arrow_fs
        from pyarrow import fs as pafs
        filesystem, p = _arrow_fs(path)
        return filesystem.get_file_info(p).type != pafs.FileType.NotFound
    return check
