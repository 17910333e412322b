"""Sliding windows by panes that enter and leave.

A window of length k * slide is k panes of one slide each.  Events are counted per pane and
key inside their task; the state of a key is one count per pane, so an event changes one
pane, not k windows.  Windows that hold a changed pane are gone through in order: the first
is summed, each next one adds the pane that enters and subtracts the one that leaves.

A window without events that follows one with events is emitted once, with count 0, when
the watermark has passed it; the panes behind it then leave the state, and a key without
panes leaves it altogether.  Events older than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.replay import session_conf

BLOCK = 32                 # panes of an entry of the state
MERGE_ROWS = 1 << 16       # rows that a task holds before it counts them, at least
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark):
    """Queries started inside keep their state in RocksDB, which keyed state and timers need."""
    return session_conf(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def slide_totals(counts: dict[int, int], panes: Sequence[int], k: int) -> Iterator[tuple[int, int]]:
    """(first pane, total) of every window of k panes that holds one of ``panes``."""
    total, last = 0, None
    for start in sorted({p - j for p in panes for j in range(k)}):
        if last is None or start != last + 1:
            total = sum(counts.get(start + j, 0) for j in range(k))
        else:
            total += counts.get(start + k - 1, 0) - counts.get(last, 0)
        last = start
        yield start, total


class PaneWindows(StatefulProcessor):
    """Input rows (keys..., pane timestamp, n); output rows (keys..., window_start, window_end, n)."""

    def __init__(self, keys: Sequence[str], slide_ms: int, k: int):
        self.keys, self.slide_ms, self.k = list(keys), slide_ms, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a count per pane; BLOCK panes side by side share an entry, since each entry is a call
        self.blocks = handle.getMapState("panes", "block long", "n array<long>")

    def _load(self) -> dict[int, int]:
        return {int(b) * BLOCK + j: int(n) for (b,), (row,) in self.blocks.iterator() for j, n in enumerate(row) if n}

    def _save(self, counts: dict[int, int], changed) -> None:
        for b in {p // BLOCK for p in changed}:
            row = [counts.get(b * BLOCK + j, 0) for j in range(BLOCK)]
            if any(row):
                self.blocks.updateValue((b,), (row,))
            else:
                self.blocks.removeKey((b,))

    def _due(self, pane: int) -> int:
        # half a slide behind the end of the first window without the pane: never equal to a watermark
        return (pane + self.k + 1) * self.slide_ms + self.slide_ms // 2

    def _out(self, key: tuple, rows: list[tuple[int, int]]) -> pd.DataFrame:
        start = pd.to_datetime(pd.Series([p * self.slide_ms for p, _ in rows], dtype="int64"), unit="ms")
        out = pd.DataFrame({name: [value] * len(rows) for name, value in zip(self.keys, key)})
        out["window_start"], out["window_end"] = start, start + pd.Timedelta(milliseconds=self.k * self.slide_ms)
        out["n"] = pd.Series([n for _, n in rows], dtype="int64")
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new: dict[int, int] = {}
        for part in rows:
            at = part["pane"].astype("datetime64[ms]").astype("int64") // self.slide_ms
            for pane, n in part["n"].groupby(at).sum().items():
                new[int(pane)] = new.get(int(pane), 0) + int(n)
        counts = self._load()
        if not counts:
            self.handle.registerTimer(self._due(min(new)))
        for pane, n in new.items():
            counts[pane] = counts.get(pane, 0) + n
        self._save(counts, new)
        yield self._out(key, list(slide_totals(counts, list(new), self.k)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The key's one timer: all panes that no open window holds leave together."""
        passed = timerValues.getCurrentWatermarkInMs()
        counts = self._load()
        held = sorted(counts)
        gone = [p for p in held if self._due(p) <= passed]
        following = dict(zip(held, held[1:]))
        for p in gone:
            del counts[p]
        self._save(counts, gone)
        if len(gone) < len(held):
            self.handle.registerTimer(self._due(held[len(gone)]))
        empty = [(p + 1, 0) for p in gone if following.get(p, p + self.k + 1) > p + self.k]
        if empty:
            yield self._out(key, empty)

    def close(self) -> None:
        pass


def counted(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(names..., n): the rows of a task counted per key.

    Rows are merged into the counts once there are as many of them as counts, so that the
    counts so far are not gone through again for every batch of rows."""
    held, fresh, waiting = None, [], 0

    def merged() -> pa.Table:
        both = pa.concat_tables([*([] if held is None else [held]), *fresh])
        return both.group_by(names).aggregate([("n", "sum")]).select([*names, "n_sum"]).rename_columns([*names, "n"])

    for batch in batches:
        fresh.append(pa.Table.from_batches([batch]).append_column("n", pa.array([1] * batch.num_rows, pa.int64())))
        waiting += batch.num_rows
        if waiting >= max(MERGE_ROWS, 0 if held is None else held.num_rows):
            held, fresh, waiting = merged(), [], 0
    if fresh:
        held = merged()
    if held is not None:
        yield from held.to_batches()


def pane_counts(stream: DataFrame, ts: str, slide: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., pane, n): events counted per task, so that a hot key is a few rows."""
    pane = F.window(F.col(ts), slide).start.alias("pane")
    rows = stream.where(F.col(ts).isNotNull()).select(*keys, pane)
    names = [*keys, "pane"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from counted(batches, names)

    return rows.mapInArrow(count, T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())]))


def sliding_counts(stream: DataFrame, ts: str, length_seconds: int, slide_seconds: int, keys: Sequence[str],
                   watermark: str) -> DataFrame:
    """Running counts (keys..., window_start, window_end, n) of sliding windows, in update mode.

    The length must be a multiple of the slide.  Start the query inside ``keyed_state``."""
    if length_seconds % slide_seconds:
        raise ValueError("the window's length must be a multiple of its slide")
    counts = pane_counts(stream, ts, f"{slide_seconds} seconds", keys).withWatermark("pane", watermark)
    fields = [counts.schema[k] for k in keys]
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], T.StructField("window_start", T.TimestampType()),
                        T.StructField("window_end", T.TimestampType()), T.StructField("n", T.LongType())])
    return counts.groupBy(*keys).transformWithStateInPandas(
        PaneWindows(keys, slide_seconds * 1000, length_seconds // slide_seconds), out, "Update", "EventTime")
