"""File-drop replay of a table as a stream, and idempotent batch sinks.

``Replay`` writes an input once, cut into numbered batches, moves the files
of batch b into the source folder and restarts the streaming query from its
checkpoint with ``trigger(availableNow=True)``: every restart is
exactly one micro-batch over exactly one input batch, and every restart is
a resume from the checkpoint (offsets, commits and state store).

Sinks run in ``foreachBatch`` and write each micro-batch to its own
``batch_id=N`` folder with overwrite, so a retried batch replaces its own
output instead of adding to it.  ``latest`` turns an update-mode log into
the current table (newest row per key).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from tessera.session import work_dir


def assign_batches(df: DataFrame, ts_col: str, n: int, alias: str = "batch") -> DataFrame:
    """Batch number 0..n-1 from equal event-time ranges of ``ts_col``.

    The two range ends come from one small aggregate (a single row)."""
    t = F.unix_micros(F.col(ts_col))
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    if lo is None:
        return df.withColumn(alias, F.lit(0))
    return df.withColumn(alias, F.expr(f"CAST(((unix_micros({ts_col}) - {lo}) * {n}) div ({hi - lo + 1}) AS INT)"))


def sql_batches(ts_col: str, n: int, table: str) -> str:
    """DuckDB twin of ``assign_batches`` as a select-list expression."""
    return (f"CAST(((epoch_us({ts_col}) - (SELECT min(epoch_us({ts_col})) FROM {table})) * {n}) // "
            f"((SELECT max(epoch_us({ts_col})) - min(epoch_us({ts_col})) FROM {table}) + 1) AS INTEGER)")


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Temporarily set a SQL conf (streaming settings are read when a query starts)."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def shuffle_partitions(spark: SparkSession, n: int):
    """Temporarily set the shuffle partitions (read when a query starts)."""
    return session_conf(spark, "spark.sql.shuffle.partitions", str(n))


class BatchListener(StreamingQueryListener):
    """Numbers of starts and of micro-batches with input that a query went through."""

    def __init__(self):
        self.starts, self.batches, self._events, self._id = 0, [], [], None
        self._ended, self._lock = threading.Event(), threading.Lock()
        self._stop, self._most = None, None

    def watch(self, query_id: str, stop: Callable[[], None], most: int | None = None) -> None:
        with self._lock:  # events that came before the id was known
            self._id, self._stop, self._most = query_id, stop, most
            held, self._events = self._events, []
        for kind, of, batch in held:
            self._take(kind, of, batch)

    def _take(self, kind: str, of: str, batch: int | None = None) -> None:
        with self._lock:
            if self._id is None:
                self._events.append((kind, of, batch))
                return
        if of != self._id:
            return
        if kind == "start":
            self.starts += 1
        elif kind == "batch":
            self.batches.append(batch)
            if self._most is not None and len(self.batches) == self._most:
                threading.Thread(target=self._stop, daemon=True).start()  # not from the listener's own thread
        else:
            self._ended.set()

    def onQueryStarted(self, event):  # noqa: N802
        self._take("start", str(event.id))

    def onQueryProgress(self, event):  # noqa: N802
        if event.progress.numInputRows:
            self._take("batch", str(event.progress.id), event.progress.batchId)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self._take("end", str(event.id))

    def wait_until_ended(self, seconds: float = 60.0) -> None:
        """Events come behind the run on a thread of their own."""
        self._ended.wait(seconds)


class Replay:
    """Feed ``source`` (with an int batch column) through a streaming query."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = work_dir(spark, "stream", name)
        self.staged = self.root + "/staged"
        self.src = self.root + "/src"
        self.ckpt = self.root + "/checkpoint"
        self.out = self.root + "/out"

    def stream(self, schema) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(self.src + "/*")

    def stage(self, source: DataFrame, batch_col: str) -> list[int]:
        """Write the source once, one folder per batch; rows without a batch go to batch 0."""
        feed = source.withColumn("__feed", F.coalesce(F.col(batch_col).cast("int"), F.lit(0)))
        feed.write.partitionBy("__feed").parquet(self.staged)
        found = self.fs.listStatus(self._path(self.staged))
        return sorted(int(s.getPath().getName().split("=")[1]) for s in found
                      if s.getPath().getName().startswith("__feed="))

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    @property
    def fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def feed(self, batch: int) -> None:
        """Move a staged batch into the watched folder (a rename, no copy)."""
        self.fs.mkdirs(self._path(self.src))
        if not self.fs.rename(self._path(f"{self.staged}/__feed={batch}"), self._path(f"{self.src}/part{batch:05d}")):
            raise RuntimeError(f"batch {batch} could not be moved to {self.src}")

    def run(self, source: DataFrame, batch_col: str, build: Callable[[DataFrame], DataStreamWriter],
            state_partitions: int | None = None, after: Callable[[], None] | None = None) -> None:
        """Feed batch after batch, (re)starting the query until it has consumed each; ``after``
        runs behind every batch (a query that follows this one).

        The state-store partition count of a stream is fixed by its first
        start (the checkpoint keeps it): ``state_partitions``, by default one
        per core of the cluster."""
        parts = state_partitions or self.spark.sparkContext.defaultParallelism
        for b in self.stage(source, batch_col):
            self.feed(b)
            writer = build(self.stream(source.schema)).option("checkpointLocation", self.ckpt)
            with shuffle_partitions(self.spark, parts):
                q = writer.trigger(availableNow=True).start()
                q.awaitTermination()
            if q.exception() is not None:  # pragma: no cover - surfaced to caller
                raise RuntimeError(str(q.exception()))
            if after is not None:
                after()

    def drain(self, writer: DataStreamWriter, name: str, state_partitions: int | None = None) -> None:
        """Let a following query, with a checkpoint of its own, take all that is there."""
        with shuffle_partitions(self.spark, state_partitions or self.spark.sparkContext.defaultParallelism):
            writer.option("checkpointLocation", f"{self.ckpt}-{name}").trigger(availableNow=True).start().awaitTermination()

    def run_queue(self, source: DataFrame, batch_col: str, each: Callable[[DataFrame, int], None],
                  max_batches: int | None = None) -> BatchListener:
        """Hand a queue of prepared batches to ``each(rows, batch_id)``, one per trigger, in one run.

        The queue holds one small file per batch that names its folder, and the stream takes
        one file per trigger, so a batch may hold any number of files and is read in
        parallel.  The query starts once; a restart goes on behind the last finished batch
        (``max_batches`` stops it early).  Returns the listener that saw the run's batches."""
        queue = self.root + "/queue"
        for b in self.stage(source, batch_col):
            name = self._path(f"{queue}/{b:08d}.txt")
            if not self.fs.exists(name):
                stream = self.fs.create(name)
                stream.write(f"{self.staged}/__feed={b}\n".encode())
                stream.close()
        return self.take_queue(source.schema, each, max_batches)

    def take_queue(self, schema, each: Callable[[DataFrame, int], None], max_batches: int | None = None) -> BatchListener:
        """Start the queue's query (again)."""
        def per_batch(names: DataFrame, batch_id: int) -> None:
            folders = [r.value for r in names.collect()]  # one name per trigger
            if folders:
                each(self.spark.read.schema(schema).parquet(*folders), batch_id)

        seen = BatchListener()
        self.spark.streams.addListener(seen)
        try:
            stream = self.spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(self.root + "/queue")
            q = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", self.ckpt).trigger(availableNow=True).start()
            seen.watch(str(q.id), q.stop, max_batches)
            q.awaitTermination()
            seen.wait_until_ended()
        finally:
            self.spark.streams.removeListener(seen)
        return seen

    # ------------------------------------------------------------------ sinks

    def batch_sink(self) -> Callable[[DataFrame, int], None]:
        return batch_sink(self.out)

    def read_out(self) -> DataFrame:
        return self.spark.read.parquet(self.out)


def batch_sink(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each micro-batch overwrites its own
    ``out/batch_id=N`` folder, so a retried batch is idempotent."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def latest(log: DataFrame, keys: Sequence[str], order_col: str = "batch_id") -> DataFrame:
    """Newest row per key of an update-mode output log."""
    values = [c for c in log.columns if c not in keys and c != order_col]
    m = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order_col)).alias("__v"))
    return m.select(*keys, *[F.col("__v." + c).alias(c) for c in values])


def window_bounds(w: Column | str = "window") -> list[Column]:
    """``window`` struct as two text columns (UTC wall clock)."""
    c = F.col(w) if isinstance(w, str) else w
    return [F.date_format(c.start, "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            F.date_format(c.end, "yyyy-MM-dd HH:mm:ss").alias("window_end")]


def _arrow_fs(target: str):
    """pyarrow filesystem + path for a Hadoop-style location."""
    from pyarrow import fs as pafs
    if target.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + target[len("file:"):].lstrip("/")
    if "://" in target:
        return pafs.FileSystem.from_uri(target)
    return pafs.LocalFileSystem(), target
