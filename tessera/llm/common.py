"""Helpers shared by the operators: table reads, materialised steps, components.

Intermediate results go to Parquet in the shared work folder (``spark.checkpoint.dir``),
so a lost executor costs only its own tasks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and return the table read back."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SPAN = 1 << 16             # copies of one row that a task expands together


def counted(df: DataFrame, *cols: str) -> DataFrame:
    """The distinct rows of ``cols`` with their number of ``copies``, in parts of at most SPAN."""
    whole = df.groupBy(*cols).agg(F.count("*").alias("__all"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__all") - 1) / SPAN).cast("long"))).alias("part")
    return (whole.select(*cols, "__all", part)
            .withColumn("copies", F.least(F.lit(SPAN).cast("long"), F.col("__all") - F.col("part") * SPAN)).drop("__all"))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose summed size stays near ``limit`` (one item at least)."""
    lo, total, n = 0, 0, 0
    for n, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield lo, n
            lo, total = n, 0
    if lo < n:
        yield lo, n


TEXT_BYTES = 4 << 20       # text that a task holds as Python objects at a time


def _small(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(text % batch.num_columns)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        for lo, hi in slices(sizes, TEXT_BYTES):
            yield batch.slice(lo, hi - lo)


def _release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable, text: int | None = None) -> Callable:
    """``run`` for mapInArrow with bounded memory: its batches hold about TEXT_BYTES of
    the column numbered ``text`` (or one row), and what the task has freed goes back to
    the system at its end, since Spark keeps the worker for other stages."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches if text is None else _small(batches, text))
        finally:
            _release()
    return wrapped


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        # also hook the roots, so that labels spread along whole trees
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(label, before):
            break
    return label


def star_edges(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between positions of ``ids`` as (member id, root id) pairs, one per linked member."""
    used, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = local_components(len(used), inverse[: len(a)], inverse[len(a):])
    moved = np.flatnonzero(label != np.arange(len(used)))
    return ids[used[moved]], ids[used[label[moved]]]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > 1_000_000:  # keep the forest only
            a, b = _forest(a, b)
    if len(a):
        a, b = _forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    return star_edges(ids, inverse[: len(a)], inverse[len(a):])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` (long): rows (node, root), root the least node.

    Alternating large-star and small-star passes.  Each pass is a partial ``min`` per
    node and a join back, so a hub is pre-aggregated and its join partition can be
    split; each pass is written to the shared folder, which cuts the lineage.  Nodes
    without a link do not appear.
    """
    schema = "a long, b long"
    links = stored(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                   .where("a <> b").mapInArrow(_contract, schema), name)
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        links = stored(small, name)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
