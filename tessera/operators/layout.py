"""Row positions, logical slices and physical layout.

``row_index`` gives a dense 0-based position in a total order without a
one-partition window: the data is range-partitioned on the order key and
sorted inside each range; each row's position inside its range comes from
``monotonically_increasing_id`` (partition id in the high bits, row number
in the low 33 bits); the per-range row counts (one small row per range)
are turned into offsets with a window over those few rows and broadcast
back.  ``slice_assign`` then maps a position to the slice a parallelized
collection of n elements in p slices would put it in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

_LOW_BITS = (1 << 33) - 1
RANGE_BYTES = 1 << 30      # estimated size of one range


def range_count(df: DataFrame) -> int:
    """Ranges to cut ``df`` into: by its estimated size after column pruning,
    one per core at least; the number of input splits plays no part."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(-(-size // RANGE_BYTES), 1_000_000))


def row_index(df: DataFrame, order: Sequence[str | Column], alias: str = "idx",
              n_ranges: int | None = None, with_total: str | None = None) -> DataFrame:
    """Append a dense position (0..n-1) in the order ``order``.

    ``order`` must be a total order (unique), otherwise equal rows get an
    arbitrary but still dense numbering.  The range-partitioned, numbered
    rows are checkpointed once (reliable storage in the session's
    checkpoint folder): a range exchange samples its bounds with a seed
    that differs per exchange, so the per-range counts and the numbered
    rows must come from one materialised copy, which also keeps the index
    stable when an executor is lost and work is recomputed.
    """
    from tessera.session import work_dir
    spark = df.sparkSession
    work_dir(spark, "index")  # ensures a checkpoint folder exists
    n = n_ranges or range_count(df)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("__rng", F.shiftright(F.col("__mid"), 33)) \
                   .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit(_LOW_BITS))) \
                   .drop("__mid").checkpoint(eager=True)
    counts = ranged.groupBy("__rng").agg(F.count(F.lit(1)).alias("__cnt"))
    # At most n rows: a global window over them is cheap and bounded.
    w = Window.orderBy("__rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__rng", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"),
                            F.sum("__cnt").over(Window.partitionBy()).alias("__total"))
    out = ranged.join(F.broadcast(offsets), "__rng")
    out = out.withColumn(alias, F.col("__off") + F.col("__pos"))
    if with_total:
        out = out.withColumnRenamed("__total", with_total)
    return out.drop("__rng", "__pos", "__off", "__total")


def slice_of(index: Column, n: Column | int, p: int) -> Column:
    """Slice of element ``index`` (0-based) when n elements are cut into p
    slices the way a parallelized collection is: slice s covers
    [s*n/p, (s+1)*n/p)."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.floor(((index + 1) * p - 1) / n_col).cast("bigint")


def slice_assign(df: DataFrame, order: Sequence[str | Column], p: int, alias: str = "slice",
                 index_alias: str = "idx") -> DataFrame:
    """Dense index + logical slice (of p) for every row."""
    ix = row_index(df, order, index_alias, with_total="__n")
    return ix.withColumn(alias, slice_of(F.col(index_alias), F.col("__n"), p)).drop("__n")


def partition_by_id(df: DataFrame, n: int, pid: Column) -> DataFrame:
    """Custom partitioner: rows go to the partition given by ``pid``."""
    return df.repartitionById(n, pid)


def persist(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return df.persist(level)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder."""
    from tessera.session import work_dir
    work_dir(df.sparkSession, "ckpt")  # makes sure a checkpoint folder is set
    return df.checkpoint(eager=eager)
