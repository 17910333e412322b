"""Ordered neighbours inside a group.

``next_in_group`` is ``lead(value)`` over (group ordered by time, id), computed so that a
session holding a third of all rows is not one window task.

* ``split="range"`` (the default): one range exchange sorts the rows by (group, time, id) into
  ranges balanced by row count whatever the skew.  Each task shifts its sorted Arrow batches
  by one row.  Only the last row of a range lacks its successor, and only the group that ends
  a range can go on in the next, so one row per range, its first, closes the gaps: these few
  rows are broadcast, and nothing else is exchanged.  The shifted rows are checkpointed once,
  because the bounds of a range exchange differ between runs.
* ``split="time"``: rows are cut into event-time buckets, ``lead`` runs inside each (group,
  bucket), and the last row of a bucket takes the first row of the group's next one.  No range
  sort, but a group whose rows crowd into one bucket stays in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.layout import range_count


def next_in_group(df: DataFrame, keys: Sequence[str], time_col: str, tie_col: str, value: str,
                  alias: str, split: str = "range", bucket_seconds: int = 3600,
                  n_ranges: int | None = None) -> DataFrame:
    """Append ``alias`` = value of the next row of the same group in
    (time_col, tie_col) order, NULL for the last row."""
    if split == "range":
        return _next_in_ranges(df, keys, time_col, tie_col, value, alias, n_ranges)
    bucket = F.floor(F.unix_micros(F.col(time_col)) / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    return _stitch(df.withColumn("__b", bucket), keys, time_col, tie_col, value, alias)


def _shifted(batch: pa.RecordBatch, name: str, after: pa.RecordBatch | None) -> pa.Array:
    """The column one row further; null behind the last row if no batch follows."""
    column = batch.column(name)
    end = after.column(name).slice(0, 1) if after is not None else pa.nulls(1, column.type)
    return pa.concat_arrays([column.slice(1), end])


def _equal(a: pa.Array, b: pa.Array) -> pa.Array:
    """Null-safe equality; NaN equals NaN, as in a group."""
    same = pc.fill_null(pc.equal(a, b), False)
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))


def _next_in_ranges(df: DataFrame, keys: Sequence[str], time_col: str, tie_col: str, value: str, alias: str,
                    n_ranges: int | None) -> DataFrame:
    from tessera.session import work_dir
    work_dir(df.sparkSession, "ranges")  # ensures a checkpoint folder exists

    def mark(batch: pa.RecordBatch, after: pa.RecordBatch | None, first: bool) -> pa.RecordBatch:
        n = batch.num_rows
        last = pa.array([False] * (n - 1) + [after is None])
        same = pc.invert(last)
        for k in keys:
            same = pc.and_(same, _equal(batch.column(k), _shifted(batch, k, after)))
        found = _shifted(batch, value, after)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pc.if_else(same, found, pa.nulls(n, found.type)), pa.array([TaskContext.get().partitionId()] * n, pa.int32()),
             pa.array([first] + [False] * (n - 1)), last], [*batch.schema.names, alias, "__b", "__first", "__last"])

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield mark(held, batch, first)
                    first = False
                held = batch
        if held is not None:
            yield mark(held, None, first)

    fields = [*df.schema.fields, T.StructField(alias, df.schema[value].dataType), T.StructField("__b", T.IntegerType()),
              T.StructField("__first", T.BooleanType()), T.StructField("__last", T.BooleanType())]
    order = [*keys, time_col, tie_col]
    marked = (df.repartitionByRange(n_ranges or range_count(df), *order).sortWithinPartitions(*order)
              .mapInArrow(shift, T.StructType(fields)).checkpoint(eager=True))
    # at most one row per range: a global window over them and their broadcast are small
    behind = Window.orderBy("__b")
    links = marked.where("__first").select("__b", *[F.lead(F.struct(F.col(k))).over(behind).alias(f"__k{i}") for i, k in enumerate(keys)],
                                           F.lead(value).over(behind).alias("__next"))
    goes_on = F.col("__last")
    for i, k in enumerate(keys):  # the field of a missing struct is no key at all
        goes_on = goes_on & F.col(f"__k{i}").isNotNull() & F.col(k).eqNullSafe(F.col(f"__k{i}")[k])
    out = marked.join(F.broadcast(links), "__b", "left")
    return out.withColumn(alias, F.when(goes_on, F.col("__next")).otherwise(F.col(alias))).select(*df.columns, alias)


def range_pieces(df: DataFrame, order: Sequence[str], n_ranges: int | None = None,
                 alias: str = "__b") -> DataFrame:
    """Tag rows with the range (of a global sort on ``order``) they fall in.

    Ranges are balanced by row count whatever the key skew; the tagged copy
    is checkpointed once (reliable storage) so the tags stay stable when
    work is recomputed."""
    from tessera.session import work_dir
    spark = df.sparkSession
    work_dir(spark, "ranges")  # ensures a checkpoint folder exists
    n = n_ranges or range_count(df)
    return (df.repartitionByRange(n, *order)
              .withColumn(alias, F.spark_partition_id().cast("bigint"))
              .checkpoint(eager=True))


def _stitch(pieces: DataFrame, keys: Sequence[str], time_col: str, tie_col: str, value: str,
            alias: str) -> DataFrame:
    """lead inside (group, piece) + the next piece's first value at piece ends.

    The keys travel as one struct, which is never null itself, so that the window's
    partitioning and order on (group, piece) serve the join as well: rows without a key are
    a group like any other, and the big side is exchanged once."""
    d = pieces.withColumn("__g", F.struct(*keys))
    inner = Window.partitionBy("__g", "__b").orderBy(time_col, tie_col)
    d = (d.withColumn(alias, F.lead(value).over(inner))
          .withColumn("__last", F.lead(F.lit(1)).over(inner).isNull())
          .withColumn("__first", F.lag(F.lit(1)).over(inner).isNull()))
    per_group = Window.partitionBy("__g").orderBy("__b")
    links = d.where(F.col("__first")).select("__g", "__b", F.lead(F.col(value)).over(per_group).alias("__next_piece"))
    out = d.join(links, ["__g", "__b"], "left")
    out = out.withColumn(alias, F.when(F.col("__last"), F.col("__next_piece")).otherwise(F.col(alias)))
    return out.drop("__g", "__b", "__last", "__first", "__next_piece")
