"""Keyed and global aggregations.

Everything here is a hash aggregate with a partial (map-side) phase, so a
key holding a third of the rows is pre-combined inside every task and only
one small row per task and key crosses the shuffle.  Nothing collects a
group into an array.

Partition-dependent RDD semantics (``aggregateByKey`` with different in-
and cross-partition rules, ``fold``/``aggregate`` with a zero value) are
computed on a *logical* slice column (see ``layout.slice_assign``), never
on physical partitions, so answers do not depend on the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reduce_by_key(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """``reduceByKey(_ + _)``."""
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def group_by_key_long(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``groupByKey`` as a multiset: one row per (key, value) with its count."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def group_by_expr(df: DataFrame, expr: Column, alias: str) -> DataFrame:
    """``groupBy(f)``: group on a computed value; count members."""
    return df.groupBy(expr.alias(alias)).agg(F.count(F.lit(1)).alias("n"))


def aggregate_by_slice(df: DataFrame, keys: Sequence[str], value: str, slice_col: str, zero,
                       within: str = "max", across: str = "sum", alias: str = "value") -> DataFrame:
    """``aggregateByKey(zero)(seqOp, combOp)`` on logical slices.

    ``within`` folds the values of one key inside one slice starting from
    ``zero``; ``across`` combines the per-slice results of a key.  Both
    phases are ordinary grouped aggregates.
    """
    inner = {
        "max": lambda v: F.greatest(F.lit(zero), F.max(v)),
        "min": lambda v: F.least(F.lit(zero), F.min(v)),
        "sum": lambda v: F.lit(zero) + F.sum(v),
    }[within](F.col(value))
    per_slice = df.groupBy(*keys, slice_col).agg(inner.alias("__part"))
    outer = {"sum": F.sum, "max": F.max, "min": F.min}[across](F.col("__part"))
    return per_slice.groupBy(*keys).agg(outer.alias(alias))


def fold_by_key(df: DataFrame, keys: Sequence[str], value: str, slice_col: str, zero,
                alias: str = "value") -> DataFrame:
    """``foldByKey(zero)(_ + _)``: zero is added once per (key, slice)."""
    return aggregate_by_slice(df, keys, value, slice_col, zero, "sum", "sum", alias)


def avg_int(df: DataFrame, keys: Sequence[str], value: str, alias: str = "avg") -> DataFrame:
    """Average by (sum, count) with integer (truncating) division."""
    return df.groupBy(*keys).agg(
        F.expr(f"sum(CAST({value} AS BIGINT)) div count({value})").alias(alias))


def count_by(df: DataFrame, *keys: str, alias: str = "n") -> DataFrame:
    """``countByKey`` / ``countByValue``, kept distributed."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, alias: str, approx: bool = False,
                   rsd: float = 0.05) -> DataFrame:
    """``count(DISTINCT col)`` per group.  The exact form runs as two hash
    aggregates (group + value, then group); ``approx`` uses a HyperLogLog++
    sketch per group (fixed size, one partial/final aggregate)."""
    f = F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col)
    return df.groupBy(*keys).agg(f.alias(alias))


def conditional_counts(df: DataFrame, keys: Sequence[str], col: str, values: dict[str, str]) -> DataFrame:
    """``sum(case when col = v then 1 else 0 end)`` per alias -> value."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(col) == v, 1).otherwise(0)).cast("bigint").alias(a)
        for a, v in values.items()])


def union_pivot(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Counts of several inputs aligned by a union of zero-padded rows.

    Each input contributes (key, 1, 0, ...) style rows; one grouped sum
    aligns them (the cogroup-free form).
    """
    names = list(parts)
    unioned = None
    for i, name in enumerate(names):
        cols = [F.col(key)] + [F.lit(1 if j == i else 0).alias(f"{n}_cnt") for j, n in enumerate(names)]
        p = parts[name].select(*cols)
        unioned = p if unioned is None else unioned.unionByName(p)
    return unioned.groupBy(key).agg(*[F.sum(f"{n}_cnt").cast("bigint").alias(f"{n}_cnt") for n in names])


def nested_histogram(df: DataFrame, item: str, count_alias: str, items_alias: str) -> DataFrame:
    """How many items have each occurrence count (a group of a group)."""
    per_item = df.groupBy(item).agg(F.count(F.lit(1)).alias(count_alias))
    return per_item.groupBy(count_alias).agg(F.count(F.lit(1)).alias(items_alias))


def stats(df: DataFrame, col: str) -> DataFrame:
    """max / min / mean of a column."""
    return df.agg(F.max(col).alias("max_" + col), F.min(col).alias("min_" + col),
                  F.avg(col).alias("mean_" + col))


def aggregate_with_zero(df: DataFrame, value: str, n_slices: int, zero) -> DataFrame:
    """RDD ``aggregate(zero)(_+_, _+_)`` / ``fold`` over ``n_slices`` slices:
    zero enters once per slice (empty ones too) and once more at the final
    merge.  A sum does not depend on where the slices are cut, so none is made."""
    return df.agg((F.sum(value) + F.lit(zero) * (n_slices + 1)).alias("result"))
