"""Sorting, global top-k and per-group top-n.

Global top-k uses ``orderBy(...).limit(k)`` (TakeOrderedAndProject: a
per-task heap of k rows, then one small merge).  Per-group limits use a
ranking window followed by a filter; Spark turns that pair into a
WindowGroupLimit that trims each group inside every map task before the
shuffle, so a hot group sends at most n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sort_by(df: DataFrame, *order: Column | str) -> DataFrame:
    """Total order (range-partitioned sort)."""
    return df.orderBy(*_cols(order))


def sort_numeric_text(df: DataFrame, col: str, ascending: bool = True) -> DataFrame:
    """Sort string keys by their numeric value ("11" after "2")."""
    key = F.col(col).cast("bigint")
    return df.orderBy(key.asc() if ascending else key.desc(), F.col(col))


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """The k first rows of a total order (ties must be broken in ``order``)."""
    return df.orderBy(*_cols(order)).limit(k)


def take_ordered(df: DataFrame, col: str, k: int) -> DataFrame:
    """``takeOrdered(k)``: the k smallest values."""
    return df.orderBy(F.col(col).asc()).limit(k)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """At most n rows per group, ties cut by ``order`` (row_number)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out.withColumn(name, F.col(name).cast("bigint")) if rank_col else out.drop(name)


def rank_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
             rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` in their group is at most n; ties are kept."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    out = df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= n)
    return out.withColumn(rank_col, F.col(rank_col).cast("bigint"))
