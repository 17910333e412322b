"""Projections, filters, joins and set operations.

All of these are thin, declarative DataFrame compositions: Catalyst pushes
the filters into the scan, prunes columns and picks join strategies (AQE
re-plans at runtime; explicit broadcasts only on sides with a proven
bound, e.g. the output of a ``limit``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


# ---------------------------------------------------------------- projections


def rename_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def flat_map_split(df: DataFrame, col: str, sep: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lines -> one row per piece (``flatMap(_.split(sep))``)."""
    return df.select(*keep, F.explode(F.split(F.col(col), sep)).alias(alias))


def map_values(df: DataFrame, value: str, fn: Callable[[Column], Column], keep: Sequence[str]) -> DataFrame:
    """Transform the value column, keep the key columns."""
    return df.select(*keep, fn(F.col(value)).alias(value))


def swap_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(b, a)


def map_in_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """Per-partition batch transform (``mapPartitions``) on Arrow batches."""
    return df.mapInArrow(fn, schema)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


# ---------------------------------------------------------------- filters


def filter_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.where(F.col(col).contains(F.lit(needle)))


def filter_between(df: DataFrame, col: str, low, high) -> DataFrame:
    """Inclusive at both ends, like SQL ``BETWEEN``."""
    return df.where(F.col(col).between(low, high))


def filter_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str], small: bool = False) -> DataFrame:
    """Keep rows whose key is in ``keys`` (left semi join).

    ``small=True`` only for key sets with a proven bound (a limit's output);
    otherwise AQE chooses broadcast or shuffle from runtime sizes.
    """
    k = F.broadcast(keys) if small else keys
    return df.join(k, on, "left_semi")


def filter_not_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str], small: bool = False) -> DataFrame:
    """Drop rows whose key is in ``keys`` (left anti join)."""
    k = F.broadcast(keys) if small else keys
    return df.join(k, on, "left_anti")


def drop_sparse_rows(df: DataFrame, max_missing: int,
                     seen: Observation | None = None, kept: Observation | None = None) -> DataFrame:
    """Drop rows with more than ``max_missing`` nulls (``na.drop(thresh)``).

    Optional ``Observation``s collect the row counts before and after as
    side metrics of whatever action runs the result (no second pass);
    dropped = seen.rows - kept.rows.
    """
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = df.na.drop(thresh=len(df.columns) - max_missing)
    if kept is not None:
        out = out.observe(kept, F.count(F.lit(1)).alias("rows"))
    return out


def null_count(cols: Sequence[str]) -> Column:
    """Number of nulls among ``cols`` in a row."""
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def sample_rows(df: DataFrame, with_replacement: bool, fraction: float, seed: int) -> DataFrame:
    """Bernoulli (without) or Poisson (with replacement) sampling per row."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def uniform_draw(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) with 52 bits, drawn from the MD5 of ``seed:key|key...``.

    It depends on the key and the seed alone, not on partitions, order or engine.  A null
    key is an empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / float(1 << 52)


def poisson_steps(mean: float) -> list[float]:
    """P(count <= 0), P(count <= 1), ...: a draw u stands for as many copies as steps lie at or below it."""
    steps, term, total = [], math.exp(-mean), 0.0
    for k in range(1, 10_000):
        total += term
        if total >= 1 or (k > mean and term < 2.0**-53):
            break
        steps.append(total)
        term *= mean / k
    return steps


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: int, with_replacement: bool = False,
                  copies: str = "copies") -> DataFrame:
    """Bernoulli or Poisson sample whose draws belong to the rows' keys.

    Without replacement a row stays if its draw is below ``fraction``; with replacement it
    stands for a Poisson number of copies of that mean.  The number goes to the column
    ``copies`` (1 without replacement) instead of repeating the row.  Rows that share a key
    share its draw: name columns that tell rows apart.  A filter and a projection, nothing
    is exchanged, and a rerun of a lost task draws the same rows."""
    draw = uniform_draw(keys, seed)
    if not with_replacement:
        return df.where(draw < fraction).withColumn(copies, F.lit(1).cast("bigint"))
    u = "__draw"
    count = F.lit(0)
    for step in poisson_steps(fraction):
        count = count + F.when(F.col(u) >= step, 1).otherwise(0)
    return df.withColumn(u, draw).withColumn(copies, count.cast("bigint")).where(F.col(copies) > 0).drop(u)


# ---------------------------------------------------------------- joins

def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right, on, how)


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, value: str, default=0,
                        small: bool = False) -> DataFrame:
    """Map-side lookup: left join to a dimension, ``default`` on a miss."""
    d = F.broadcast(dim) if small else dim
    j = df.join(d, key, "left")
    return j.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def cogroup_counts(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """n-way cogroup reduced to counts: key -> count per side, 0 if absent.

    Expressed as a tagged union + one grouped aggregation (partial, so hot
    keys are pre-combined in every task) instead of n-1 full outer joins.
    """
    tagged = None
    for name, df in sides.items():
        t = df.select(F.col(key), F.lit(name).alias("__side"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.groupBy(key).agg(*[
        F.sum(F.when(F.col("__side") == name, 1).otherwise(0)).cast("bigint").alias(f"{name}_cnt")
        for name in sides])


def cogroup_long(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Cogroup as long rows (key, side, value, n).

    A key's two value lists are the rows with side 'left' / 'right'; a key
    absent from one side simply has no rows for it.  Kept long because one
    hot key may hold a third of the table and must not become one array.
    """
    l = left.select(F.col(key), F.lit("left").alias("side"), F.col(value))
    r = right.select(F.col(key), F.lit("right").alias("side"), F.col(value))
    return l.unionByName(r).groupBy(key, "side", value).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- set operations

def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def subtract_all_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """RDD ``subtract``: remove every left row that occurs on the right;
    left duplicates that do not occur there stay.  Null-safe equality."""
    cond = None
    for c in a.columns:
        e = a[c].eqNullSafe(b[c])
        cond = e if cond is None else cond & e
    return a.join(b, cond, "left_anti")


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``EXCEPT`` (distinct rows of a not in b, nulls equal)."""
    return a.subtract(b)


def outer_join_split(kept: DataFrame, other: DataFrame, kept_key: str, other_key: str) -> DataFrame:
    """``kept LEFT JOIN other ON kept_key = other_key``, as an inner join and the rows of
    ``kept`` without a match.

    An outer join may not split a hot key on its optional side; the inner
    join may split either side, so a key that many rows of ``other`` share
    is spread over several tasks (AQE skew join).  The rows without a match
    meet the distinct keys of ``other``, made small in every task, instead of
    its rows, which a join on the key would sort."""
    keys = other.select(other_key).distinct()
    alone = kept.join(keys, kept[kept_key] == keys[other_key], "left_anti")
    return kept.join(other, kept[kept_key] == other[other_key]).unionByName(alone, allowMissingColumns=True)
