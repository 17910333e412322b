"""Sharding by rendezvous hashing of a stable record key over weighted shards.

Each shard draws ``-ln(u(key, shard)) / weight`` and the least draw wins, so a shard's
share follows its weight and adding a shard moves rows only into it.  All expressions
are built-in functions.  A null key is one key like any other; ties go to the smaller
shard number.  Columns of the input are kept; the new columns must not exist already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import counted, stored

SLOT_GROUPS = 256          # pieces of a shard that are numbered side by side


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to len(weights) - 1) that wins the key; weight 0 takes nothing."""
    if not any(w > 0 for w in weights):
        raise ValueError("one shard at least needs a weight above 0")
    mixed = F.xxhash64(key)

    def draw(shard: int, weight: float) -> Column:
        # the top 52 bits, centred, as a number strictly between 0 and 1
        u = (F.shiftrightunsigned(F.xxhash64(mixed, F.lit(shard)), 12).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(u) / weight).alias("draw"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[draw(s, float(w)) for s, w in enumerate(weights) if w > 0]))["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], column: str = "shard") -> DataFrame:
    """``df`` with the shard of its key column."""
    return df.withColumn(column, winner(F.col(key), weights))


def numbered(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float],
             carry: Sequence[str]) -> DataFrame:
    """Rows of (key, carry...) with shard, grown_shard and a gapless slot within the shard.

    Equal rows are counted first and expanded last, in parts of bounded size that are
    numbered apart, so a row that repeats very often is spread over its shard's pieces and
    its slots need not follow each other.  A shard is numbered in SLOT_GROUPS pieces by hash; the pieces' sizes
    (shards x SLOT_GROUPS rows) give each piece its first slot.
    """
    cols = [key, *carry]
    rows = stored(
        counted(df, *cols)
        .withColumn("shard", winner(F.col(key), weights))
        .withColumn("grown_shard", winner(F.col(key), grown))
        .withColumn("piece", F.pmod(F.xxhash64(F.lit(7), "part", *cols), F.lit(SLOT_GROUPS)).cast("int")), "shards")
    sizes = rows.groupBy("shard", "piece").agg(F.sum("copies").alias("n"))
    first = sizes.select("shard", "piece", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("first"))
    inside = Window.partitionBy("shard", "piece").orderBy(*cols, "part").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("until", F.sum("copies").over(inside))
              .join(F.broadcast(first), ["shard", "piece"])  # at most shards x SLOT_GROUPS rows
              .withColumn("from", F.col("first") + F.col("until") - F.col("copies")))
    return placed.select(*cols, "shard", "grown_shard", F.explode(
        F.sequence("from", F.col("first") + F.col("until") - 1)).alias("slot"))


def documents_by_key(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The table of record sizes and places of ``docs`` under the law ``key``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    out = numbered(sized, "doc_id", [1.0] * shards, [1.0] * (shards + 1), ["size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
                      F.col("slot").cast("long"), F.col("grown_shard").cast("int"))
