"""Exact top-k inner products by aggregation of sorted lists without random access.

Vectors become integers, floor(256 x).  Candidates are cut into blocks by a hash of their
id, queries too, and every query block meets every candidate block once.  In a block each
dimension is a list sorted by value; a query reads it from its high end where its own
component is positive, from the low end where it is negative.  The lists are read side by
side to growing depths.  For each candidate the known terms, plus the worst (best) value
that an unread list can still give, bound its score from below (above).  Candidates whose
upper bound is below the k-th best lower bound are out for good; reading stops when the
rest are few, and their scores are resolved exactly.  Only a block's k best per query
leave it, and the blocks' lists are merged by query.  Rows too large for the bounds (in
doubles) or for 64-bit sums are scored for themselves, the latter in Python integers.

Ties go to the smaller vec_id.  A vector that is null, or holds a null or non-finite
component, takes no part, nor does a null vec_id.  A score beyond a long ranks by its
exact value and is given as null.  Vectors
of different lengths are not compared.  A query never meets rows of its own vec_id.  A
repeated row counts once for each time it stands there.  An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
K = 5
EVERY = 50
BLOCK = 8192               # candidates of a block
QUERIES = 512              # queries of a block
BATCH = 64                 # queries that read side by side
WHOLE = 2.0**45            # doubles of this size or more are whole numbers, also 1/256 of them
FEW = 1 / 16               # share of the candidates that is resolved directly
DEPTHS = (0.25, 0.5, 0.75)


def cut(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v) of the vectors that take part, v being floor(scale x) / scale: exact in a double."""
    def down(x):
        x = x.cast("double")
        return F.when(F.abs(x) < WHOLE, F.floor(x * scale) / F.lit(float(scale))).when(F.abs(x) < float("inf"), x)

    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", down).alias("v"))
            .where("vec_id is not null and v is not null").where(F.forall("v", lambda x: x.isNotNull()))
            .select("vec_id", F.size("v").alias("dim"), "v"))


def python_integers(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """scale * v as Python integers of any size."""
    return np.array([int(x) * scale if abs(x) >= WHOLE else int(x * scale) for x in v.ravel().tolist()], object).reshape(v.shape)


def sortable(score: int) -> bytes:
    """Bytes in the order of the integers."""
    size = (score.bit_length() + 7) // 8
    raw = size.to_bytes(2, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + raw if score >= 0 else b"\0" + bytes(255 - x for x in raw)


def bounded_search(queries: np.ndarray, block: np.ndarray, k: int, skip: np.ndarray) -> list[np.ndarray]:
    """For each query the candidates that may be among its k best, all others proven out.

    ``skip`` marks (query, candidate) pairs that must not match.  Integers held in
    doubles: the caller sees to it that every sum stays below 2^53.
    """
    n, dim = block.shape
    order = np.argsort(block, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n)[:, None], (n, dim)), axis=0)
    up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    least, most = block[order[0], np.arange(dim)], block[order[-1], np.arange(dim)]
    worst = up * least + down * most          # the least each list can give
    alive = [np.flatnonzero(~skip[q]) for q in range(len(queries))]
    for share in DEPTHS:
        if all(len(a) <= max(4 * k, FEW * n) for a in alive):
            break
        depth = max(1, min(n - 1, int(n * share)))
        high, low = rank >= n - depth, rank < depth      # read from the high end, from the low end
        known = (block * high) @ up.T + (block * low) @ down.T
        lower = known + worst.sum(axis=1) - (high @ (up * least).T + low @ (down * most).T)
        front = up * block[order[n - depth], np.arange(dim)] + down * block[order[depth - 1], np.arange(dim)]
        upper = known + front.sum(axis=1) - (high @ (front * (up > 0)).T + low @ (front * (down < 0)).T)
        for q, some in enumerate(alive):
            if len(some) > k:
                bar = np.partition(lower[some, q], len(some) - k)[len(some) - k]
                alive[q] = some[upper[some, q] >= bar]   # an equal bound may still tie
    return alive


def block_topk(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int
               ) -> Iterator[tuple[int, int, int]]:
    """(query id, vec_id, score) of the block's k best for each query; vectors as in ``cut``."""
    dim = block.shape[1]
    with np.errstate(over="ignore"):                     # beyond doubles is large, too
        size, asked = (np.abs(x).max(axis=1, initial=0) * float(SCALE) for x in (block, queries))
    order = np.argsort(asked, kind="stable")             # large queries stay among themselves
    query_ids, queries, asked = query_ids[order], queries[order], asked[order]
    for lo in range(0, len(queries), BATCH):
        some, names = queries[lo: lo + BATCH], query_ids[lo: lo + BATCH]
        top = asked[lo: lo + BATCH].max()
        with np.errstate(over="ignore", invalid="ignore"):
            most = np.where(np.maximum(size, top) < 2.0**62, dim * top * size, np.inf)
        small, long = (most < 2.0**53) & (np.maximum(size, top) < 2.0**53), most < 2.0**62
        fit, middle, huge = np.flatnonzero(small), np.flatnonzero(long & ~small), np.flatnonzero(~long)
        skip = names[:, None] == ids[None, :]
        near = bounded_search(some * SCALE, block[fit] * SCALE, k, skip[:, fit]) if len(fit) else [fit] * len(some)
        whole, exact = (python_integers(some), python_integers(block[huge])) if len(huge) else (None, None)
        for q in range(len(some)):
            rows = np.concatenate([fit[near[q]], middle[~skip[q, middle]]])
            score = ((block[rows] * SCALE).astype(np.int64) @ (some[q] * SCALE).astype(np.int64)).tolist() if len(rows) else []
            left = np.flatnonzero(~skip[q, huge])
            if len(left):
                score += (exact[left] @ whole[q]).tolist()
            best = sorted(zip([-x for x in score], ids[np.concatenate([rows, huge[left]])].tolist()))[:k]
            for minus, i in best:
                yield int(names[q]), i, -minus


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score); queries are the rows whose vec_id is divisible by ``every``."""
    rows = cut(embeddings)
    n = rows.count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n // (every * QUERIES)))
    chosen = rows.where(F.col("vec_id") % every == 0).distinct()  # a repeated query asks once
    right = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    left = chosen.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = ["dim", "block", "part"]

    def matrix(t: pa.Table, dim: int) -> np.ndarray:
        return t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)

    def solve(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if queries.num_rows and candidates.num_rows:
            dim = queries["dim"][0].as_py()
            rows = list(block_topk(queries["vec_id"].to_numpy(), matrix(queries, dim),
                                   candidates["vec_id"].to_numpy(), matrix(candidates, dim), k))
        cols = list(zip(*rows)) or [(), (), ()]
        scores = [x if -2**63 <= x < 2**63 else None for x in cols[2]]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(scores, pa.int64()),
                         pa.array(map(sortable, cols[2]), pa.binary())], names=["query_id", "vec_id", "score", "place"])

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        solve, "query_id long, vec_id long, score long, place binary")
    best = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
