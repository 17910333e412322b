"""Exact integer k-means over a vector-approximation file.

Every vector is stored twice: whole, and as one few-bit cell number per dimension (cells
between approximate quantiles of the dimension; the outermost reach to its extremes).
A round looks at the cells alone.  Tables per dimension give, for each cell and centroid,
the least and the largest share of the squared distance, less the distance to a reference
point that all centroids share; their sums are each centroid's distance interval.  A vector
whose best interval lies below all others needs no more.  The whole vector is fetched, by a
join on its number, only where intervals overlap under the old or the new centroids, or
where the two rounds differ: the cluster sums are kept as exact integers, and only vectors
that may move change them.  The first sums and the last distances need every vector once.

Vectors that are null, of another length, or hold a null or non-finite component have no
row.  Repeated rows count as often as they stand.  A null vec_id is clustered, but starts a
centroid only if too few others exist.  With fewer than K vectors there are as many
centroids.  Components beyond SMALL after scaling have no cells; such vectors are always
fetched and computed in Python integers.  A distance or an inertia that exceeds a long is
null.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

DIM = 64
K = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
BITS = 8                   # bits of a cell number, 8 at most
EDGE = 0.002               # share of a dimension in each of its outermost cells
SMALL = 1 << 27            # scaled components up to this are computed in 64-bit integers
CHUNK = 1024               # vectors compared at a time
LIMB = 40                  # bits of a piece of a sum on its way through Spark

Centroids = list[list[int]]


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def whole(x: float) -> int:
    """floor(SCALE * x), exact for every finite double."""
    return math.floor(SCALE * x) if abs(x) < 2.0**53 else SCALE * int(x)


def split(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled integers of the rows (zero where one is too large) and the mask of the small rows."""
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * rows)
    small = (np.abs(scaled) <= SMALL).all(axis=1)
    return np.where(small[:, None], scaled, 0).astype(np.int64), small


def nearest(rows: np.ndarray, cents: Centroids) -> tuple[np.ndarray, list[int]]:
    """Nearest centroid (ties: the smaller number) and squared distance of each row, exactly."""
    ints, small = split(rows)
    if any(abs(x) > SMALL for c in cents for x in c):
        small[:] = False
    label, dist = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if small.any():
        c = np.array(cents, np.int64)
        for lo in range(0, len(rows), CHUNK):
            d = ((ints[lo: lo + CHUNK, None, :] - c[None]) ** 2).sum(axis=2)
            label[lo: lo + CHUNK] = d.argmin(axis=1)
            dist[lo: lo + CHUNK] = d.min(axis=1)
    out = dist.tolist()
    for k in np.flatnonzero(~small):
        v = [whole(x) for x in rows[k].tolist()]
        out[k], label[k] = min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    return label, out


class Sums:
    """Signed sums of vectors per cluster; dimension DIM counts them."""

    def __init__(self, k: int, dim: int):
        self.small, self.large = np.zeros((k, dim + 1), np.int64), defaultdict(int)

    def add(self, rows: np.ndarray, label: np.ndarray, sign: int = 1) -> None:
        ints, small = split(rows)
        for c in np.unique(label).tolist():
            of = label == c
            self.small[c, :-1] += sign * ints[of].sum(axis=0)  # too large ones are zero here
            self.small[c, -1] += sign * int(of.sum())
        for k in np.flatnonzero(~small):
            for d, x in enumerate(rows[k].tolist()):
                self.large[int(label[k]), d] += sign * whole(x)

    def batch(self) -> pa.RecordBatch:
        total = {(c, d): int(x) for (c, d), x in np.ndenumerate(self.small) if x}
        for at, x in self.large.items():
            total[at] = total.get(at, 0) + x
        out = [(c, d, limb, (abs(x) >> LIMB * limb & (1 << LIMB) - 1) * (1 if x > 0 else -1))
               for (c, d), x in total.items() for limb in range(-(-abs(x).bit_length() // LIMB))]
        columns = [list(x) for x in zip(*out)] or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "dim", "limb", "total"])


SUMS = "cluster int, dim int, limb int, total long"


def collected(parts: DataFrame, k: int, dim: int) -> np.ndarray:
    """The sums of all tasks as Python integers: at most k * (dim + 1) * 27 rows reach the driver."""
    out = np.zeros((k, dim + 1), object)
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t")).collect():
        out[r.cluster, r.dim] += int(r.t) << (LIMB * r.limb)
    return out


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> Centroids:
    """The k vectors of least SHA-256 of ``seed:vec_id``, in the order of the hash."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(name.alias("h"), "vec_id", "v").orderBy(F.asc_nulls_last("h"), "vec_id", "v").limit(k).collect()
    return [[whole(x) for x in r.v] for r in rows]


def cell_edges(vectors: DataFrame, bits: int = BITS) -> list[np.ndarray]:
    """Per dimension the first value of each cell, and one past the last cell's last value."""
    scaled = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE))
    small = vectors.where(F.forall("v", lambda x: F.abs(x.cast("double") * SCALE) <= SMALL))
    got = small.select(F.posexplode(scaled).alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("least"), F.max("x").alias("most"),
        F.percentile_approx("x", [EDGE, 1 - EDGE], 2000).alias("inner")).orderBy("d").collect()
    inner = [np.ceil(np.linspace(*r.inner, (1 << bits) - 1)).astype(np.int64) for r in got]
    return [np.unique(np.r_[r.least, x, r.most + 1]) for r, x in zip(got, inner)]


def cell_numbers(rows: np.ndarray, edges: Sequence[np.ndarray]) -> list[bytes]:
    """One byte per dimension; nothing for a vector too large for cells."""
    ints, small = split(rows)
    cells = np.stack([np.searchsorted(e, ints[:, d], side="right") - 1 for d, e in enumerate(edges)], axis=1) \
        if edges else np.zeros(ints.shape)
    packed = np.clip(cells, 0, 255).astype(np.uint8)
    return [packed[k].tobytes() if small[k] else b"" for k in range(len(rows))]


class Intervals:
    """Distance intervals of all centroids by lookup tables over the cells."""

    def __init__(self, edges: Sequence[np.ndarray], cents: Centroids):
        try:
            c = np.array(cents, float)
        except OverflowError:  # beyond a double: no interval is finite, every vector is fetched
            c = np.full((len(cents), len(edges)), np.nan)
        self.low, self.high, self.slack = [], [], 0.0
        for d, e in enumerate(edges):
            first, last = e[:-1, None].astype(float), e[1:, None].astype(float) - 1
            ref = (c[:, d].min() + c[:, d].max()) / 2
            # (x - c)^2 - (x - ref)^2 is linear in x: its extremes stand at the cell's ends
            ends = [(x - c[None, :, d]) ** 2 - (x - ref) ** 2 for x in (first, last)]
            self.low.append(np.minimum(*ends))
            self.high.append(np.maximum(*ends))
            # rounding of the squares, far above what doubles can lose
            self.slack += 1e-12 * float(np.max([(x - c[None, :, d]) ** 2 for x in (first, last)]))

    def decided(self, cells: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row of cell numbers, -1 where intervals overlap."""
        low = sum(t[cells[:, d]] for d, t in enumerate(self.low))
        high = sum(t[cells[:, d]] for d, t in enumerate(self.high))
        best = high.argmin(axis=1)
        row = np.arange(len(cells))
        most = high[row, best]
        low[row, best] = np.inf
        return np.where(most + self.slack < low.min(axis=1) - self.slack, best, -1)


def moves(vectors: DataFrame, cells: DataFrame, edges: list[np.ndarray], old: Centroids, new: Centroids
          ) -> tuple[DataFrame, DataFrame]:
    """(numbers of the vectors to fetch, changes of the cluster sums from ``old`` to ``new``)."""
    k, dim = len(old), len(old[0])

    def overlapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Intervals(edges, c) for c in (old, new)]
        for batch in batches:
            raw = batch.column(1).to_pylist()
            has = np.array([len(x) > 0 for x in raw], bool)
            fetch = ~has
            if has.any():
                some = np.frombuffer(b"".join(raw), np.uint8).reshape(int(has.sum()), dim)
                before, after = (t.decided(some) for t in tables)
                fetch[has] = (before < 0) | (after < 0) | (before != after)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fetch))], ["node"])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(k, dim)
        for batch in batches:
            rows = matrix(batch.column(0))
            if len(rows):
                (a, _), (b, _) = nearest(rows, old), nearest(rows, new)
                moved = a != b
                sums.add(rows[moved], a[moved], -1)
                sums.add(rows[moved], b[moved])
        yield sums.batch()

    wanted = cells.select("node", "cells").mapInArrow(overlapping, "node long")
    return wanted, vectors.select("node", "v").join(wanted, "node").select("v").mapInArrow(change, SUMS)


def trained(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, bits: int = BITS) -> Centroids:
    """The centroids after ``rounds`` rounds over the stored rows (node, vec_id, v)."""
    cents = first_centroids(vectors, k)
    if not cents:
        return cents
    edges, k, dim = cell_edges(vectors, bits), len(cents), len(cents[0])

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed = pa.array(cell_numbers(matrix(batch.column(1)), edges), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["node", "cells"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(k, dim)
        for batch in batches:
            rows = matrix(batch.column(0))
            if len(rows):
                sums.add(rows, nearest(rows, first)[0])
        yield sums.batch()

    cells = stored(vectors.select("node", "v").mapInArrow(approximate, "node long, cells binary"), "va-cells")
    first = cents
    sums = collected(vectors.select("v").mapInArrow(assign, SUMS), k, dim)
    for turn in range(1, rounds + 1):
        new = [[int(x) // int(s[-1]) for x in s[:-1]] if s[-1] else c for s, c in zip(sums, cents)]
        if new == cents or turn == rounds:  # a fixed point: further rounds change nothing
            return new
        sums = sums + collected(moves(vectors, cells, edges, cents, new)[1], k, dim)
        cents = new
    return cents


def numbered(embeddings: DataFrame, dim: int = DIM) -> DataFrame:
    """The vectors that take part, stored with a number each: node, vec_id, v."""
    kind = embeddings.schema["embedding"].dataType.elementType.simpleString()
    v = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    fits = (F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.coalesce(fits, F.lit(False)))
    return stored(rows.select(F.monotonically_increasing_id().alias("node"), "vec_id", "v"), "va-vectors")


def clustered(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, bits: int = BITS, dim: int = DIM) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = embeddings.sparkSession
    vectors = numbered(embeddings, dim)
    cents = trained(vectors, k, rounds, bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                label, dist = nearest(matrix(batch.column(1)), cents)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(label, pa.int32()),
                     pa.array([d if d < 1 << 63 else None for d in dist], pa.int64())], ["vec_id", "cluster", "distance"])

    placed = stored(vectors.select("vec_id", "v").mapInArrow(place, "vec_id long, cluster int, distance long"), "va-placed")
    names = spark.createDataFrame(
        [(n, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(cents)],
        "cluster int, centroid_sha256 string")

    def long_sum(column: str):
        total = F.when(F.count_if(F.col(column).isNull()) == 0, F.sum(F.col(column).cast("decimal(38,0)")))
        return total.cast("decimal(38,0)").try_cast("long")

    per = placed.groupBy("cluster").agg(long_sum("distance").alias("cluster_inertia"))
    all_ = per.agg(long_sum("cluster_inertia").alias("inertia"))
    about = per.crossJoin(F.broadcast(all_)).join(names, "cluster")  # one row beside k rows at most
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(table: str = "embeddings", k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> str:
    """DuckDB twin: plain k-means, one step per round, over (row, dimension, component)."""
    steps = [f"""
  kept AS MATERIALIZED (
    SELECT row_number() OVER () AS node, vec_id, embedding FROM {table}
    WHERE embedding IS NOT NULL AND len(embedding) = {dim}
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  x AS MATERIALIZED (
    SELECT node, unnest(range(1, {dim + 1})) AS d, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
    FROM kept),
  c0 AS MATERIALIZED (
    SELECT c, d, v FROM x JOIN (
      SELECT node, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, vec_id, embedding) - 1 AS c
      FROM kept) s USING (node) WHERE c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
  a{n} AS MATERIALIZED (
    SELECT node, min(e).c AS c, min(e).dist AS dist FROM (
      SELECT node, {{'dist': sum((x.v - c.v) * (x.v - c.v)), 'c': c.c}} AS e
      FROM x JOIN c{n} c USING (d) GROUP BY node, c.c) p GROUP BY node)""")
        if n < rounds:
            steps.append(f"""
  c{n + 1} AS MATERIALIZED (
    SELECT c, d, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN (
      SELECT c, d, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS v
      FROM a{n} JOIN x USING (node) GROUP BY c, d) m USING (c, d))""")
    return "WITH" + ",".join(steps) + f"""
  SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
         CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
         CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
  FROM a{rounds} JOIN kept USING (node) JOIN (
    SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
    FROM c{rounds} GROUP BY c) s USING (c)"""
