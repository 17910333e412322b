"""Embedding near-duplicates by small-world graphs, one per shard, each asked by all vectors.

Equal vectors form one class first.  The classes are dealt to shards by a hash; a task
builds the shard's graph, audits it and writes it to the shared folder, a row for each node.
The audit asks a
sample of all classes for their NEAREST nearest nodes, whatever their distance, and for their
links, and compares both with exact products; the match of a query with itself is left out.
Link recall is the mean over the queries, taken apart for those with fewer than SPARSE links
in the shard and for the others.  While a recall is too low the beam is widened, WIDENINGS
times at most; a shard that fails then uses exact products.  Blocks of classes then query
every shard with its beam, some hundred at a time, and each slice of queries is reduced to
counts at once, and some slices to a forest.  Candidates count only if their cosine, in
doubles, is ``least`` or more.  Links leave a cell as counts and as a spanning forest, and the
components are joined over the shared folder.

A task holds one shard's vectors, as they came and in single precision, and its links.  All
else streams through it in sorted batches: a cell is its graph's rows, then its queries'.

A vector that is null, empty, zero, or holds a null or non-finite component has no link
and is its own component, as is one with a null vec_id (whose component is null).
Vectors of different lengths never link.  Repeated rows link to each other like copies;
rows of one vec_id with different vectors are rows like any other.
An empty table gives no row.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tessera.llm.common import components, lean, star_edges, stored
from tessera.llm.hnsw import BATCH, LINKS, UPPER_LINKS, Graph, layers, rows_held

LOG = logging.getLogger(__name__)
LEAST = 0.9
SHARDS = 8                 # shards at least of a table of up to SMALL_NUMBERS components
SMALL_NUMBERS = 1 << 19
FEWER_SHARDS = 4           # of a larger one: every vector asks each shard, at a cost that grows little with the shard
SHARD_NUMBERS = 8 << 20    # components of the vectors of one shard, at most about
BLOCK = 8192               # queries of a block; in large tables up to LARGE_BLOCK, since each block gets a copy of every graph
LARGE_BLOCK = 16 * BLOCK
CELLS = 6                  # cells (a block that asks a shard) a core, from which on blocks grow
BEAM = 64
POOL_NUMBERS = 2 << 20     # components of the sample of queries that audits a shard, at most about
AUDITED = 512              # queries of an audit that are asked for their nearest nodes
NEAREST, NEAREST_RECALL = 10, 0.85
LEAST_LINKS = 1000         # links of a kind that an audit compares, if the sample has them
SPARSE = BEAM // 2         # links from which on a query's beam is doubled
RECALL = 0.995             # of links; one lost link alone does not fail an audit
WIDENINGS = 2
SLICE, FIRST_SLICE = 512, 64  # queries whose links a task holds at a time, fewer where there are many
PAIRS = 1 << 20            # links that a task holds at a time, at most about
HELD_NUMBERS = 1 << 18     # components held in doubles at a time
MARGIN = 1e-4              # single precision: candidates this far below are verified too


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that squares stay finite."""
    return scaled(rows, *scales(rows))


def scales(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each row is divided by, in turn, to be of length 1."""
    largest = np.abs(rows).max(axis=1, keepdims=True).astype(float)
    rows = rows / largest
    return largest, np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def scaled(rows: np.ndarray, largest: np.ndarray, length: np.ndarray) -> np.ndarray:
    return rows / largest / length


def parts(n: int, dim: int) -> list[slice]:
    """Ranges of n rows with about HELD_NUMBERS components each."""
    step = max(1, HELD_NUMBERS // max(1, dim))
    return [slice(lo, lo + step) for lo in range(0, n, step)]


class Rows:
    """Vectors as they came, with what makes them unit vectors, in doubles or single precision."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.single = raw, np.empty(raw.shape, np.float32)
        self.largest, self.length = np.empty((len(raw), 1)), np.empty((len(raw), 1))
        for some in parts(*raw.shape):
            self.largest[some], self.length[some] = scales(raw[some])
            self.single[some] = scaled(raw[some], self.largest[some], self.length[some])

    def double(self, which: np.ndarray) -> np.ndarray:
        return scaled(self.raw[which], self.largest[which], self.length[which])


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in ``keys`` (whole numbers or booleans), each inside one batch."""
    for batch in batches:
        if batch.num_rows:
            values = [batch.column(k).cast(pa.int32()).to_numpy() for k in keys]
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in values], axis=0)) + 1
            for lo, hi in zip(np.r_[0, new].tolist(), np.r_[new, batch.num_rows].tolist()):
                yield tuple(int(x[lo]) for x in values), batch.slice(lo, hi - lo)


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _graph_rows(key: tuple, own: list[tuple], pool: list[tuple], least: float) -> Iterator[pa.RecordBatch]:
    """The shard's graph, a row a node, with the beam of its audit by the ``pool`` of queries."""
    nodes, copies, raw = (np.concatenate(x) for x in zip(*own))
    own.clear()
    graph = Graph.build(Rows(raw).single)
    names, asked = np.zeros(0, np.int64), graph.vectors[:0]
    if pool:
        names, _, asked = (np.concatenate(x) for x in zip(*pool))
        pool.clear()
        asked = Rows(asked).single
    beam = audited_beam(graph, asked, least, names, nodes)
    upper = np.zeros(len(nodes), np.int64)
    for links in graph.links[1:]:
        upper[: len(links)] += 1
    for lo in range(0, len(nodes), BATCH * 8):
        hi = min(len(nodes), lo + BATCH * 8)
        # the upper layers' lists of each node, from the lowest layer up
        above = np.full((hi - lo, len(graph.links) - 1, UPPER_LINKS), -1, np.int32)
        for l, links in enumerate(graph.links[1:]):
            some = links[lo:hi]
            above[: len(some), l] = some
        above = above[np.arange(len(graph.links) - 1) < upper[lo:hi, None]].ravel()

        def lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat))

        same = np.ones(hi - lo, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(same * key[0], pa.int32()), pa.array(same * key[1], pa.int32()), pa.array(np.arange(lo, hi), pa.int32()),
            pa.array(same * len(nodes), pa.int32()), pa.array(same * beam, pa.int32()), pa.array(nodes[lo:hi]),
            pa.array(copies[lo:hi]), lists(raw[lo:hi].ravel(), same * raw.shape[1]),
            lists(graph.links[0][lo:hi].ravel(), same * LINKS), lists(above, upper[lo:hi] * UPPER_LINKS)],
            ["dim", "shard", "place", "total", "beam", "node", "copies", "v", "links", "upper"])


class Shard:
    """A shard's graph, put together from its rows in the order of their places."""

    def __init__(self, total: int, beam: int):
        self.beam, self.sizes, self.at = beam, layers(total), 0
        self.nodes, self.copies, self.raw = np.empty(total, np.int64), np.empty(total, np.int64), None
        self.links = [np.empty((n, UPPER_LINKS if l else LINKS), np.int32) for l, n in enumerate(self.sizes)]
        self.graph = None

    def add(self, batch: pa.RecordBatch) -> None:
        lo, hi = self.at, self.at + batch.num_rows
        raw = _matrix(batch.column("v"), hi - lo)
        if self.raw is None:
            self.raw = np.empty((len(self.nodes), raw.shape[1]), raw.dtype)
        self.raw[lo:hi] = raw
        self.nodes[lo:hi], self.copies[lo:hi] = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        self.links[0][lo:hi] = _matrix(batch.column("links"), hi - lo)
        above = batch.column("upper").flatten().to_numpy().reshape(-1, UPPER_LINKS)
        layers_of = np.zeros(hi - lo, np.int64)
        for n in self.sizes[1:]:
            layers_of[: max(0, n - lo)] += 1
        first = np.cumsum(layers_of) - layers_of
        for l, n in enumerate(self.sizes[1:]):
            some = max(0, min(n, hi) - lo)
            self.links[l + 1][lo: lo + some] = above[first[:some] + l]
        self.at = hi

    def ready(self) -> Graph:
        if self.graph is None:
            self.rows = Rows(self.raw)
            self.graph = Graph(self.rows.single, self.links)
        return self.graph


#: A row for each node; the type of vectors is that of the table.
GRAPH = ("dim int, shard int, place int, total int, beam int, node long, copies long, v {}, links array<int>, upper array<int>")


def audit_sample(graph: Graph, queries: np.ndarray, least: float, own: np.ndarray, nodes: np.ndarray
                 ) -> list[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of links of sparse queries and of the others, LEAST_LINKS each if there are so many."""
    seen, kept = [0, 0], [([np.zeros(0, int)], [np.zeros(0, int)]), ([np.zeros(0, int)], [np.zeros(0, int)])]
    for lo in range(0, len(queries), BATCH):
        upto, dense = min(lo + BATCH, len(queries)), seen[1] < LEAST_LINKS
        for at in range(lo, upto, rows_held(len(nodes))):
            q, node = graph.exact(queries, np.arange(at, min(at + rows_held(len(nodes)), upto)), least)
            other = own[q] != nodes[node]
            q, node = q[other], node[other]
            sparse = np.bincount(q, minlength=len(queries))[q] < SPARSE
            for kind, some in enumerate((sparse, ~sparse)):
                if not kind or dense and seen[kind] < PAIRS:  # a cluster's links are many, some will do
                    kept[kind][0].append(q[some])
                    kept[kind][1].append(node[some])
                    seen[kind] += int(some.sum())
        if seen[0] >= LEAST_LINKS and (not seen[1] or seen[1] >= LEAST_LINKS):
            break
    return [(np.concatenate(a), np.concatenate(b)) for a, b in kept]


def query_recall(q: np.ndarray, node: np.ndarray, found: np.ndarray, n: int) -> float:
    """Mean over the queries of the share of their links (q, node) that is among ``found``, numbers q * n + node."""
    if not len(q):
        return 1.0
    _, row = np.unique(q, return_inverse=True)
    return float((np.bincount(row, np.isin(q * n + node, found)) / np.bincount(row)).mean())


def nearest_recall(graph: Graph, queries: np.ndarray, own: np.ndarray, nodes: np.ndarray, beam: int) -> float:
    """Share of the queries' NEAREST nearest other nodes that a beam holds."""
    got = graph.beam(queries, graph.descend(queries), 0, beam)[0]
    hits = total = 0
    step = rows_held(len(nodes))
    for lo in range(0, len(queries), step):
        sim = queries[lo: lo + step] @ graph.vectors.T
        sim[own[lo: lo + step, None] == nodes[None, :]] = -3
        few = min(NEAREST, sim.shape[1] - 1)
        for row, sims in enumerate(sim):
            # ties at the edge: any node as near as the last one counts
            edge = np.partition(sims, -few)[-few]
            held = got[lo + row]
            hits += min(few, int((sims[held[held >= 0]] >= edge).sum()))
            total += few
    return hits / total if total else 1.0


def audited_beam(graph: Graph, queries: np.ndarray, least: float, own: np.ndarray, nodes: np.ndarray) -> int:
    """The least beam whose recall passes, 0 for exact products; ``own`` and ``nodes`` name queries and nodes."""
    n = len(graph.vectors)
    if BEAM * 4 >= n or not len(queries):
        return 0
    truth = audit_sample(graph, queries, least, own, nodes)
    some = np.unique(np.concatenate([q for q, _ in truth]))
    for beam in (BEAM << k for k in range(WIDENINGS + 1)):
        if nearest_recall(graph, queries[:AUDITED], own[:AUDITED], nodes, beam) < NEAREST_RECALL:
            continue
        q, node = graph.near(queries[some], least, beam) if len(some) else (some, some)
        found = some[q] * n + node
        if all(query_recall(q, node, found, n) >= RECALL or (~np.isin(q * n + node, found)).sum() <= 1 for q, node in truth):
            return beam
    return 0


def audited_links(graph: Graph, queries: np.ndarray, least: float, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs at ``least`` or more by the beam of an audit, here of these queries if none is given."""
    if beam is None:
        beam = audited_beam(graph, queries, least, np.full(len(queries), -1), np.arange(len(graph.vectors)))
    return graph.near(queries, least, beam) if beam else graph.exact(queries, np.arange(len(queries)), least)


def linked(embeddings: DataFrame, least: float = LEAST) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    # single precision stays so, at half the bytes; what is computed from it is computed in doubles
    kept = "float" if isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType) else "double"
    finite = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) < float("inf"), x.cast(kept)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), finite.alias("v")).withColumn(
        "good", F.coalesce(F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull())
                           & F.exists("v", lambda x: x != 0), F.lit(False)))
    # a class of equal vectors has a 128-bit name, so that copies travel without their vector
    wide = F.col("v").cast("array<double>")
    rows = rows.select("vec_id", "good", "v", F.xxhash64(wide).alias("h1"), F.xxhash64(F.lit(9), F.reverse(wide)).alias("h2"))
    members = rows.select("vec_id", "good", "h1", "h2")
    classes = stored(rows.where("good").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
        .select("h1", "h2", "rep", "n", F.size("v").alias("dim"), "v",
                F.monotonically_increasing_id().alias("node")), "vector-classes")  # a number, fixed by being stored
    size = classes.agg(F.count("*").alias("rows"), F.sum("dim").alias("numbers")).first()
    numbers = size["numbers"] or 0
    shards = max(SHARDS if numbers <= SMALL_NUMBERS else min(SHARDS, FEWER_SHARDS), -(-numbers // SHARD_NUMBERS))
    cores = embeddings.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, min(-(-size["rows"] // BLOCK), max(-(-size["rows"] // LARGE_BLOCK), -(-CELLS * cores // shards))))
    named = classes.withColumn("deal", F.xxhash64("h1", "h2", F.lit(3))).withColumn(
        "shard", F.pmod("deal", F.lit(shards)).cast("int"))
    cell = ["dim", "shard", "block"]
    # the audit's sample: the classes whose number by a hash is below their share
    share = int(2**20 * min(1.0, POOL_NUMBERS / max(1, numbers)))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    pool = named.where(F.pmod(F.xxhash64("h1", "h2", F.lit(5)), F.lit(2**20)) < share).select("dim", "deal", "node", "n", "v").withColumn("shard", every)
    vectors = dict(classes.dtypes)["v"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own, pool = None, [], []
        for (*key, asks), batch in runs(batches, ["dim", "shard", "asks"]):
            if key != held and own:
                yield from _graph_rows(held, own, pool, least - MARGIN)
            if key != held:
                held, own, pool = key, [], []
            # copies of what is kept, so that the batch can go
            (pool if asks else own).append((batch.column("node").to_numpy().copy(), batch.column("n").to_numpy().copy(),
                                            _matrix(batch.column("v"), batch.num_rows).copy()))
        if own:
            yield from _graph_rows(held, own, pool, least - MARGIN)

    columns = ["dim", "shard", "asks", "deal", "node", "n", "v"]
    graphs = stored(named.withColumn("asks", F.lit(False)).select(columns).union(pool.withColumn("asks", F.lit(True)).select(columns))
                    .repartitionById(shards, F.pmod(F.col("dim") + F.col("shard"), F.lit(shards))).sortWithinPartitions("dim", "shard", "asks", "deal", "node")
                    .mapInArrow(lean(build), GRAPH.format(vectors)), "graphs")
    by_graph = graphs.where("place = 0").agg(F.count("*").alias("all"), F.count_if(F.col("beam") > 0).alias("graph")).first()
    LOG.info("%d of %d shards are searched by their graph", by_graph.graph, by_graph["all"])
    asked = named.select(
        "dim", "shard", F.pmod(F.xxhash64("h1", "h2", F.lit(4)), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"),
        "node", "v").withColumn("shard", every)
    cells = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(False))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int32()), pa.array(a), pa.array(b)], ["kind", "a", "b"])

        def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            return star_edges(ids, *np.split(place, 2))

        def done(links: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if links:
                a, b = forest(*(np.concatenate(x) for x in zip(*links)))
                for lo in range(0, len(a), PAIRS):
                    yield table(1, a[lo: lo + PAIRS], b[lo: lo + PAIRS])

        held, shard, links, size, step = None, None, [], 0, FIRST_SLICE
        for (*key, asks), batch in runs(batches, [*cell, "asks"]):
            if key != held:
                yield from done(links)
                held, shard, links, size, step = key, None, [], 0, FIRST_SLICE
                graph = queries = None           # before the next one is put together
            if not asks:
                if shard is None:
                    shard = Shard(batch.column("total")[0].as_py(), batch.column("beam")[0].as_py())
                shard.add(batch)
            elif shard is not None:
                graph, own = shard.ready(), batch.column("node").to_numpy()
                queries, count = Rows(_matrix(batch.column("v"), len(own))), np.zeros(len(own), np.int64)
                lo = 0
                while lo < len(own):
                    q, node = audited_links(graph, queries.single[lo: lo + step], least - MARGIN, shard.beam)
                    q, lo = q + lo, lo + step
                    step = max(1, min(SLICE, 2 * step, step * PAIRS // max(1, len(q))))
                    true = np.concatenate([np.einsum("ij,ij->i", queries.double(q[some]), shard.rows.double(node[some])) >= least
                                           for some in parts(len(q), queries.raw.shape[1])] or [np.zeros(0, bool)])
                    true &= own[q] != shard.nodes[node]
                    q, node = q[true], node[true]
                    if len(q):
                        np.add.at(count, q, shard.copies[node])
                        links.append((own[q], shard.nodes[node]))
                        size += len(q)
                        if size > PAIRS:         # a forest of the links so far
                            links = [forest(*(np.concatenate(x) for x in zip(*links)))]
                            size = 0
                some = np.flatnonzero(count)
                yield table(0, own[some], count[some])
        yield from done(links)

    rows = [*cell, "asks", "place", "total", "beam", "node", "copies", "v", "links", "upper"]
    found = stored(cells.select(rows).unionByName(asked, allowMissingColumns=True)
                   .repartitionById(shards * blocks, F.pmod(F.col("dim") + F.col("shard") * blocks + F.col("block"), F.lit(shards * blocks))).sortWithinPartitions(*cell, "asks", "place", "node")
                   .mapInArrow(lean(ask), "kind int, a long, b long"), "cells")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    groups = components(found.where("kind = 1").select("a", "b"), "embedding")
    # classes are linked by number, since one vec_id may stand with several vectors; a component's name comes last
    known = (classes.select("h1", "h2", "rep", "n", "node").join(counts, "node", "left").join(groups, "node", "left")
             .select("h1", "h2", "rep", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"),
                     F.coalesce("root", "node").alias("root"), F.lit(True).alias("good")))
    known = known.join(known.groupBy("root").agg(F.min("rep").alias("component")), "root").drop("root", "rep")
    return members.join(known, ["h1", "h2", "good"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
