"""SimHash near-duplicates, compared bit-sliced.

A fingerprint bit is set if it is set in over half of the XXH64 (seed 42) hashes of the
text's word shingles.  Distinct fingerprints are grouped by pairs of their four 16-bit
bands: two of them that differ in at most 2 bits agree in two bands at least, so no link
is lost for radius 2 or less.  In a group, lanes are compared with their neighbours at
distance 1, 2, ...: the 64 bit planes are stored vertically, one XOR and a carry-save
counter update 64 distances at a time, and words whose lanes all exceed the radius leave
early.  Groups beyond GROUP_ROWS are split into a grid of cells, each compared in its
own; every cell sends on a forest of its links, never all pairs.

Null texts count as empty; empty texts have fingerprint zero and link to each other.
Rows with a null doc_id are fingerprinted and get their group's component, which is
null where the group has no doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, lean, star_edges, stored, text_bytes

SHINGLE = 3
RADIUS = 2
BANDS = 4
GROUP_ROWS = 4096          # fingerprints of one band group that one cell compares
CHUNK_ROWS = 1 << 18       # rows compared at a time
CHUNK_SHINGLES = 1 << 16


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text; bytes.lower and bytes.split know ASCII only, as wanted."""
    from xxhash import xxh64_digest
    words = raw.lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = [xxh64_digest(g, 42) for g in grams]
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), CHUNK_SHINGLES):
        part = np.frombuffer(b"".join(hashes[lo: lo + CHUNK_SHINGLES]), np.uint8)
        ones += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, column: str = "fp") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text`` as a last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = text_bytes(batch.column(batch.num_columns - 1))
            fps = np.array([fingerprint(t, shingle) for t in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], [*batch.schema.names[:-1], column])

    return docs.select("*", F.col("text").cast("string").alias(column)).mapInArrow(
        lean(run, -1), docs.select("*", F.lit(0).cast("long").alias(column)).schema)


# ------------------------------------------------------------------ bit-sliced comparison

def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit k of row b is bit b of fingerprint k. One word of zeros at the end."""
    words = len(fps) // 64 + 2
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_lanes(planes: np.ndarray, active: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Bits of the lanes k in ``active`` whose distance to lane k + shift is within the radius."""
    step, bit = divmod(shift, 64)
    at = np.flatnonzero(active[: planes.shape[1] - step - 1])
    over = ~active[at]
    counter = [np.zeros(len(at), np.uint64) for _ in range(int(radius + 1).bit_length())]
    limit = radius + 1
    for b in range(64):
        row = planes[b]
        other = row[at + step]
        if bit:
            other = (other >> np.uint64(bit)) | (row[at + step + 1] << np.uint64(64 - bit))
        carry = row[at] ^ other
        for k in range(len(counter)):  # carry-save: add one bit to 64 counters
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b % 8 == 7:
            reached = ~np.uint64(0)
            for k in range(len(counter)):  # counter >= limit, for the limit's set bits from the top
                reached = reached & counter[k] if limit >> k & 1 else reached | counter[k]
            over |= reached
            keep = np.flatnonzero(~over)
            if len(keep) < len(at):  # abandon the words where every lane exceeds the radius
                at, over, counter = at[keep], over[keep], [c[keep] for c in counter]
            if not len(at):
                break
    out = np.zeros(planes.shape[1], np.uint64)
    out[at] = ~over
    return out


def links_in_groups(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a spanning forest of the links inside the runs of equal ``group``."""
    pos = np.arange(len(fps))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held, shift, packed = 0, 1, 0
    while True:
        if shift > packed:  # keep the runs that still reach this far
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
            sizes = np.diff(np.r_[starts, len(group)])
            keep = np.repeat(sizes > shift, sizes)
            fps, group, pos = fps[keep], group[keep], pos[keep]
            if not len(fps):
                break
            planes, packed = planes_of(fps), 2 * shift
        same = np.zeros(planes.shape[1] * 64, np.uint8)
        same[: max(0, len(group) - shift)] = group[:-shift] == group[shift:]
        active = np.packbits(same, bitorder="little").view("<u8")
        if not active.any():
            shift = packed + 1
            continue
        near = np.flatnonzero(np.unpackbits(near_lanes(planes, active, shift, radius).view(np.uint8), bitorder="little"))
        if len(near):
            found.append((pos[near], pos[near + shift]))
            held += len(near)
            if held > 4_000_000:
                a, b = (np.concatenate(x) for x in zip(*found))
                found = [star_edges(np.arange(int(max(a.max(), b.max())) + 1), a, b)]
                held = len(found[0][0])
        shift += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found))
    return star_edges(np.arange(int(max(a.max(), b.max())) + 1), a, b)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) of a spanning forest of the fingerprints in ``distinct(fp)`` that lie within the radius."""
    if not 0 <= radius <= BANDS - 2:
        raise ValueError(f"pairs of {BANDS} bands find all links up to {BANDS - 2} bits only")
    band = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(BANDS)]
    keys = [F.struct(F.lit(t).cast("long").alias("t"), (F.shiftleft(band[i], 16).bitwiseOR(band[j])).alias("key"))
            for t, (i, j) in enumerate(combinations(range(BANDS), 2))]
    spread = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select(
        "fp", F.shiftleft(F.col("k.t"), 32).bitwiseOR(F.col("k.key")).alias("key"))
    large = spread.groupBy("key").count().where(F.col("count") > GROUP_ROWS).select(
        "key", F.ceil(F.col("count") / GROUP_ROWS).cast("int").alias("n"))
    cells = spread.join(large, "key", "left").withColumn(
        "own", F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")))
    # cell (i, j), i <= j, of a split group holds its pieces i and j
    cells = cells.select("fp", "key", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.least("own", o) * F.col("n") + F.greatest("own", o)))
    ).alias("cell"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.table({"fp": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "cell": pa.array([], pa.int32())})

        def run(t: pa.Table) -> pa.RecordBatch:
            fps = t["fp"].to_numpy()
            key, cell = t["key"].to_numpy(), t["cell"].to_numpy()
            new = np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])] if len(key) else np.zeros(0, bool)
            a, b = links_in_groups(fps.view(np.uint64), np.cumsum(new), radius)
            return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], ["a", "b"])

        held = none
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(none.schema)])
            if held.num_rows >= CHUNK_ROWS:
                key, cell = held["key"].to_numpy(), held["cell"].to_numpy()
                cut = int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])[-1])
                if cut:  # the last group may go on in the next batch
                    yield run(held.slice(0, cut))
                    held = held.slice(cut)
        yield run(held)

    return (cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
            .mapInArrow(lean(compare), "a long, b long"))


def classes(printed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root): the least fingerprint of the component, for linked fingerprints only."""
    distinct = stored(printed.select("fp").distinct(), "fingerprints")
    return components(links(distinct, radius), "simhash").select(F.col("node").alias("fp"), "root")


def linked(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    printed = stored(fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), shingle)
                     .select("doc_id", "fp"), "printed")
    groups = classes(printed, radius)
    least = (printed.groupBy("fp").agg(F.min("doc_id").alias("low")).join(groups, "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "low"))
    named = least.join(least.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id")
    return printed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the one of least doc_id (a null id only if there is no other).

    Documents are pre-aggregated before the shuffle, so copies leave in the first task
    that sees two of them.
    """
    mark = "__simhash_fp"
    printed = stored(fingerprints(docs, shingle, mark), "printed")
    groups = classes(printed.select(F.col(mark).alias("fp")), radius)
    keyed = printed.join(groups.withColumnRenamed("fp", mark).withColumnRenamed("root", "__simhash_root"), mark, "left")
    kept = keyed.groupBy(F.coalesce("__simhash_root", mark).alias("__group")).agg(F.min_by(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]),
        F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"))).alias("__doc"))
    return kept.select("__doc.*")
