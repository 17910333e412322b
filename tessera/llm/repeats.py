"""Suffix-array dedup: bytes covered by a 200-byte string that occurs more than once.

Whole texts never meet in one place.  Every 200-byte string holds 101 windows of 100
bytes, and the window of least hash (the leftmost of them) is its anchor; equal strings
have equal anchors.  Rows that are alike (doc_id and text) are one row with a number of
copies from the start; all its strings occur again.  Steps, all over the whole input:

1. anchors of every text; a shuffle by anchor hash finds those that occur twice
   (anchors a map task sees twice are counted there first, so a hot one costs a row);
2. for the anchors that occur again, the maximal stretch of text whose 200-byte strings
   share the anchor goes to the anchor's bucket (equal stretches of a task go once);
3. each bucket builds an enhanced suffix array (prefix doubling, LCP by the doubling
   ranks), scans it with a stack for the intervals of common prefixes of 200 bytes or
   more and keeps those whose occurrences differ in the byte to their left: the maximal
   repeats, each with all its occurrences;
4. their byte ranges go back to the texts, keyed by a 128-bit hash of the row.

Anchors with more than HOT occurrences would gather in one bucket; a join tells which they
are, and their 200-byte strings are instead counted by 128-bit hash, spread by that hash and
pre-aggregated per task.

Null texts count as empty.  Matches never cross rows; repeated rows count as two
occurrences.  Rows with a null doc_id take part like any other.  An empty table gives no
row.  Columns of the input are kept by ``cleaned`` and ignored by ``removals``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPAN as COPIES
from tessera.llm.common import lean, slices, stored, text_bytes

MATCH = 200
GRAM = 100                 # anchor window; every match holds MATCH - GRAM + 1 of them
PER_PARTITION = 4          # buckets that a shuffle partition solves one after the other
HOT = 4096                 # occurrences of an anchor from which its strings are counted by hash
SLICE_BYTES = 16 << 20     # text whose anchors are packed together
ARRAY_BYTES = 1 << 19      # text of one suffix array (whole anchor groups)

_TABLE = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` bytes in a row, by doubling."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level, width, at, out = _TABLE[raw], 1, 0, None
    while True:
        if size & width:
            part = level[at: at + n]
            out = part.copy() if out is None else out * _A + (part ^ (part >> np.uint64(29)))
            at += width
        if 2 * width > size:
            break
        right = level[width:]
        level = level[:-width] * _B + (right ^ (right >> np.uint64(31)))
        width *= 2
    out ^= out >> np.uint64(32)
    out *= _C
    return out ^ (out >> np.uint64(29))


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, last start, periodic) of each run of MATCH-byte strings with one
    least hash.  A run that holds its least hash more than once may repeat within itself."""
    hashes = gram_hashes(raw, GRAM)
    width, n = MATCH - GRAM + 1, len(raw) - MATCH + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    least, size = hashes, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[width - size: width - size + n])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    value = least[first]
    opening = (hashes[first[:, None] + np.arange(width - 1)] == value[:, None]).sum(axis=1)
    entering = np.add.reduceat(hashes[width - 1: width - 1 + n] == least, first, dtype=np.int64)
    return value, first, np.r_[first[1:], n] - 1, opening + entering > 1


# ------------------------------------------------------------------ enhanced suffix array

def suffix_ranks(data: np.ndarray, ends: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(length, rank of each position by that many symbols), doubling; a text's end sorts first."""
    n = len(data)
    left = ends - np.arange(n)  # symbols up to the end of the position's own text
    symbol = data.astype(np.uint64) + np.uint64(1)
    word = np.zeros(n, np.uint64)
    for k in range(7):  # seven symbols of nine bits
        word <<= np.uint64(9)
        m = max(0, n - k)
        word[:m] |= np.where(left[:m] > k, symbol[n - m:], 0)
    rank = np.unique(word, return_inverse=True)[1].astype(np.int32)
    del word, symbol
    levels, length = [(7, rank)], 7
    while length < left.max(initial=0):
        pair = rank.astype(np.int64) * (n + 2)
        keep = np.flatnonzero(left > length)
        pair[keep] += rank[keep + length] + 1
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int32)
        length *= 2
        levels.append((length, rank))
    return levels


def common_prefix(levels: list[tuple[int, np.ndarray]], data: np.ndarray, ends: np.ndarray,
                  i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and at j, within their own texts."""
    most = np.minimum(ends[i] - i, ends[j] - j)
    got = np.zeros(len(i), np.int64)
    for length, rank in reversed(levels):
        ok = np.flatnonzero(got < most)
        ok = ok[rank[i[ok] + got[ok]] == rank[j[ok] + got[ok]]]
        got[ok] += length
    for _ in range(7):
        ok = np.flatnonzero(got < most)
        ok = ok[data[i[ok] + got[ok]] == data[j[ok] + got[ok]]]
        got[ok] += 1
    return np.minimum(got, most)


class Repeats(NamedTuple):
    """Maximal repeats as intervals of a suffix array, which keeps nested groups in linear space:
    repeat k is ``length[k]`` bytes long and occurs at (text, start)[first[k]: last[k] + 1]."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def groups(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, text numbers, starts) of each repeat, with all its occurrences."""
        for n, lo, hi in zip(self.length.tolist(), self.first.tolist(), self.last.tolist()):
            yield n, self.text[lo: hi + 1], self.start[lo: hi + 1]

    def longest(self) -> np.ndarray:
        """The longest repeat that each suffix opens, 0 if none; repeats come inner before outer."""
        out = np.zeros(len(self.text), np.int64)
        free = list(range(len(self.text) + 1))       # the next suffix not set yet

        def unset(k: int) -> int:
            while free[k] != k:
                free[k] = free[free[k]]
                k = free[k]
            return k

        for n, lo, hi in zip(self.length.tolist(), self.first.tolist(), self.last.tolist()):
            k = unset(lo)
            while k <= hi:
                out[k] = n
                free[k] = k + 1
                k = unset(k + 1)
        return out


def maximal_repeats(texts: list[bytes], least: int = MATCH) -> Repeats:
    """Every maximal repeat of ``least`` bytes or more.

    Maximal: not all occurrences go on alike to the right (an interval of the common
    prefix tree) nor to the left.  A text's start differs from anything, and so does its end.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    stop = np.cumsum(sizes)
    ends, begins = stop[owner], (stop - sizes)[owner]
    spots = np.flatnonzero(ends - np.arange(len(data)) >= least)
    none = np.zeros(0, np.int64)
    if len(spots) < 2:
        return Repeats(none, none, none, none, none)
    levels = suffix_ranks(data, ends)
    spots = spots[np.argsort(levels[-1][1][spots], kind="stable")]
    lcp = common_prefix(levels, data, ends, spots[:-1], spots[1:])
    del levels
    # runs of neighbours that share ``least`` bytes; uniform to the left: no maximal repeat inside
    cut = np.flatnonzero(np.r_[True, lcp < least])
    before = np.where(spots > begins[spots], data[spots - 1].astype(np.int64), -1)
    low, high = np.minimum.reduceat(before, cut), np.maximum.reduceat(before, cut)
    size = np.diff(np.r_[cut, len(spots)])
    diverse = (size > 1) & ((low != high) | (low < 0))
    found: list[tuple[int, int, int]] = []
    for lo, n in zip(cut[diverse].tolist(), size[diverse].tolist()):
        inner = lcp[lo: lo + n - 1].tolist()
        left = before[lo: lo + n].tolist()
        # the stack holds (prefix length, left border, the common left byte, -1 if diverse)
        stack: list[list[int]] = []
        for k in range(n):
            here = inner[k] if k < n - 1 else 0
            start, byte = k, left[k]
            while stack and stack[-1][0] > here:
                length, start, own = stack.pop()
                byte = own if own == byte else -1
                if byte < 0:
                    found.append((length, lo + start, lo + k))
            if not here:
                break
            if stack and stack[-1][0] == here:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else -1
            else:
                stack.append([here, start, byte])
    length, first, last = np.array(found, np.int64).reshape(-1, 3).T
    return Repeats(owner[spots], spots - begins[spots], length, first, last)


# ------------------------------------------------------------------ the distributed steps

def _key(doc_id: int | None, raw: bytes) -> bytes:
    """A 128-bit key of the row; rows that are alike share it, and share every answer."""
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(raw, 0 if doc_id is None else (2 * doc_id + 1) & 0xFFFFFFFFFFFFFFFF)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))


PACKED = "bucket int, kind int, id binary, ref binary"
ONCE, KNOWN, COUNT = 0, 1, 2
ID = np.dtype([("a", "<u8"), ("b", "<u8")])             # 128-bit hash of a string or a row
REF = np.dtype([("a", "<u8"), ("b", "<u8"), ("start", "<i8")])


PACKET = 1 << 16           # occurrences of ids known to repeat that travel as one row


def _packed(ids: np.ndarray, refs: np.ndarray, buckets: int) -> list[tuple[int, int, bytes, bytes]]:
    """Occurrences (id, ref) of one slice, packed by bucket.

    ids seen once in the slice go to the id's bucket; those seen more often are known to
    repeat: one count goes to the id's bucket, their occurrences need not meet any others
    and travel in packets, in the order of the texts.
    """
    _, where, inverse, count = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    once = count[inverse] == 1
    lead = ids["a"] if ids.dtype == ID else ids
    out, many = [], where[count > 1]
    for kind, i, r, by in ((ONCE, ids[once], refs[once], lead[once]),
                           (COUNT, ids[many], count[count > 1].astype("<u8"), lead[many])):
        bucket = (by.astype(np.uint64) >> np.uint64(7)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(bucket[order][1:] != bucket[order][:-1]) + 1
        out += [(int(bucket[some[0]]), kind, i[some].tobytes(), r[some].tobytes())
                for some in np.split(order, cuts) if len(some)]
    ids, refs = ids[~once], refs[~once]
    return out + [((int(refs["a"][lo]) >> 7) % buckets, KNOWN, ids[lo: lo + PACKET].tobytes(), refs[lo: lo + PACKET].tobytes())
                  for lo in range(0, len(ids), PACKET)]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values())], list(kinds))


PACKED_KINDS = {"bucket": pa.int32(), "kind": pa.int32(), "id": pa.binary(), "ref": pa.binary()}


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each bucket together; the input is sorted by its first column."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        bucket = held.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:]):
            yield held.slice(lo, hi - lo)
        held = held.slice(cuts[-1])
    if held is not None:
        yield held


def _repeated(t: pa.Table, id_kind, ref_kind) -> tuple[np.ndarray, ...]:
    """Occurrences of a bucket's repeated ids: (ids, refs, totals) of those its own slice saw once, (ids, refs)
    of those known to repeat; then (id, total) of the ids that are counted here."""
    def part(kind: int, column: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(t[column].filter(pa.array(t["kind"].to_numpy() == kind)).to_pylist()), dtype)

    ids, refs = part(ONCE, "id", id_kind), part(ONCE, "ref", ref_kind)
    told, times = part(COUNT, "id", id_kind), part(COUNT, "ref", "<u8")
    value, inverse = np.unique(np.concatenate([ids, told]), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([np.ones(len(ids)), times.astype(float)]), len(value))
    all_of = total[inverse[: len(ids)]]
    again = all_of > 1
    return (ids[again], refs[again], all_of[again], part(KNOWN, "id", id_kind), part(KNOWN, "ref", ref_kind),
            value[total > 1], total[total > 1])


def _by_key(keys: np.ndarray, values: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(key, its values packed)."""
    order = np.lexsort((keys["b"], keys["a"]))
    keys, values = keys[order], values[order]
    cuts = np.flatnonzero((keys["a"][1:] != keys["a"][:-1]) | (keys["b"][1:] != keys["b"][:-1])) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    names = keys[["a", "b"]].astype(ID)
    return [(names[lo].tobytes(), values[lo:hi].tobytes()) for lo, hi in zip(edges, edges[1:]) if hi > lo]


def _rows(docs: DataFrame) -> DataFrame:
    """(key, text, doc) with the text compressed for the way."""
    import zstandard as zstd

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstd.ZstdCompressor(level=1)
        for batch in batches:
            raw = text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(i, t) for i, t in zip(batch.column(0).to_pylist(), raw)], pa.binary()),
                 pa.array([press.compress(t) for t in raw], pa.binary()), batch.column(0)], ["key", "text", "doc"])

    return _source(docs).mapInArrow(lean(run, 1), "key binary, text binary, doc long")


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc) of every row; the key as 32 hex digits, as in ``repeat_groups``."""
    return _keys(docs).select(F.lower(F.hex("key")).alias("key"), "doc")


def _keys(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(i, t) for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(0)], ["key", "doc"])

    return _source(docs).mapInArrow(lean(run, 1), "key binary, doc long")


def _distinct(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(key, text, doc, copies): one row for all that are alike; and whether any are.

    Only keys are counted; texts move only where rows are alike, and leave in the first
    task that sees two of them.
    """
    alike = stored(_keys(docs).groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "alike")
    rows = _rows(docs)
    if alike.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long")), False
    many = stored(rows.join(alike, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"), F.first("doc").alias("doc"))
                  .join(alike, "key"), "copied")
    return rows.join(alike, "key", "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(many), True


def _repeated_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, anchors, hot): of each row the anchors that occur again, packed, by bucket, where it is
    not known yet if they are hot with a null; and with a null key each hot anchor."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, copies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = list(_plain(batch.column(1)))
            for lo, hi in slices((len(t) for t in texts), SLICE_BYTES):
                found = []
                for t, n in zip(texts[lo:hi], copies[lo:hi]):
                    value, _, _, periodic = anchors(np.frombuffer(t, np.uint8))
                    found.append(np.concatenate([value, value if n > 1 else value[periodic]]))  # counts as a repeat
                refs = np.repeat(np.frombuffer(b"".join(keys[lo:hi]), ID), [len(f) for f in found])
                yield _batch(_packed(np.concatenate(found), refs, buckets), PACKED_KINDS)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"key": pa.binary(), "anchors": pa.binary(), "hot": pa.bool_()}
        for t in _buckets(batches):
            ids, keys, total, known, known_keys, value, count = _repeated(t, "<u8", ID)
            hot = total > HOT
            rows = [(k, v, False) for k, v in _by_key(keys[~hot], ids[~hot])]
            rows += [(k, v, True) for k, v in _by_key(keys[hot], ids[hot])]
            rows += [(k, v, None) for k, v in _by_key(known_keys, known)]
            rows += [(None, v.tobytes(), True) for v in value[count > HOT]]
            yield _batch(rows, kinds)

    return (rows.select("key", "text", "copies").mapInArrow(lean(ask, 1), PACKED)
            .repartition(buckets // PER_PARTITION, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(lean(answer), "key binary, anchors binary, hot boolean"))


def _found(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, text, copies, warm, hot) of the rows with anchors that occur again, by their kind."""
    again = stored(_repeated_anchors(rows, buckets), "anchors")
    hot = stored(again.where("key is null").select(F.col("anchors").alias("anchor")), "hot")
    told = again.where("key is not null")
    if hot.isEmpty():
        told = told.withColumn("hot", F.lit(False))
    else:
        one = told.where("hot is null").select("key", F.explode(F.expr(
            "transform(sequence(1, length(anchors), 8), i -> substring(anchors, i, 8))")).alias("anchor"))
        judged = one.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").select(
            "key", F.col("anchor").alias("anchors"), F.coalesce("hot", F.lit(False)).alias("hot"))
        told = told.where("hot is not null").union(judged)
    hits = told.groupBy("key").agg(F.collect_list(F.when(~F.col("hot"), F.col("anchors"))).alias("warm"),
                                   F.collect_list(F.when(F.col("hot"), F.col("anchors"))).alias("hot"))
    return rows.select("key", "text", "copies").join(hits, "key").select("key", "text", "copies", "warm", "hot")


STRETCHES = "bucket int, kind int, id binary, ref binary, sizes binary, body binary"
STRETCH = 3                # the kind of rows that hold stretches; the others hold hot strings
PLACE = np.dtype([("text", "<i8"), ("a", "<u8"), ("b", "<u8"), ("start", "<i8"), ("times", "<i8")])
SPAN = np.dtype([("start", "<i8"), ("stop", "<i8")])


def _plain(column) -> Iterator[bytes]:
    import zstandard as zstd
    unpress = zstd.ZstdDecompressor()
    return (unpress.decompress(t) for t in column.to_pylist())


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, bytes, bool, int, int, int]]:
    """(key, 1 or 2 for more copies, text, hot, anchor, first start, last start) of the batch's repeated anchors."""
    for key, raw, copies, warm, hot in zip(batch.column(0).to_pylist(), _plain(batch.column(1)),
                                           *(batch.column(n).to_pylist() for n in (2, 3, 4))):
        value, first, last, _ = anchors(np.frombuffer(raw, np.uint8))
        for flag, packs in ((False, warm), (True, hot)):
            ok = np.flatnonzero(np.isin(value, np.frombuffer(b"".join(packs), "<u8")))
            for v, lo, hi in zip(value[ok].tolist(), first[ok].tolist(), last[ok].tolist()):
                yield key, min(copies, 2), raw, flag, v, lo, hi


def _solved(found: DataFrame, buckets: int, groups: bool = False) -> DataFrame:
    """(key, spans) of the repeats; as ``groups`` a row (repeat, length, key, start) for each occurrence of each.

    Stretches of warm anchors meet in the anchor's bucket, hashes of hot strings in buckets of their own.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        kinds = {"bucket": pa.int32(), "kind": pa.int32()} | dict.fromkeys(("id", "ref", "sizes", "body"), pa.binary())

        def strings(ids: list[bytes], refs: list[tuple[bytes, int]]) -> pa.RecordBatch:
            places = np.zeros(len(refs), REF)
            keys = np.frombuffer(b"".join(k for k, _ in refs), ID)
            places["a"], places["b"], places["start"] = keys["a"], keys["b"], [p for _, p in refs]
            return _batch([(buckets + b, kind, i, r, None, None) for b, kind, i, r in
                           _packed(np.frombuffer(b"".join(ids), ID), places, buckets // PER_PARTITION)], kinds)

        ids, refs = [], []
        for batch in batches:
            at: dict[int, tuple[dict[bytes, int], list, list]] = {}
            for key, times, raw, hot, v, lo, hi in _cut(batch):
                if hot:
                    for p in range(lo, hi + 1):
                        ids += [xxh3_128_digest(raw[p: p + MATCH])] * times
                        refs += [(key, p)] * times
                    if len(ids) > 500_000:
                        yield strings(ids, refs)
                        ids, refs = [], []
                    continue
                known, values, places = at.setdefault((v >> 7) % buckets, ({}, [], []))
                text = raw[lo: hi + MATCH]
                number = known.setdefault(text, len(known))
                if number == len(values):
                    values.append(v)
                places.append((number, *np.frombuffer(key, "<u8").tolist(), lo, times))
            yield _batch([(b, STRETCH, np.array(values, "<u8").tobytes(), np.array(places, PLACE).tobytes(),
                           np.array([len(x) for x in known], "<i8").tobytes(), b"".join(known))
                          for b, (known, values, places) in at.items()], kinds)
        yield strings(ids, refs)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _buckets(batches):
            if t["kind"][0].as_py() != STRETCH:
                ids, refs, _, known, known_refs, _, _ = _repeated(t, ID, REF)
                ids, refs = np.concatenate([ids, known]), np.concatenate([refs, known_refs])
                yield from (_hot_occurrences if groups else _hot_ranges)(ids, refs)
            else:
                texts, values, places = _joined(t)
                yield from (_occurrences if groups else _ranges)(texts, values, places)

    return (found.mapInArrow(lean(send, 1), STRETCHES).repartition(buckets // PER_PARTITION, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(lean(solve), GROUPS if groups else "key binary, spans binary"))


def _joined(t: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct stretches of a bucket, their anchors, and the places where they stand."""
    known: dict[bytes, int] = {}
    values, places = [], []
    for row in t.to_pylist():
        stops = np.cumsum(np.frombuffer(row["sizes"], "<i8")).tolist()
        numbers = []
        for v, lo, hi in zip(np.frombuffer(row["id"], "<u8").tolist(), [0, *stops], stops):
            text = row["body"][lo:hi]
            numbers.append(known.setdefault(text, len(known)))
            if numbers[-1] == len(values):
                values.append(v)
        some = np.frombuffer(row["ref"], PLACE).copy()
        some["text"] = np.array(numbers, np.int64)[some["text"]]
        places.append(some)
    return list(known), np.array(values, np.uint64), np.concatenate(places)


SPAN_KINDS = {"key": pa.binary(), "spans": pa.binary()}


def _ranges(texts: list[bytes], values: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, spans): the ranges of each distinct stretch, moved to every place where it stands."""
    spans = _stretch_spans(texts, values, np.bincount(places["text"], places["times"], len(texts)) > 1)
    spans = spans[np.argsort(spans["text"], kind="stable")]
    lo, hi = (np.searchsorted(spans["text"], places["text"], side) for side in ("left", "right"))
    which = np.repeat(np.arange(len(places)), hi - lo)
    pick = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    out = np.zeros(len(which), SPAN)
    out["start"] = places["start"][which] + spans["start"][pick]
    out["stop"] = places["start"][which] + spans["stop"][pick]
    yield _batch(_by_key(places[which], out), SPAN_KINDS)


def _hot_ranges(ids: np.ndarray, refs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, spans): neighbouring repeated strings of a row become one range."""
    refs = refs[np.lexsort((refs["start"], refs["b"], refs["a"]))]
    same = (refs["a"][1:] == refs["a"][:-1]) & (refs["b"][1:] == refs["b"][:-1])
    new = np.flatnonzero(np.r_[True, ~same | (refs["start"][1:] > refs["start"][:-1] + MATCH)]) if len(refs) else np.zeros(0, int)
    out = np.zeros(len(new), SPAN)
    if len(new):
        out["start"] = refs["start"][new]
        out["stop"] = refs["start"][np.r_[new[1:], len(refs)] - 1] + MATCH
    yield _batch(_by_key(refs[new], out), SPAN_KINDS)


GROUPS = "repeat string, length long, key string, start long"
GROUP_ROWS = 1 << 16       # rows of a batch of occurrences, at most about


def _hex(keys: np.ndarray) -> pa.Array:
    raw = keys[["a", "b"]].astype(ID).tobytes().hex()
    return pa.array([raw[i: i + 32] for i in range(0, len(raw), 32)], pa.string())


def _hot_occurrences(ids: np.ndarray, refs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """GROUPS rows of the repeated strings of hot anchors, at every place."""
    first = np.unique(refs, return_index=True)[1]            # rows with copies sent each place twice
    for lo in range(0, len(first), GROUP_ROWS):
        some = first[lo: lo + GROUP_ROWS]
        yield pa.RecordBatch.from_arrays(
            [_hex(ids[some]), pa.array(np.full(len(some), MATCH, np.int64)), _hex(refs[some]), pa.array(refs["start"][some])],
            ["repeat", "length", "key", "start"])


def _occurrences(texts: list[bytes], values: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """GROUPS rows of the stretches' maximal repeats, at every place of a stretch."""
    from xxhash import xxh3_128_hexdigest

    often = np.bincount(places["text"], places["times"], len(texts))   # rows that are alike count each
    places = places[np.argsort(places["text"], kind="stable")]
    low = np.searchsorted(places["text"], np.arange(len(texts)))
    count = np.diff(np.r_[low, len(places)])
    order = np.argsort(values, kind="stable")
    runs = np.split(order, np.flatnonzero(values[order][1:] != values[order][:-1]) + 1)

    def rows(size: int, text: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        name = xxh3_128_hexdigest(texts[text[0]][start[0]: start[0] + size])
        for lo, hi in slices(count[text].tolist(), GROUP_ROWS):
            many, first = count[text[lo:hi]], low[text[lo:hi]]
            pick = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(pick)), pa.array(np.full(len(pick), size, np.int64)),
                 _hex(places[pick]), pa.array(places["start"][pick] + np.repeat(start[lo:hi], many))],
                ["repeat", "length", "key", "start"])

    for lo, hi in slices((sum(len(texts[i]) for i in r.tolist()) for r in runs if len(r)), ARRAY_BYTES):
        some = np.concatenate(runs[lo:hi])
        whole = set(some[often[some] > 1].tolist())      # stretches that stand twice
        for size, text, start in maximal_repeats([texts[i] for i in some.tolist()]).groups():
            text = some[text]
            whole -= {i for i, at in zip(text.tolist(), start.tolist()) if at == 0 and len(texts[i]) == size}
            yield from rows(size, text, start)
        for i in sorted(whole):                          # and nowhere else, inside another
            yield from rows(len(texts[i]), np.array([i]), np.zeros(1, np.int64))


TEXT_SPAN = np.dtype([("text", "<i8"), ("start", "<i8"), ("stop", "<i8")])


def _stretch_spans(texts: list[bytes], values: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Covered ranges of each stretch: all of one that occurs twice, else its maximal repeats."""
    whole = np.flatnonzero(repeated)
    out = [np.array([(i, 0, len(texts[i])) for i in whole.tolist()], TEXT_SPAN)]
    order = np.argsort(values, kind="stable")
    runs = np.split(order, np.flatnonzero(values[order][1:] != values[order][:-1]) + 1)
    # a stretch alone with its anchor and covered already has nothing to add
    runs = [r for r in runs if len(r) > 1 or (len(r) and not repeated[r[0]])]
    for lo, hi in slices((sum(len(texts[i]) for i in r.tolist()) for r in runs), ARRAY_BYTES):
        some = np.concatenate(runs[lo:hi])
        repeats = maximal_repeats([texts[i] for i in some.tolist()])
        longest = repeats.longest()
        opens = np.flatnonzero(longest)
        got = np.zeros(len(opens), TEXT_SPAN)
        got["text"], got["start"] = some[repeats.text[opens]], repeats.start[opens]
        got["stop"] = got["start"] + longest[opens]
        out.append(got)
    return np.concatenate(out)


def _bucket_number(docs: DataFrame) -> int:
    return PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def repeat_groups(docs: DataFrame) -> DataFrame:
    """(repeat, length, key, start): each maximal repeat among the stretches of an anchor, by the
    128-bit hash of its bytes, with all its occurrences; ``key`` is that of ``keyed`` rows.

    A repeat longer than a stretch comes as overlapping pieces, and the repeated strings of anchors
    with more than HOT occurrences as pieces of MATCH bytes; the union is exact.  Rows that are alike
    share a key: they count as occurrences each, but stand here once.
    """
    buckets = _bucket_number(docs)
    return _solved(_found(_distinct(docs)[0], buckets), buckets, groups=True)


def repeat_spans(rows: DataFrame) -> DataFrame:
    """(key, spans): of each of the ``_distinct`` rows with a repeat, the covered byte ranges, as packed parts."""
    buckets = _bucket_number(rows)
    return stored(_solved(_found(rows, buckets), buckets), "spans").groupBy("key").agg(F.collect_list("spans").alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint maximal ranges of the union."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans["start"], kind="stable")]
    reach = np.maximum.accumulate(spans["stop"])
    first = np.flatnonzero(np.r_[True, spans["start"][1:] > reach[:-1]])
    out = np.zeros(len(first), SPAN)
    out["start"], out["stop"] = spans["start"][first], reach[np.r_[first[1:], len(spans)] - 1]
    return out


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    stops = [0, *spans["stop"].tolist()]
    return b"".join(raw[a:b] for a, b in zip(stops, [*spans["start"].tolist(), len(raw)]))


def _spans(parts: list[bytes] | None) -> np.ndarray:
    return merged(np.frombuffer(b"".join(parts or []), SPAN))


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
                 "kept_sha256": pa.string(), "copies": pa.int64()}
        for batch in batches:
            rows = []
            for doc, raw, parts, copies in zip(batch.column(0).to_pylist(), _plain(batch.column(1)),
                                               *(batch.column(n).to_pylist() for n in (2, 3))):
                spans = _spans(parts)
                kept = _kept(raw, spans)
                rows.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), copies))
            yield _batch(rows, kinds)

    rows, alike = _distinct(docs)
    out = rows.join(repeat_spans(rows), "key", "left").select("doc", "text", "spans", "copies").mapInArrow(
        lean(run, 1), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long")
    if alike:  # every copy again, in parts that any task may expand
        part = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES).cast("long"))
        out = out.withColumn("part", F.explode(part)).repartition("doc_id", "kept_sha256", "part").withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES))))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _whole_characters(raw: bytes, spans: np.ndarray) -> np.ndarray:
    """The ranges shrunk to whole UTF-8 characters."""
    out = []
    for lo, hi in spans.tolist():
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        out.append((lo, hi))
    return np.array(out, SPAN)


def cleaned(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated ranges cut out of its text (whole characters only).

    A text that loses everything becomes empty and its row stays; a null text stays null.
    The column ``size``, where there is one, is set to the new number of characters.
    """
    source = docs.select("doc_id", F.col(text).alias("text"))
    mark = "__repeat_key"
    carried = docs.select("*", F.col("doc_id").cast("long").alias("__repeat_doc"),
                          F.col(text).cast("string").alias("__repeat_text"))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            raw = text_bytes(batch.column(n - 1))
            keys = pa.array([_key(i, t) for i, t in zip(batch.column(n - 2).to_pylist(), raw)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], keys], [*batch.schema.names[: n - 2], mark])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = batch.column(names.index(text))
            out = []
            for whole, raw, parts in zip(column.to_pylist(), text_bytes(column), batch.column(len(names) - 1).to_pylist()):
                out.append(_kept(raw, _whole_characters(raw, _spans(parts))).decode() if parts else whole)
            columns = list(batch.columns[:-1])
            columns[names.index(text)] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names[:-1])

    keyed = carried.mapInArrow(lean(tag, -1), docs.select("*", F.lit(b"").alias(mark)).schema)
    joined = keyed.join(repeat_spans(_distinct(source)[0]).withColumnRenamed("key", mark).withColumnRenamed("spans", "__repeat_spans"),
                        mark, "left").drop(mark).select(*docs.columns, "__repeat_spans")
    out = joined.mapInArrow(lean(cut, docs.columns.index(text)), docs.schema)
    if size in docs.columns:
        out = out.withColumn(size, F.char_length(text).cast(docs.schema[size].dataType))
    return out
