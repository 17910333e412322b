"""URL filters: a sort-merge range join of pages with host and path rules.

A host is turned round, ``www.example.org`` becoming ``org.example.www.``, so a rule's
host and all its subdomains are one interval of keys: those that start with the rule's
key.  Pages are cut into ranges of the sorted keys (a key that many pages share is cut
too, by a hash of the page); a rule goes to every range its interval meets.  Each range
is swept in key order with a stack of the rules' hosts that hold the current key; the
innermost host with a rule whose path the page's path starts with decides, and there the
longest path.  Equal rules: block wins.  Equal pages are counted first and expanded last, in
parts of bounded size.

Rules without a host or a verdict are ignored; a null path is empty.  A null url, or one
without "://", has an empty host and path and no rule.  Pages without a rule get
``default``.  Null page_ids are kept; repeated rows get one row each; an empty table
gives no row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import counted, stored

DEFAULT = "allow"
SAMPLE_PER_RANGE = 32      # keys looked at per range, for the cuts only
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOP = "\U0010ffff"        # sorts after any character of a host


def _host_key(host) -> F.Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def split_url(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of each page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select("page_id", F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER).alias("host"),
                        F.regexp_extract(url, parts, 2).alias("path"))


class Sweep:
    """The stack of nested rule hosts that hold the current key."""

    def __init__(self):
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def _leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, rule: str, verdict: str) -> None:
        self._leave(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        paths, lengths = self.stack[-1][1:]
        if path not in paths or verdict == "block":
            paths[path] = (rule, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self._leave(key)
        for _, paths, lengths in reversed(self.stack):
            for n in lengths:
                if n <= len(path) and (hit := paths.get(path[:n])):
                    return hit
        return None


SWEPT = "reach int, key string, kind int, page_id long, host string, path string, rule string, verdict string"


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; ``rules(host, path, verdict)``."""
    spark = pages.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = stored(counted(split_url(pages).select(F.col("page_id").cast("long").alias("page_id"), "host", "path"),
                            "page_id", "host", "path").select(
        # the tie after the host's key cuts a host that many pages share
        F.concat(_host_key(F.col("host")), F.lit("\u0001"), F.hex(F.xxhash64("page_id", "path", "part"))).alias("key"),
        "page_id", "host", "path", "copies"), "points")
    # a sample of about SAMPLE_PER_RANGE keys per range, by a threshold on a hash of the (distinct) keys
    share = min(1.0, ranges * SAMPLE_PER_RANGE / max(1, points.count()))
    chosen = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = sorted(r.key for r in points.where(chosen).select("key").collect())
    cuts = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reach = [bisect_right(cuts, k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(reach, pa.int32()), *batch.columns], ["reach", *batch.schema.names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = [bisect_right(cuts, k) for k in batch.column(0).to_pylist()]
            hi = [bisect_left(cuts, k + _TOP) for k in batch.column(0).to_pylist()]
            row = [i for i, (a, b) in enumerate(zip(lo, hi)) for _ in range(a, b + 1)]
            reach = [r for a, b in zip(lo, hi) for r in range(a, b + 1)]
            some = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(reach, pa.int32()), *some.columns], ["reach", *batch.schema.names])

    host = F.translate(F.col("host"), _UPPER, _LOWER)
    opened = (rules.where("host is not null and host <> '' and verdict is not null")
              .select(_host_key(host).alias("key"), host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
              .select("key", "path", F.concat("host", "path").alias("rule"), "verdict"))
    rule_rows = opened.mapInArrow(spread, "reach int, key string, path string, rule string, verdict string").select(
        "reach", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"),
        F.lit(None).cast("string").alias("host"), "path", "rule", "verdict", F.lit(0).cast("long").alias("copies"))
    page_rows = points.mapInArrow(place, "reach int, key string, page_id long, host string, path string, copies long").select(
        "reach", "key", F.lit(1).alias("kind"), "page_id", "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), "copies")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, Sweep()
        for batch in batches:
            out = []
            for reach, key, kind, page_id, host, path, rule, verdict, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if reach != at:
                    at, state = reach, Sweep()
                if kind == 0:
                    state.open(key, path, rule, verdict)
                else:
                    out.append((page_id, host, path, *(state.judge(key, path) or (None, default)), copies))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:5]),
                                              pa.array(cols[5], pa.int64())],
                                             ["page_id", "host", "path", "rule", "verdict", "copies"])

    swept = (rule_rows.union(page_rows).repartitionById(ranges, F.col("reach")).sortWithinPartitions("reach", "key", "kind")
             .mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string, copies long"))
    # equal pages stand again as often as they came, at most SPAN of them at a place
    return swept.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("__copy", "copies")
