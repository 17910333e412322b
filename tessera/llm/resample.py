"""Target-distribution importance resampling by hashed n-gram weights.

Features are runs of 1 to N consecutive words, hashed to BUCKETS buckets by CRC-32; tasks
count their buckets in an array, and the counts of all documents and of all target texts
give each bucket an integer gain.  A document's weight is the floored mean of the gains of
its features (one array lookup each); its score adds Gumbel noise drawn from its doc_id.

Of the N documents long enough, the share with the highest scores is drawn.  A quantile
sketch of the scores proposes a bracket around the cutoff; the exact number of rows above
it and inside it says whether the cutoff lies there, else the bracket widens.  Only the
bracket's rows are sorted to find the last row drawn.  Drawn rows are numbered over a range
partitioning, so no task holds more than its range.

Null texts count as empty; a document without a feature has weight 0.  Ties go to the
smaller doc_id (null last), then to fewer features, the smaller weight and the row's number,
so that repeated rows are drawn one by one.  A null doc_id is hashed as an empty one.  Empty
tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, stored, text_bytes
from tessera.operators.layout import row_index

LONGEST = 2
BUCKETS = 10_000
SCALE = 1000
SEED = 7
LEAST_WORDS = 20
SHARE = 25                 # of a hundred documents that are long enough
ACCURACY = 10_000          # of the quantile sketch
BRACKET = 1 / 2000         # half width of the first bracket, as a share of the rows
PART = 1 << 16             # words of a text that are hashed at a time

#: ASCII letters and digits and all bytes of other characters make words; A-Z is lower-cased.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_list(raw: bytes) -> list[bytes]:
    return raw.translate(WORDS).split()


def buckets(words: list[bytes], longest: int = LONGEST, n: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of all features, in pieces."""
    for lo in range(0, len(words), PART):
        part = words[lo: lo + PART + longest - 1]
        own = min(PART, len(words) - lo)
        crc = list(map(crc32, part))
        yield np.array(crc[:own], np.int64) % n
        spaced = [b" " + w for w in part]
        for size in range(2, longest + 1):  # a run's CRC goes on from that of the run one shorter
            crc = list(map(crc32, spaced[size - 1:], crc))
            yield np.array(crc[:own], np.int64) % n


def counted(texts: DataFrame, longest: int = LONGEST, n: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows' ``text``: one row per bucket and task is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                for got in buckets(word_list(raw), longest, n):
                    total += np.bincount(got, minlength=n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(lean(count, 0), "bucket int, n long")
    out = np.zeros(n, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most n rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln of how much likelier a bucket is in the target), by smoothed shares."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    n = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, raw in zip(ids, text_bytes(batch.column(1))):
                words, features, total = word_list(raw), 0, 0
                for got in buckets(words, longest, n):
                    features += len(got)
                    total += int(gain[got].sum())
                weight = total // features if features else 0
                out.append((len(words), features, weight, weight + noise(doc_id, seed)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(weigh, 1), "doc_id long, n_words long, n_features long, weight long, score long")


ORDER = ["doc_id", "n_features", "weight", "node"]


def order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("node")]


def bracket(rows: DataFrame, k: int, n: int, half: float = BRACKET) -> tuple[int, int, int]:
    """(low, high, rows above high) such that the score of the k-th best row is in [low, high]."""
    while True:
        at = 1 - k / n
        ends = F.percentile_approx("score", [max(0.0, at - half), min(1.0, at + half)], ACCURACY)
        low, high = rows.agg(ends.alias("ends")).first().ends
        if half >= 1:  # the sketch's extremes need not be the exact ones
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        count = rows.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("to")).first()
        if count.above < k <= count.to:
            return low, high, count.above
        half *= 8


def drawn(rows: DataFrame, k: int, n: int, half: float = BRACKET) -> Column:
    """Condition that holds for the k best of the n stored ``rows``."""
    if k >= n:
        return F.lit(True)
    if k == 0:
        return F.lit(False)
    low, high, above = bracket(rows, k, n, half)
    inside = row_index(rows.where(F.col("score").between(low, high)).select("score", *ORDER), order(), "place")
    last = inside.where(F.col("place") == k - above - 1).first()
    # row by row: better score, or the same score and not behind the last row drawn
    upto = F.col("node") <= last.node
    for name in ("weight", "n_features"):
        upto = (F.col(name) < last[name]) | ((F.col(name) == last[name]) & upto)
    if last.doc_id is None:
        upto = F.col("doc_id").isNotNull() | (F.col("doc_id").isNull() & upto)
    else:
        upto = F.coalesce((F.col("doc_id") < last.doc_id) | ((F.col("doc_id") == last.doc_id) & upto), F.lit(False))
    return (F.col("score") > last.score) | ((F.col("score") == last.score) & upto)


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
              longest: int = LONGEST, n_buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn."""
    gain = gains(counted(docs, longest, n_buckets), counted(target, longest, n_buckets))
    rows = stored(weighed(docs, gain, longest, seed).withColumn("node", F.monotonically_increasing_id()), "resample")
    pool = rows.where(F.col("n_words") >= least_words)
    n = pool.count()
    take = (F.col("n_words") >= least_words) & drawn(pool, share * n // 100, n)
    ranked = row_index(rows.where(take).select("score", *ORDER), order(), "place")
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, (F.col("place") + 1).cast("long").alias("rank")).union(
        rows.where(~take).select(*out, F.lit(None).cast("long").alias("rank")))
