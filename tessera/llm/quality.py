"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal updates.

Words are runs of word characters or of other marks.  Features are hashed unigrams and
bigrams, and one shared feature for a word that follows itself; a text's vector holds
their counts, scaled to length 1.  Scoring is a sparse dot product and a sigmoid.

The model is fitted on at most MAX_TRAINING labelled documents, chosen by a hash of
doc_id among the labelled ones outside the held-out fold.  Labels that are null are
left out; a doc_id with several labels takes their mean, 1 from 0.5 on, and one with
several texts is learned by the text of least hash.  With no usable
label every weight is 0 and every score 0.5.  Null and empty texts have no feature and
get the bias's score.  Rows with a null doc_id are scored and count as held out.  The
input's other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, stored

BITS = 18
MAX_TRAINING = 6000        # documented bound of the training sample
FOLDS = 5
THRESHOLD = 0.3
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
WORD = re.compile(r"\w+|[^\w\s]+")
SAME = np.uint64(0x5BD1E995)


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values; number ``1 << bits`` is the bias."""
    words = np.array([zlib.crc32(w.encode()) for w in WORD.findall(text or "")], np.uint64)
    left, right = words[:-1], words[1:]
    pairs = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))
    grams = np.concatenate([words * np.uint64(0xD6E8FEB86659FD93), pairs,
                            np.full(int((left == right).sum()), SAME) * np.uint64(0xD6E8FEB86659FD93)])
    ids, counts = np.unique(grams >> np.uint64(64 - bits), return_counts=True)
    values = counts / max(1.0, float(np.sqrt((counts.astype(float) ** 2).sum())))
    return np.append(ids, 1 << bits).astype(np.int64), np.append(values, 1.0)


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-x)) if x >= 0 else np.exp(x) / (1.0 + np.exp(x))


class FollowTheLeader:
    """Per-coordinate FTRL-proximal state."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, ids=slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, ids: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(ids)
        g = (sigmoid(float(w @ values)) - label) * values
        n = self.n[ids]
        self.z[ids] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[ids] = n + g * g


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, bound: int = MAX_TRAINING) -> np.ndarray:
    """Weights (2^bits and the bias) learned outside the held-out fold.

    The sample's sparse features, bounded by ``bound`` documents, meet in one task,
    which runs the sequential updates; only the weights reach the driver.
    """
    usable = (labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("mean"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    chosen = usable.select("doc_id", F.when(F.col("mean") >= 0.5, 1.0).otherwise(0.0).alias("label"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t, bits) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([i.astype("<i4").tobytes() for i, _ in got], pa.binary()),
                 pa.array([v.astype("<f8").tobytes() for _, v in got], pa.binary())], ["doc_id", "label", "ids", "vals"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        model = FollowTheLeader((1 << bits) + 1)
        for turn in range(PASSES):
            for k in np.random.default_rng(turn).permutation(len(rows)):
                r = rows[k]
                model.learn(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["vals"], "<f8"), r["label"])
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], ["weights"])

    # repeated documents: one row each, the same in every partitioning, so the sample keeps its bound
    one = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
           .join(F.broadcast(chosen), "doc_id")  # at most ``bound`` rows
           .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")))
    sample = stored(one.select("doc_id", "label", "least.text")
                    .mapInArrow(lean(extract, 2), "doc_id long, label double, ids binary, vals binary"), "quality-sample")
    sample = sample.repartition(1).sortWithinPartitions("doc_id")
    got = sample.mapInArrow(lean(train), "weights binary").collect()
    return np.frombuffer(got[0].weights) if got else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, column: str = "score") -> DataFrame:
    """``docs`` with the probability that its ``text`` is good, as a last column."""
    bits = (len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits doubles

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            out = [sigmoid(float(w[i] @ v)) for i, v in (features(t, bits) for t in texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())],
                                             [*batch.schema.names[:-1], column])

    inputs = docs.select("*", F.col("text").cast("string").alias(column))
    return inputs.mapInArrow(lean(dot, -1), docs.select("*", F.lit(0.0).alias(column)).schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    weights = fit(docs, labels)
    return score(docs.select("doc_id", "text"), weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    mark = "__quality_score"
    return score(docs, fit(docs, labels), mark).where(F.col(mark) >= threshold).drop(mark)
