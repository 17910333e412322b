import zlib

import numpy as np
from helpers import DOCS, ODD_TEXTS, clashing, documents
from pyspark.sql import functions as F

from tessera.llm import quality, queries

MID = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_ranking_and_fold(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op4_quality"](spark, MID).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    good = np.array([got[i].score for i, q in labels.items() if q == 1 and got[i].held_out])
    bad = np.array([got[i].score for i, q in labels.items() if q == 0 and got[i].held_out])
    assert (good[:, None] > bad[None, :]).mean() > 0.95 and (good >= 0.3).mean() > 0.97
    assert len(got) == spark.read.parquet(f"{MID}/documents.parquet").count()


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(docs, labels), quality.fit(docs, turned))


def test_odd_rows_keep_their_columns(spark):
    docs = clashing(documents(spark, ODD_TEXTS + ["good words here", "junk junk junk"], [1, 2, None, 4, 4, 5, 6, 7, 8, 9, 10]))
    labels = spark.createDataFrame([(9, 1, 0), (10, 0, 0), (9, 1, 0), (None, 1, 0), (4, None, None), (99, 1, 1)], LABELS)
    got = quality.scored(docs, labels).collect()
    assert len(got) == 11 and [r.held_out for r in got if r.doc_id is None] == [True]
    kept = quality.keep_good(docs, labels, 0.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_no_labels_and_no_documents(spark):
    docs, none = documents(spark, ["a b", None]), spark.createDataFrame([], LABELS)
    assert [(r.score, r.predicted) for r in quality.scored(docs, none).collect()] == [(0.5, 1)] * 2
    assert quality.scored(spark.createDataFrame([], DOCS), none).collect() == []


def test_updates_separate_two_words():
    model = quality.FollowTheLeader((1 << quality.BITS) + 1)
    for _ in range(40):
        model.learn(*quality.features("clean text"), 1.0)
        model.learn(*quality.features("junk junk"), 0.0)
    w = model.weights()
    score = {t: quality.sigmoid(float(w[i] @ v)) for t in ("clean text", "junk junk") for i, v in [quality.features(t)]}
    assert score["clean text"] > 0.8 and score["junk junk"] < 0.2


def test_several_texts_of_a_doc_id_are_learned_alike_in_every_partitioning(spark):
    docs = documents(spark, [f"w{n % 50} v{n} u{n * 7 % 13}" for n in range(400)], [n % 100 for n in range(400)])
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(100)], LABELS)
    one, *more = [quality.fit(docs.repartition(k), labels) for k in (1, 3, 8)]
    assert one.any() and all(np.array_equal(one, w) for w in more)


def test_query_against_plain_updates(spark):
    """The query's scores, by an independent dictionary-based run of the same updates."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    order = sorted(i for i in labels if i in docs and labels[i] is not None and zlib.crc32(str(i).encode()) % 5)
    vectors = {i: dict(zip(*(a.tolist() for a in quality.features(t)))) for i, t in docs.items()}
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= quality.L1:
            return 0.0
        sign = 1.0 if z[k] > 0 else -1.0
        return (sign * quality.L1 - z[k]) / ((quality.BETA + n[k] ** 0.5) / quality.ALPHA + quality.L2)

    def chance(x):
        return 1 / (1 + np.exp(-sum(weight(k) * v for k, v in x.items())))
    for turn in range(quality.PASSES):
        for at in np.random.default_rng(turn).permutation(len(order)):
            x = vectors[order[at]]
            error = chance(x) - labels[order[at]]
            for k, w, v in [(k, weight(k), v) for k, v in x.items()]:
                g = error * v
                z[k] = z.get(k, 0.0) + g - ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / quality.ALPHA * w
                n[k] = n.get(k, 0.0) + g * g
    got = queries.QUERIES["op4_quality"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs) and all(abs(r.score - chance(vectors[r.doc_id])) < 1e-6 for r in got)
