import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from pyspark.sql import functions as F

from tessera.llm import queries, rendezvous


def check(rows):
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    got = queries.QUERIES["op3_rendezvous_shards"](spark, SF).collect()
    check(got)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in text.items())


def test_odd_and_repeated_rows(spark):
    ids = [None, 1, 1, 2, None, 3, 4, 5, 6]
    docs = clashing(documents(spark, ODD_TEXTS, ids))
    docs = docs.union(docs).union(documents(spark, ["same"] * 300, [42] * 300).transform(clashing))
    got = rendezvous.documents_by_key(docs).collect()
    check(got)
    assert len(got) == 318 and Counter(r.doc_id for r in got)[42] == 300
    by_key = defaultdict(set)
    for r in got:
        by_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_key.values())


def test_shares_follow_weights_and_growth_moves_few(spark):
    n = 20_000
    df = spark.range(n)
    weights = [1.0, 2.0, 0.0, 1.0]
    two = df.select("id", rendezvous.winner(F.col("id"), weights).alias("a"),
                    rendezvous.winner(F.col("id"), [*weights, 1.0]).alias("b")).collect()
    share = Counter(r.a for r in two)
    assert share[2] == 0 and abs(share[1] / n - 0.5) < 0.02 and abs(share[0] / n - 0.25) < 0.02
    moved = [r for r in two if r.a != r.b]
    assert all(r.b == 4 for r in moved) and abs(len(moved) / n - 0.2) < 0.02


def test_no_positive_weight_is_refused():
    with pytest.raises(ValueError):
        rendezvous.winner(None, [0.0])


def test_plan_has_no_python(spark):
    df = queries.QUERIES["op3_rendezvous_shards"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert rendezvous.documents_by_key(spark.createDataFrame([], DOCS)).collect() == []


def test_row_that_repeats_very_often_is_expanded_in_parts(spark, monkeypatch):
    from tessera.llm import common
    monkeypatch.setattr(common, "SPAN", 7)
    docs = documents(spark, ["same"] * 1000 + ["x"] * 7 + ["y"] * 8 + ["z"], [42] * 1000 + [1] * 7 + [2] * 8 + [3])
    parts = common.counted(docs, "doc_id").collect()
    assert max(r.copies for r in parts) == 7 and len([r for r in parts if r.doc_id == 42]) == 143
    got = rendezvous.documents_by_key(docs).collect()
    check(got)
    assert Counter(r.doc_id for r in got) == {42: 1000, 1: 7, 2: 8, 3: 1}
