import math

import numpy as np
import pytest
from helpers import SF

from tessera.llm import queries, topk


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in good if i % every == 0}):
        best = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in good if i != q and len(v) == len(a))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("scale", [0.2, 900.0, 200_000.0])
def test_equal_to_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=9) * scale / 4).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(80)]          # ties
    assert sorted(map(tuple, topk.top_k(table(spark, rows)).collect())) == brute(rows)


@pytest.mark.parametrize("large", [3e5, 2.0**40, -3e12, 1e300, -1.5e308])
def test_large_vectors_are_scored_exactly(spark, monkeypatch, large):
    monkeypatch.setattr(topk, "BLOCK", 60)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    rows += [(300, [large, 0.5, 0.0, -1.0]), (301, [0.25, large, 1.0, 0.0]), (302, [large] * 4), (350, [0.0] * 4)]
    whole = [(i, [math.floor(256 * x) if abs(x) < 2**40 else 256 * int(x) for x in v]) for i, v in rows]
    want = []
    for q, a in whole:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in whole if i != q)[:5]
            want += [(q, n + 1, i, -s if abs(s) < 2**63 else None) for n, (s, i) in enumerate(best)]
    got = sorted(map(tuple, topk.top_k(table(spark, rows)).collect()))
    assert got == sorted(want) and {i for _, _, i, _ in got} & {300, 301, 302}


def test_zeros_beside_large_components():
    block = np.array([[1.5e308, 1.0], [2.0, 3.0], [-1.5e308, 0.0]])
    got = list(topk.block_topk(np.array([50]), np.zeros((1, 2)), np.array([1, 2, 3]), block, 2))
    assert got == [(50, 1, 0), (50, 2, 0)]
    got = list(topk.block_topk(np.array([50]), block[:1], np.array([1, 2]), np.zeros((2, 2)), 2))
    assert got == [(50, 1, 0), (50, 2, 0)]


def test_sortable_keeps_the_order():
    some = sorted([0, 1, -1, 255, 256, -255, -256, 2**63, -2**63, 2**600, -2**600])
    assert sorted(some, key=topk.sortable) == some


def test_bounds_prove_candidates_out():
    rng = np.random.default_rng(3)
    block = np.floor(rng.normal(size=(2000, 4)) ** 3 * 50)
    queries_ = np.floor(rng.normal(size=(6, 4)) * 50)
    alive = topk.bounded_search(queries_, block, 5, np.zeros((6, 2000), bool))
    for q, left in zip(queries_, alive):
        score = block @ q
        bar = np.sort(score)[-5]
        assert set(np.flatnonzero(score >= bar)) <= set(left.tolist())
    assert sum(map(len, alive)) < 6 * 2000 / 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (None, [9.0, 9.0]), (6, [1.0]), (100, [1.0]), (150, []), (50, [1.0, 1.0])]
    assert sorted(map(tuple, topk.top_k(table(spark, rows)).collect())) == brute(rows)


def test_empty_table(spark):
    assert topk.top_k(table(spark, [])).collect() == []


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op6_no_random_access"](spark, SF).collect())) == brute(rows)
