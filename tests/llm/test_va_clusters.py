import hashlib
import math

import numpy as np
import pytest
from helpers import SF

from tessera.llm import queries, va_clusters as va


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, node long, cluster int")


def scaled(x):
    return math.floor(1024 * x) if abs(x) < 2**53 else 1024 * int(x)


def brute(rows, k=8, rounds=10, dim=64):
    """Plain k-means in Python integers: (vec_id, cluster, distance, cluster inertia, inertia, sha)."""
    kept = [(i, [scaled(x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for n in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, of) if o == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    per = {n: sum(d for _, c, d in got if c == n) for n in range(len(cents))}
    total = sum(per.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]

    def fit(x):
        return x if x < 2**63 else None
    return [(i, c, fit(d), fit(per[c]), fit(total), sha[c]) for i, c, d in got]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert order(queries.QUERIES["op12_va_clusters"](spark, SF).collect()) == order(brute(rows))


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_any_cell_width_gives_the_same_clusters(spark, bits):
    rng = np.random.default_rng(bits)
    at = rng.normal(size=(12, 6))
    rows = [(i, np.float32(at[i % 12] + rng.normal(size=6) * 0.05).tolist()) for i in range(600)]
    rows += [(7, rows[7][1])] * 200                     # a vector that a quarter of the rows hold
    want = brute(rows, 5, 10, 6)
    assert order(va.clustered(table(spark, rows), 5, 10, bits, 6).collect()) == order(want)


def test_clear_clusters_fetch_few_vectors(spark):
    rng = np.random.default_rng(4)
    at = rng.normal(size=(4, 16)) * 3
    rows = [(i, (at[i % 4] + rng.normal(size=16) * 0.1).tolist()) for i in range(2000)]
    vectors = va.numbered(table(spark, rows), 16)
    old = [[scaled(x) for x in c] for c in at]
    new = [[x + 3 for x in c] for c in old]
    edges = va.cell_edges(vectors)
    cells = vectors.select("node", "v").toPandas()
    packed = spark.createDataFrame([(int(n), bytearray(c)) for n, c in zip(
        cells.node, va.cell_numbers(np.array(cells.v.tolist()), edges))], "node long, cells binary")
    wanted, _ = va.moves(vectors, packed, edges, old, new)
    assert wanted.count() < 20


def test_intervals_hold_the_distance():
    rng = np.random.default_rng(1)
    rows = rng.integers(-900, 900, size=(400, 5))
    edges = [np.unique(np.r_[rows[:, d].min(), np.linspace(-500, 500, 9).astype(int), rows[:, d].max() + 1]) for d in range(5)]
    cents = rng.integers(-900, 900, size=(6, 5)).tolist()
    t = va.Intervals(edges, cents)
    cells = np.stack([np.searchsorted(e, rows[:, d], side="right") - 1 for d, e in enumerate(edges)], axis=1)
    got = t.decided(cells)
    true = ((rows[:, None] - np.array(cents)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (got >= 0).any() and (got[got >= 0] == true[got >= 0]).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [0.0, None, 1.0]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]),
            (7, [0.1, 0.2, 0.3]), (None, [0.5, 0.5, 0.5]), (7, [0.1, 0.2, 0.3]), (8, [-0.1, 0.2, 4.0]), (7, [9.0, 9.0, 9.0])]
    assert order(va.clustered(table(spark, rows, "double"), 8, 10, 8, 3).collect()) == order(brute(rows, 8, 10, 3))
    assert va.clustered(table(spark, []), 8).collect() == []
    assert va.clustered(table(spark, rows[:6], "double"), 8, 10, 8, 3).collect() == []


@pytest.mark.parametrize("large", [1e6, 3e12, -1e300, 1.7e308])
def test_large_components_are_exact(spark, large):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    rows += [(300, [large, 0.5, 0.0, -1.0]), (301, [0.25, large, 1.0, 0.0]), (302, [large] * 4), (303, [large] * 4)]
    assert order(va.clustered(table(spark, rows, "double"), 3, 6, 8, 4).collect()) == order(brute(rows, 3, 6, 4))
