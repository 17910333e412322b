import numpy as np
import pytest
from helpers import SF

from tessera.llm import embed_dups, hnsw, queries
from tessera.llm.common import local_components


def brute(vectors, least=0.9):
    unit = np.array(vectors, float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= least
    a, b = np.nonzero(near)
    return near.sum(axis=1) - 1, local_components(len(unit), a, b)


def clustered(n, groups, dim=24, noise=0.03, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    for g in range(groups):
        some = rng.choice(n, size=rng.integers(2, n // 6), replace=False)
        base[some] = base[some[0]] + noise * rng.normal(size=(len(some), dim))
    return base.astype(np.float32)


def table(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("seed", [0, 1])
def test_links_and_components_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(embed_dups, "BLOCK", 100)
    x = clustered(400, 5, seed=seed)
    x[7] = x[3]
    got = sorted(embed_dups.linked(table(spark, range(400), x)).collect())
    degree, label = brute(x)
    assert [r.n_links for r in got] == degree.tolist()
    assert [r.component_id for r in got] == label.tolist()
    assert [r.kept for r in got] == [i == c for i, c in enumerate(label)]


def test_graph_search_finds_links_without_exact_products(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[1500:] = x[:1500] + 0.05 * rng.normal(size=(1500, 32)).astype(np.float32)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(3000)]
    graph = hnsw.Graph.build(x)
    truth = set(zip(*(v.tolist() for v in graph.exact(x, np.arange(3000), 0.9))))
    monkeypatch.setattr(graph, "exact", None)
    got = set(zip(*(v.tolist() for v in graph.near(x, 0.9, 32))))
    assert len(got & truth) >= 0.99 * len(truth) and got <= truth


def test_audit_widens_the_beam():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lame = hnsw.Graph(x, [np.full((600, 4), -1, np.int32)])  # no links at all: only exact products help
    got = set(zip(*(v.tolist() for v in embed_dups.audited_links(lame, x, 0.9))))
    assert got == set(zip(*(v.tolist() for v in lame.exact(x, np.arange(600), 0.9))))


def cluster_and_pairs(cluster, pairs, dim=32, seed=5):
    """Unit vectors in random order: a hot cluster and scattered pairs; and which ones are of pairs."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(cluster + 2 * pairs, dim))
    x[:cluster] = x[0] + 0.05 * rng.normal(size=(cluster, dim))
    x[cluster + pairs:] = x[cluster: cluster + pairs] + 0.05 * rng.normal(size=(pairs, dim))
    order = rng.permutation(len(x))
    return (x / np.linalg.norm(x, axis=1, keepdims=True))[order].astype(np.float32), order >= cluster


def test_audit_sees_lost_pairs_beside_a_hot_cluster():
    x, paired = cluster_and_pairs(800, 600)
    n = len(x)
    hot = np.flatnonzero(~paired)
    links = np.full((n, 32), -1, np.int32)       # a ring of the cluster, no way to any pair
    for i, u in enumerate(hot):
        links[u] = hot[(i + 1 + np.arange(32)) % len(hot)]
    links[0] = hot[:32]
    lame = hnsw.Graph(x, [links])
    q, node = lame.near(x, 0.9, 128)
    truth = set(zip(*(v.tolist() for v in lame.exact(x, np.arange(n), 0.9))))
    assert 0.995 * len(truth) <= len(set(zip(q.tolist(), node.tolist())) & truth) < len(truth)  # pooled, all looks well
    assert set(zip(*(v.tolist() for v in embed_dups.audited_links(lame, x, 0.9)))) == truth
    names = np.arange(n)
    assert embed_dups.audit_sample(lame, x, 0.9, names, names) is not None
    assert embed_dups.audited_beam(lame, x, 0.9, names, names) == 0
    assert embed_dups.audited_beam(hnsw.Graph.build(x), x, 0.9, names, names) > 0


def test_audit_leaves_out_self_matches():
    x, _ = cluster_and_pairs(2, 30)
    singles = np.random.default_rng(6).normal(size=(2000, 32)).astype(np.float32)
    x = np.concatenate([x, singles / np.linalg.norm(singles, axis=1, keepdims=True)])
    graph, names = hnsw.Graph.build(x), np.arange(len(x))
    assert sum(len(q) for q, _ in embed_dups.audit_sample(graph, x, 0.9, names, names)) == 62
    blind = hnsw.Graph(x, [np.full((len(x), 4), -1, np.int32)])
    blind.beam = lambda queries, entry, layer, wide: (np.tile(names[: len(queries), None], (1, wide)), None)  # finds itself only
    assert embed_dups.nearest_recall(blind, x[:500], names[:500], names, 64) == 0


def test_few_or_no_links_keep_the_graph_in_use(spark, caplog):
    """The audit judges by the nearest nodes, which every shard has."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 16)).astype(np.float32)
    x[3000:3200] = x[:200] + 0.03 * rng.normal(size=(200, 16)).astype(np.float32)
    with caplog.at_level("INFO", logger="tessera.llm.embed_dups"):
        got = {r.vec_id: r.n_links for r in embed_dups.linked(table(spark, range(6000), x)).collect()}
    assert "8 of 8 shards are searched by their graph" in caplog.text
    truth, _ = brute(x)
    assert all(got[i] <= truth[i] for i in got) and sum(got.values()) >= 0.99 * truth.sum() > 0


def test_a_larger_table_has_fewer_shards(spark, monkeypatch, caplog):
    """Every vector asks every shard, so a table gets no more of them than its size asks for."""
    monkeypatch.setattr(embed_dups, "SMALL_NUMBERS", 50_000)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    x[2000:2200] = x[:200] + 0.03 * rng.normal(size=(200, 16)).astype(np.float32)
    with caplog.at_level("INFO", logger="tessera.llm.embed_dups"):
        got = {r.vec_id: r.n_links for r in embed_dups.linked(table(spark, range(4000), x)).collect()}
    assert "4 of 4 shards are searched by their graph" in caplog.text
    truth, _ = brute(x)
    assert all(got[i] <= truth[i] for i in got) and sum(got.values()) >= 0.99 * truth.sum() > 0


def test_no_row_holds_a_whole_graph(spark, monkeypatch):
    """Graphs travel a row a node, and blocks grow with the table, so that an executor holds one graph and no copies."""
    seen = {}

    def stored(df, name, store=embed_dups.stored):
        seen[name] = store(df, name)
        return seen[name]

    monkeypatch.setattr(embed_dups, "stored", stored)
    monkeypatch.setattr(embed_dups, "BLOCK", 10)
    x = clustered(600, 4, seed=3)
    got = sorted(embed_dups.linked(table(spark, range(600), x)).collect())
    degree, label = brute(x)
    assert [(r.n_links, r.component_id) for r in got] == list(zip(degree.tolist(), label.tolist()))
    graphs = seen["graphs"]
    assert graphs.count() == 600 and "binary" not in str(graphs.dtypes)
    assert dict(graphs.dtypes)["v"] == "array<float>"  # as the table has it: doubles would be twice the bytes
    copies = -(-embed_dups.CELLS * spark.sparkContext.defaultParallelism // embed_dups.SHARDS)
    assert copies < 60 and seen["cells"].inputFiles() and len(seen["cells"].inputFiles()) <= copies * embed_dups.SHARDS


def test_double_vectors_stay_doubles(spark):
    from pyspark.sql import functions as F
    x = clustered(300, 3, seed=2).astype(float)
    rows = table(spark, range(300), x).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.transform("embedding", lambda v: v * 1e200))  # beyond single precision
    degree, label = brute(x)
    got = sorted(embed_dups.linked(rows).collect())
    assert [(r.n_links, r.component_id) for r in got] == list(zip(degree.tolist(), label.tolist()))


def test_a_graph_is_the_same_after_its_rows(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(12)
    raw = rng.normal(size=(1500, 8)).astype(np.float32)
    nodes, copies = rng.permutation(1500).astype(np.int64), np.arange(1500)
    graph = hnsw.Graph.build(embed_dups.unit(raw).astype(np.float32))
    batches = list(embed_dups._graph_rows((8, 3), [(nodes, copies, raw)], [(nodes[:400], copies[:400], raw[:400])], 0.9))
    whole = pa.Table.from_batches(batches)
    shard = embed_dups.Shard(whole["total"][0].as_py(), whole["beam"][0].as_py())
    for (dim, number), batch in embed_dups.runs(whole.to_batches(max_chunksize=70), ["dim", "shard"]):
        assert (dim, number) == (8, 3)
        shard.add(batch)
    again = shard.ready()
    assert len(graph.links) == 3 and all(np.array_equal(a, b) for a, b in zip(graph.links, again.links))
    assert np.array_equal(graph.vectors, again.vectors) and np.array_equal(shard.nodes, nodes) and np.array_equal(shard.copies, copies)
    assert np.array_equal(shard.rows.double(nodes), embed_dups.unit(raw)[nodes]) and shard.beam > 0


def test_exact_products_and_audits_hold_few_at_a_time(monkeypatch):
    """Of a shard that is one cluster, neither all products of a batch nor all its links are held."""
    x, _ = cluster_and_pairs(3000, 1)
    graph, names = hnsw.Graph(x, [np.full((len(x), 4), -1, np.int32)]), np.arange(len(x))
    whole = graph.exact(x, names, 0.9)
    monkeypatch.setattr(hnsw, "PRODUCTS", 30_000)
    monkeypatch.setattr(embed_dups, "PAIRS", 50_000)
    assert all(np.array_equal(a, b) for a, b in zip(whole, graph.exact(x, names, 0.9)))
    sparse, dense = embed_dups.audit_sample(graph, x, 0.9, names, names)
    assert embed_dups.LEAST_LINKS <= len(dense[0]) <= 80_000 and len(sparse[0]) == 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    ids = [1, 2, 3, 4, 5, 6, 7, 8, None, 10, 10]
    vectors = [[1, 0], [2, 0], None, [0, 0], [nan, 1], [1, inf], [None, 1], [1, 0, 0], [1, 0], [0, 1], [0, 1]]
    got = {}
    for r in embed_dups.linked(table(spark, ids, vectors)).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got.pop(1) == [(1, 1, True)] and got.pop(2) == [(1, 1, False)]
    assert got.pop(10) == [(1, 10, True)] * 2
    assert got.pop(None) == [(0, None, True)]
    assert all(v == [(0, k, True)] for k, v in got.items()) and len(got) == 6


def test_one_id_with_different_vectors(spark):
    ids = [5, 5, 7, 5, 3, 9, 2]
    vectors = [[1, 0, 0], [1, 0.1, 0], [1, 0.2, 0], [0, 0, 1], [0, 0.1, 1], [0, 1, 0], [0, 0, 2]]
    degree, label = brute(vectors)
    least = [min(i for i, x in zip(ids, label) if x == own) for own in label]
    got = embed_dups.linked(table(spark, ids, vectors)).collect()
    assert sorted(map(tuple, got)) == sorted((i, int(d), c, i == c) for i, d, c in zip(ids, degree, least))


def test_pairs_beside_a_hot_cluster_by_graph_alone(spark, monkeypatch, capsys):
    import pyarrow as pa

    def by_graph(graph, queries, least, beam):  # inside the test, so that workers get it too
        nothing = np.zeros(0, int)
        graph.exact = lambda *any: (nothing, nothing)
        return graph.near(queries, least, 32)

    monkeypatch.setattr(embed_dups, "SHARDS", 2)
    monkeypatch.setattr(embed_dups, "audited_links", by_graph)
    x, paired = cluster_and_pairs(1500, 1500)
    rows = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))})
    got = {r.vec_id: r.n_links for r in embed_dups.linked(spark.createDataFrame(rows.to_pandas())).collect()}
    truth, _ = brute(x)
    recall = sum(got[i] for i in np.flatnonzero(paired)) / truth[paired].sum()
    with capsys.disabled():
        print(f" recall over scattered pairs, graph alone: {recall:.4f} of {truth[paired].sum()} ", end="")
    assert recall >= embed_dups.RECALL and all(got[i] <= truth[i] for i in range(len(x)))


def test_empty_table(spark):
    assert embed_dups.linked(table(spark, [], [])).collect() == []


def test_query_against_brute_force(spark):
    got = sorted(queries.QUERIES["op2_hnsw"](spark, SF).collect())
    rows = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    degree, label = brute([r.embedding for r in rows])
    assert [(r.vec_id, r.n_links, r.component_id) for r in got] == [
        (r.vec_id, d, rows[c].vec_id) for r, d, c in zip(rows, degree.tolist(), label.tolist())]
