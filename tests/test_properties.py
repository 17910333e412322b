"""Property checks of the logical slicing against its defining rule."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import layout as lay


def _expected_slice(i: int, n: int, p: int) -> int:
    """Slice s holds positions [s*n//p, (s+1)*n//p)."""
    for s in range(p):
        if s * n // p <= i < (s + 1) * n // p:
            return s
    raise AssertionError("position outside every slice")


def test_slice_formula_matches_rule(spark):
    cases = [(i, n, p) for n in range(1, 40) for p in range(1, 12) for i in range(n)]
    df = spark.createDataFrame(cases, "i long, n long, p long")
    got = df.select("i", "n", "p", F.floor(((F.col("i") + 1) * F.col("p") - 1) / F.col("n")).alias("s")).collect()
    # slice_of is this expression with a literal p; check both against the rule
    for r in got:
        assert r["s"] == _expected_slice(r["i"], r["n"], r["p"])
    one = df.where("p = 3").select("i", "n", lay.slice_of(F.col("i"), F.col("n"), 3).alias("s")).collect()
    assert all(r["s"] == _expected_slice(r["i"], r["n"], 3) for r in one)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=60, unique=True),
       st.integers(min_value=1, max_value=9))
def test_row_index_is_dense_rank(spark, values, ranges):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = {r["v"]: r["idx"] for r in lay.row_index(df, ["v"], n_ranges=ranges).collect()}
    assert got == {v: k for k, v in enumerate(sorted(values))}


def _rdd_aggregate_by_key(pairs, p, zero, seq, comb):
    """Direct simulation: slice s holds positions [s*n//p, (s+1)*n//p); fold
    each key inside a slice from ``zero`` with ``seq``, then ``comb`` across."""
    n = len(pairs)
    result = {}
    for s in range(p):
        acc = {}
        for k, v in pairs[s * n // p:(s + 1) * n // p]:
            acc[k] = seq(acc.get(k, zero), v)
        for k, v in acc.items():
            result[k] = comb(result[k], v) if k in result else v
    return result


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(min_value=-50, max_value=50)),
                min_size=1, max_size=40),
       st.integers(min_value=1, max_value=6), st.integers(min_value=0, max_value=20))
def test_aggregate_by_slice_equals_rdd_semantics(spark, pairs, p, zero):
    from tessera.operators import aggregates as ag
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(pairs)], "pos long, k string, v long")
    sliced = lay.slice_assign(df, ["pos"], p)
    got = {r["k"]: r["value"] for r in ag.aggregate_by_slice(sliced, ["k"], "v", "slice", zero).collect()}
    assert got == _rdd_aggregate_by_key(pairs, p, zero, max, lambda a, b: a + b)
    got_fold = {r["k"]: r["value"] for r in ag.fold_by_key(sliced, ["k"], "v", "slice", zero).collect()}
    assert got_fold == _rdd_aggregate_by_key(pairs, p, zero, lambda a, b: a + b, lambda a, b: a + b)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=25),
       st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=25))
def test_set_operations_follow_rdd_semantics(spark, left, right):
    from tessera.operators import relational as rel
    a = spark.createDataFrame([(x,) for x in left], "x long")
    b = spark.createDataFrame([(x,) for x in right], "x long")
    key = lambda v: (v is None, v if v is not None else 0)
    got_sub = sorted((r[0] for r in rel.subtract_all_matches(a, b).collect()), key=key)
    assert got_sub == sorted((x for x in left if x not in set(right)), key=key)
    got_int = sorted((r[0] for r in rel.intersect_distinct(a, b).collect()), key=key)
    assert got_int == sorted(set(left) & set(right), key=key)
    assert rel.union_all(a, b).count() == len(left) + len(right)
