"""Operators whose plan is split for scale: same answers as the plain form."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from tessera.operators import layout as lay
from tessera.operators.windows import next_in_group
from tessera.plans.registry import queries
from tessera.sources import fixtures as fx


@pytest.mark.parametrize("split,bucket,ranges", [("time", 60, None), ("time", 3600, None),
                                                 ("time", 86400 * 40, None), ("range", 0, 3), ("range", 0, 29)])
def test_next_in_group_equals_lead(spark, split, bucket, ranges):
    v = fx.visits(spark, SF_MID).select("session_id", "action_time", "action_id", "page_id")
    # coarse sessions (per user) so that groups span many time buckets
    v = v.withColumn("session_id", F.substring_index("session_id", "_", 1))
    got = next_in_group(v, ["session_id"], "action_time", "action_id", "page_id", "nxt", split=split,
                        bucket_seconds=bucket or 3600, n_ranges=ranges)
    w = Window.partitionBy("session_id").orderBy("action_time", "action_id")
    exp = v.withColumn("nxt", F.lead("page_id").over(w))
    assert rows(got, "action_id", "nxt") == rows(exp, "action_id", "nxt")


def test_row_index_dense_and_ordered(spark):
    e = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "ts")
    ix = lay.row_index(e, ["ts", "event_id"], n_ranges=13)
    got = [r["event_id"] for r in ix.orderBy("idx").collect()]
    assert [r["idx"] for r in ix.orderBy("idx").select("idx").collect()] == list(range(e.count()))
    assert got == [r["event_id"] for r in e.orderBy("ts", "event_id").collect()]


@pytest.mark.parametrize("name", ["q_hot_categories", "q_page_flow", "q_area_top3_remark", "agg_by_slice",
                                  "agg_fold_by_key", "act_aggregate_fold", "partition_glom", "partition_max",
                                  "partition_pick", "slice_assign", "row_index", "join_zip", "win_next_page"])
def test_partition_count_does_not_change_answers(spark, name):
    q = queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    answers = []
    try:
        for n in (1, 4, 13):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            answers.append(rows(q(spark, SF_MID)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert answers[0] == answers[1] == answers[2]


def _explain(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_category_plan_is_partial_and_pruned(spark):
    plan = _explain(queries()["q_hot_categories"](spark, SF_MID))
    assert "partial_sum" in plan and "TakeOrderedAndProject" in plan
    # only the three columns the view needs are read from Parquet
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint,event_type:string,props:string>" \
        not in plan
    assert "event_type" in plan


def test_filters_reach_the_scan(spark):
    plan = _explain(queries()["filter_case"](spark, SF_MID))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in plan


def test_top_parts_semi_join_is_broadcast(spark):
    plan = _explain(queries()["filter_in_list"](spark, SF_MID))
    assert "BroadcastHashJoin LeftSemi" in plan or "BroadcastHashJoin" in plan


def test_next_in_group_splits_one_hot_group(spark):
    """All rows in one group and one instant: ranges still cut it apart."""
    df = spark.range(0, 5000).select(F.lit("hot").alias("g"), F.lit("2024-01-01 00:00:00").cast("timestamp")
                                     .alias("ts"), F.col("id"), (F.col("id") * 7 % 11).alias("v"))
    got = next_in_group(df, ["g"], "ts", "id", "v", "nxt", n_ranges=16)
    exp = {r["id"]: (r["id"] + 1) * 7 % 11 if r["id"] < 4999 else None for r in df.select("id").collect()}
    assert {r["id"]: r["nxt"] for r in got.select("id", "nxt").collect()} == exp


@pytest.mark.parametrize("name", ["q_hot_category_sessions", "q_area_top3", "q_item_top10", "win_group_topn"])
def test_per_group_top_n_is_cut_before_the_shuffle(spark, name):
    """A hot group sends at most n rows per task: WindowGroupLimit runs on
    both sides of the exchange."""
    plan = _explain(queries()[name](spark, SF_MID))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") >= 2


def test_streaming_count_is_partially_aggregated(spark):
    from tessera.streaming import operators as so
    s = spark.readStream.schema("k string, v long").parquet("/root/testdata/sf0.001/events.parquet")
    plan = _explain(so.running_count(s, ["k"]))
    assert "partial_count" in plan


def test_range_pieces_balance_a_single_hot_group(spark):
    from tessera.operators.windows import range_pieces
    df = spark.range(0, 8000).select(F.lit("hot").alias("g"), F.col("id"))
    sizes = [r["count"] for r in range_pieces(df, ["g", "id"], 16, "piece").groupBy("piece").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 8000 / 16


def test_hot_join_key_is_split_by_aqe(spark):
    """A key holding a third of the rows: AQE marks the shuffle join as skewed
    and splits that partition (thresholds lowered to test size)."""
    big = spark.range(0, 300_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
                                         .alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 300_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        j = big.join(dim, "k")
        assert len(j.collect()) == 300_000                      # every row finds its key (hot rows: key 0)
        plan = j._jdf.queryExecution().executedPlan().toString()  # final adaptive plan of that run
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_search_and_behaviour_views_keep_every_row(spark):
    """The search records hold all characters of all texts (blanks became "+")."""
    from tessera.functions.text import WHITESPACE, strip_brackets
    from tessera.plans.analyses import parse_search
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = docs.agg(F.sum(F.length(strip_brackets(F.regexp_replace("text", WHITESPACE, "+"))))).first()[0]
    got = parse_search(fx.search_lines(spark, SF_MID))
    assert got.agg(F.sum(F.length("query_words"))).first()[0] == want and got.count() == docs.count()
    assert fx.search_lines(spark, SF_MID).count() > docs.count()  # malformed lines on top
    events = spark.read.parquet(f"{SF_MID}/events.parquet").count()
    assert fx.behaviour_raw(spark, SF_MID).count() == events
    assert fx.behaviour_raw(spark, SF_MID).where("BehaviorType is null").count() == 0


def test_load_sees_appended_files(spark):
    from tessera.session import work_dir
    from tessera.sources.tables import load
    base = work_dir(spark, "append")
    spark.range(10).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(base + "/t.parquet")
    assert load(spark, base, "t").count() == 10
    spark.range(5).withColumn("p", F.lit(1)).write.mode("append").partitionBy("p").parquet(base + "/t.parquet")
    assert load(spark, base, "t").count() == 15


def test_work_dir_needs_the_setting_off_local(monkeypatch):
    from types import SimpleNamespace

    from tessera import session
    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda s: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_range_count_follows_size_not_splits(spark):
    df = spark.range(0, 1000)
    assert lay.range_count(df.repartition(50)) == lay.range_count(df) == spark.sparkContext.defaultParallelism


def test_next_in_group_with_null_keys(spark):
    df = spark.range(0, 60).select(F.when(F.col("id") % 3 > 0, F.lit("s")).alias("g"),
                                   F.timestamp_seconds(F.col("id")).alias("ts"), "id", (F.col("id") * 2).alias("v"))
    w = Window.partitionBy("g").orderBy("ts", "id")
    want = rows(df.withColumn("nxt", F.lead("v").over(w)), "id", "nxt")
    for ranges in (1, 7, 20):
        got = next_in_group(df, ["g"], "ts", "id", "v", "nxt", n_ranges=ranges)
        assert rows(got, "id", "nxt") == want


@pytest.mark.parametrize("name", ["join_left", "join_right"])
def test_outer_joins_can_split_a_hot_key(spark, name):
    """The pairs come from an inner join and the rest from an anti join: no
    outer join, whose optional side could not be split."""
    plan = _explain(queries()[name](spark, SF_MID)).split("\n\n")[0]
    assert "LeftOuter" not in plan and "RightOuter" not in plan


def test_outer_join_split_meets_distinct_keys(spark):
    """The rows without a match are found by the other side's distinct keys, counted small before the exchange."""
    import re
    from tessera.operators import relational as rel
    kept = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k long")
    other = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 12), (9, 13), (None, 14)], "v long, n long")
    df = rel.outer_join_split(kept, other, "k", "v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"HashAggregate\(keys=\[v#\d+L?\]", plan)) == 2
    got = sorted(df.select("k", "n").collect(), key=str)
    assert got == sorted(kept.join(other, F.col("k") == F.col("v"), "left").select("k", "n").collect(), key=str)


def test_src_collection_broadcasts_the_collection(spark, tmp_path):
    """A flag's rows are counted where they are read, not exchanged to one task and sorted there."""
    flags = [None, "N", "N", "R", "X", "A", "N", "A", None]
    spark.createDataFrame([(i, f, 10.0 + i) for i, f in enumerate(flags)],
                          "l_orderkey long, l_returnflag string, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = queries()["src_collection"](spark, str(tmp_path))
    plan = _explain(df).split("\n\n")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange") == 2
    assert rows(df) == [("accepted", 2, 32), ("none", 3, 39), ("returned", 1, 13)]


def test_next_in_group_exchanges_the_data_once(spark):
    """One range exchange; stitching moves one row per range (a broadcast)."""
    df = spark.range(0, 4000).select((F.col("id") % 7).alias("g"), F.timestamp_seconds("id").alias("ts"), "id", F.col("id").alias("v"))
    plan = next_in_group(df, ["g"], "ts", "id", "v", "nxt", n_ranges=5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 1
    time_plan = next_in_group(df, ["g"], "ts", "id", "v", "nxt", split="time")._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(" not in time_plan  # a null-safe join on the bare keys would exchange the big side again


@pytest.mark.parametrize("split", ["range", "time"])
def test_next_in_group_with_null_keys_values_and_short_ranges(spark, split):
    rows_in = [(g, x, i * 60, i, v) for i, (g, x, v) in enumerate(
        [(None, 1.0, "a"), (None, 1.0, None), ("p", float("nan"), "b"), ("p", float("nan"), "c"), ("p", None, "d"),
         (None, None, "e"), ("q", 0.0, "f"), (None, 1.0, "g"), ("p", None, "h")] * 4)]
    df = spark.createDataFrame(rows_in, "g string, x double, t long, id long, v string").withColumn("ts", F.timestamp_seconds("t"))
    w = Window.partitionBy("g", "x").orderBy("ts", "id")
    want = {r["id"]: r["n"] for r in df.withColumn("n", F.lead("v").over(w)).collect()}
    for n in (1, 4, 40):
        got = next_in_group(df, ["g", "x"], "ts", "id", "v", "n", split=split, bucket_seconds=300, n_ranges=n)
        assert {r["id"]: r["n"] for r in got.collect()} == want
    assert next_in_group(df.limit(0), ["g"], "ts", "id", "v", "n", split=split).collect() == []


def test_key_draws_do_not_depend_on_partitions(spark):
    import hashlib
    from tessera.operators import relational as rel
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("part"))
    some = [rows(rel.sample_by_key(df.repartition(n), ["id", "part"], 0.2, 5)) for n in (1, 7)]
    assert some[0] == some[1] and abs(len(some[0]) - 4000) < 4 * 57
    u = {i: int(hashlib.md5(f"5:{i}|{i % 3}".encode()).hexdigest()[:13], 16) / 2**52 for i in range(20_000)}
    assert [r[0] for r in some[0]] == [i for i in range(20_000) if u[i] < 0.2]
    many = rel.sample_by_key(df, ["id", "part"], 1.5, 5, with_replacement=True)
    got = {r.id: r.copies for r in many.collect()}
    assert abs(sum(got.values()) - 30_000) < 4 * 174
    steps = rel.poisson_steps(1.5)
    assert got == {i: n for i in u if (n := sum(u[i] >= s for s in steps))}
    other = rel.sample_by_key(df, ["id", "part"], 0.2, 6)
    assert abs(other.join(rel.sample_by_key(df, ["id", "part"], 0.2, 5), "id").count() - 800) < 200
