"""Streams against batch answers and brute force."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from tessera.plans import q_streaming as qs
from tessera.streaming import blacklist as bl
from tessera.streaming.replay import Replay, latest, shuffle_partitions


def _brute_blacklist(clicks: pd.DataFrame, threshold: int):
    """Direct simulation of the black-list rule batch by batch."""
    black, counts = set(), {}
    for b in sorted(clicks["batch"].unique()):
        part = clicks[(clicks["batch"] == b) & (~clicks["user"].isin(black))]
        newly = set()
        for (day, user, ad), n in part.groupby(["day", "user", "ad"]).size().items():
            if n >= threshold:
                newly.add(user)
                continue
            key = (day, user, ad)
            counts[key] = counts.get(key, 0) + int(n)
            if counts[key] >= threshold:
                newly.add(user)
        black |= newly
    return black, counts


def test_blacklist_feedback_low_threshold(spark):
    """Threshold 3 makes users get listed, so the feedback path is exercised."""
    threshold = 3
    cnt, black = qs._blacklist(spark, SF_MID, "bl-test", threshold)
    clicks = qs._shuffled_clicks(spark, SF_MID).select("batch", "day", "user", "ad").toPandas()
    exp_black, exp_counts = _brute_blacklist(clicks, threshold)
    assert exp_black, "fixture should list somebody at threshold 3"
    assert {r[0] for r in black.collect()} == exp_black
    assert {(r["dt"], r["userid"], r["adid"]): r["count"] for r in cnt.collect()} == exp_counts
    # and the SQL twin agrees with both
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_MID}/events.parquet')")
    parts = bl.sql_blacklist("clicks", threshold)
    ctes = {"clicks": qs._SQL_SHUFFLED, **parts}
    sql = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())
    sql_black = {r[0] for r in con.execute(sql + ' SELECT DISTINCT "user" FROM trig').fetchall()}
    assert sql_black == exp_black


def test_replay_restart_is_idempotent(spark):
    """Re-running a batch id overwrites its own output folder."""
    rp = Replay(spark, "idem")
    sink = rp.batch_sink()
    df = spark.createDataFrame([("a", 1)], "k string, n long")
    sink(df, 0)
    sink(df, 0)
    sink(spark.createDataFrame([("a", 2)], "k string, n long"), 1)
    assert rows(latest(rp.read_out(), ["k"])) == [("a", 2)]
    assert rp.read_out().count() == 2


def test_watermark_drops_late_events(spark):
    """Event-time windows with a watermark: an event older than the
    watermark (max event time seen minus the delay) no longer counts."""
    from tessera.streaming import operators as so
    from tessera.streaming.replay import window_bounds
    rows_in = [(0, "2024-01-01 10:00:00", "a"), (0, "2024-01-01 10:07:00", "a"),
               (1, "2024-01-01 09:00:00", "a"),   # 67 min behind: late, dropped
               (1, "2024-01-01 10:08:00", "a")]
    df = spark.createDataFrame(rows_in, "batch int, ts string, k string").withColumn("ts", F.col("ts").cast("timestamp"))
    rp = Replay(spark, "late")
    rp.run(df, "batch", lambda s: s.transform(
        lambda x: so.windowed_count(x, "ts", "6 minutes", None, ["k"], "6 minutes")
        .select(*window_bounds(), "k", "n")).writeStream.outputMode("update").foreachBatch(rp.batch_sink()))
    got = rows(latest(rp.read_out(), ["window_start", "window_end", "k"]), "window_start", "n")
    assert got == [("2024-01-01 10:00:00", 1), ("2024-01-01 10:06:00", 2)]  # 09:00 dropped


def test_processing_time_windows_conserve_counts(spark):
    from tessera.streaming import operators as so
    df = spark.range(0, 300).select((F.col("id") % 3).cast("int").alias("batch"), (F.col("id") % 5).alias("k"))
    rp = Replay(spark, "ptime")
    rp.run(df, "batch", lambda s: so.processing_time_count(s, "6 seconds", None, ["k"])
           .select(F.col("window.start").cast("string").alias("ws"), "k", "n")
           .writeStream.outputMode("update").foreachBatch(rp.batch_sink()))
    out = latest(rp.read_out(), ["ws", "k"])
    assert rows(out.groupBy("k").agg(F.sum("n"))) == [(k, 60) for k in range(5)]


def test_stop_on_marker_after_current_batch(spark):
    import os
    import threading
    from tessera.streaming import operators as so
    rp = Replay(spark, "stopflag")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "event_type")
    ev.write.parquet(rp.src + "/part00000")
    q = (so.running_count(rp.stream(ev.schema), ["event_type"]).writeStream.outputMode("update")
         .foreachBatch(rp.batch_sink()).option("checkpointLocation", rp.ckpt)
         .trigger(processingTime="1 second").start())
    marker = rp.root.replace("file:", "") + "/STOP"
    threading.Timer(3.0, lambda: open(marker, "w").close()).start()
    assert so.stop_gracefully(q, so.marker_exists(marker), poll_seconds=0.2, timeout_seconds=120)
    assert not q.isActive and os.path.exists(marker)
    assert rows(latest(rp.read_out(), ["event_type"])) == rows(ev.groupBy("event_type").count())


import pytest  # noqa: E402


@pytest.mark.parametrize("seed", [1, 2])
def test_blacklist_random_inputs_stream_brute_and_sql_agree(spark, seed):
    import random
    from tessera.streaming.replay import Replay
    rnd = random.Random(seed)
    users = rnd.choices([1, 2, 3, 4], weights=[50, 30, 15, 5], k=400)  # skewed: some get listed, some not
    data = [(rnd.randrange(4), f"2024-01-0{rnd.randrange(1, 3)}", u, rnd.randrange(1, 4)) for u in users]
    clicks = spark.createDataFrame(data, "batch int, day string, user long, ad long").withColumn(
        "ts", F.to_timestamp(F.concat("day", F.lit(" 12:00:00"))))
    threshold = 8
    rp = Replay(spark, f"bl-rand-{seed}")
    rp.run(clicks, "batch", lambda s: s.writeStream.foreachBatch(bl.blacklist_sink(rp.out, threshold)))
    cnt, black = bl.final_tables(spark, rp.out)
    exp_black, exp_counts = _brute_blacklist(pd.DataFrame(data, columns=["batch", "day", "user", "ad"]), threshold)
    assert exp_black and len(exp_black) < 4, "inputs should list some users but not all"
    assert {r[0] for r in black.collect()} == exp_black
    assert {(r["dt"], r["userid"], r["adid"]): r["count"] for r in cnt.collect()} == exp_counts
    con = duckdb.connect()
    con.register("clicks_df", pd.DataFrame(data, columns=["batch", "day", "user", "ad"]))
    parts = bl.sql_blacklist("clicks_df", threshold)
    sql = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items())
    assert {r[0] for r in con.execute(sql + ' SELECT DISTINCT "user" FROM trig').fetchall()} == exp_black
    got_sql = {(d, u, a): c for d, u, a, c in con.execute(sql + " SELECT * FROM counts").fetchall()}
    assert got_sql == exp_counts


def test_blacklist_batch_form_equals_stream(spark):
    threshold = 3
    s_cnt, s_black = qs._blacklist(spark, SF_MID, "bl-batch-vs-stream", threshold)
    b_cnt, b_black = bl.blacklist_batch(qs._shuffled_clicks(spark, SF_MID), "batch", threshold)
    assert rows(b_black) == rows(s_black) and rows(b_black)
    assert rows(b_cnt, "dt", "userid", "adid", "count") == rows(s_cnt, "dt", "userid", "adid", "count")


def test_ad_jobs_on_message_files(spark):
    from tessera.session import work_dir
    from tessera.streaming import jobs
    from tessera.streaming.sources import file_drop_stream
    base = work_dir(spark, "jobs")
    msgs = [f"{1704103200000 + i * 4000} area{i % 2} city{i % 3} {i % 2} {1 + i % 3}" for i in range(40)]
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(base + "/in")
    once = {"availableNow": True}
    q = jobs.start_blacklist(file_drop_stream(spark, base + "/in", "value string", "text"),
                             base + "/bl", base + "/bl_ck", threshold=5, trigger=once)
    q.awaitTermination()
    counts, black = jobs.blacklist_tables(spark, base + "/bl")
    assert rows(black) == [(0,), (1,)]          # each user clicks each of its ads more than 5 times
    assert counts.count() == 0                   # all batch counts were >= 5: nothing admitted
    q = jobs.start_area_city_counts(file_drop_stream(spark, base + "/in", "value string", "text"),
                                    base + "/ac", base + "/ac_ck", trigger=once)
    q.awaitTermination()
    assert jobs.area_city_table(spark, base + "/ac").agg(F.sum("n")).first()[0] == 40
    q = jobs.start_last_window_chart(file_drop_stream(spark, base + "/in", "value string", "text"),
                                     base + "/ch", base + "/ch_ck", trigger=once)
    q.awaitTermination()
    charts = jobs.chart_table(spark, base + "/ch").collect()
    assert charts and all(c["chart"].startswith('[{"xtime":') for c in charts)


def test_registered_black_list_fires_in_one_batch_and_over_several(spark):
    """At the real threshold: one user reaches it in the first batch, another only over several."""
    clicks = qs._shuffled_clicks(spark, SF_MID)
    per_batch = clicks.groupBy("batch", "day", "user", "ad").count().groupBy("user").agg(F.max("count").alias("n"))
    most = {r["user"]: r["n"] for r in per_batch.collect()}
    listed = {r[0] for r in qs.q_ad_blacklist(spark, SF_MID).collect()}
    assert any(most[u] >= bl.THRESHOLD for u in listed) and any(most[u] < bl.THRESHOLD for u in listed)
    assert len(listed) < len(most)


LATE = [(0, "2024-01-01 10:00:00", 1, 20), (0, "2024-01-06 10:00:00", 2, 1), (1, "2024-01-01 11:00:00", 1, 15),
        (1, "2024-01-06 11:00:00", 2, 1)]


def _late_clicks(spark):
    rows_in = [(b, t, u, 1) for b, t, u, n in LATE for _ in range(n)]
    return spark.createDataFrame(rows_in, "batch int, ts string, user long, ad long").withColumn(
        "ts", F.col("ts").cast("timestamp")).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


def test_late_clicks_count_by_default(spark):
    """A day's clicks that come after clicks of a much later day still list the user."""
    rp = Replay(spark, "late-default")
    rp.run(_late_clicks(spark), "batch", lambda s: s.writeStream.foreachBatch(bl.blacklist_sink(rp.out)))
    cnt, black = bl.final_tables(spark, rp.out)
    b_cnt, b_black = bl.blacklist_batch(_late_clicks(spark))
    assert rows(black) == rows(b_black) == [(1,)] and bl.dropped_clicks(spark, rp.out) == 0
    assert rows(cnt, "dt", "userid", "adid", "count") == rows(b_cnt, "dt", "userid", "adid", "count")


def test_lateness_drops_and_counts(spark):
    rp = Replay(spark, "late-drop")
    rp.run(_late_clicks(spark), "batch", lambda s: s.writeStream.foreachBatch(bl.blacklist_sink(rp.out, lateness="1 day")))
    cnt, black = bl.final_tables(spark, rp.out)
    assert black.count() == 0 and bl.dropped_clicks(spark, rp.out) == 15
    assert rows(cnt, "dt", "userid", "count") == [("2024-01-01", 1, 20), ("2024-01-06", 2, 2)]


def test_retried_black_list_batch_replaces_its_output(spark):
    rp = Replay(spark, "bl-retry")
    sink = bl.blacklist_sink(rp.out, 8)
    first, second = (_late_clicks(spark).where(f"batch = {b}") for b in (0, 1))
    sink(first.repartition(4), 0)
    sink(first.repartition(2), 0)
    sink(second.repartition(3), 1)
    once = [rows(t) for t in bl.final_tables(spark, rp.out)]
    sink(second.coalesce(1), 1)
    assert [rows(t) for t in bl.final_tables(spark, rp.out)] == once


def test_batch_sink_retry_with_other_partitions(spark):
    rp = Replay(spark, "sink-retry")
    df = spark.range(100)
    rp.batch_sink()(df.repartition(4), 0)
    rp.batch_sink()(df.repartition(2), 0)
    assert rows(rp.read_out().select("id")) == [(i,) for i in range(100)]


def test_bad_messages_do_not_end_the_stream(spark):
    from tessera.session import work_dir
    from tessera.streaming import jobs
    from tessera.streaming.sources import file_drop_stream
    base = work_dir(spark, "bad-messages")
    good = "1704103200000 area1 city1 7 1"
    for n, lines in enumerate((["short message", "", "x area city 1 1", "1 a b y 1", "1 a b 1 z", good], [good])):
        spark.createDataFrame([(m,) for m in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in{n}")
        q = jobs.start_area_city_counts(file_drop_stream(spark, base + "/in*", "value string", "text"),
                                        base + "/out", base + "/ck", trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
    assert rows(jobs.area_city_table(spark, base + "/out"), "area", "city", "ad", "n") == [("area1", "city1", 1, 2)]


def test_day_counts_leave_the_state_with_lateness(spark):
    from tessera.streaming import operators as so
    clicks = qs._clicks(spark, SF_MID)
    rp = Replay(spark, "day-state")
    rp.run(clicks, "batch", lambda s: so.running_count(s, ["day", "ad"], ts="ts", lateness="2 days")
           .writeStream.outputMode("update").foreachBatch(rp.batch_sink()))
    assert rows(latest(rp.read_out(), ["day", "ad"]), "day", "ad", "n") == rows(clicks.groupBy("day", "ad").count())
    kept = spark.read.format("statestore").load(rp.ckpt).select("key.day").distinct().count()
    assert kept < clicks.select("day").distinct().count() // 2


def test_hot_users_of_the_stream_join_are_salted_only(spark):
    some = qs.q_st_batch_join.__wrapped__ if hasattr(qs.q_st_batch_join, "__wrapped__") else qs.q_st_batch_join
    want = rows(some(spark, "/root/testdata/sf0.001", share=1.0))
    assert want and rows(some(spark, "/root/testdata/sf0.001", share=0.05)) == want


def test_user_that_turns_hot_in_mid_stream_keeps_all_pairs(spark):
    """Batches of an hour and a half, so windows span batches; user 7 is hot from batch 1 to 4."""
    import datetime as dt
    import random
    from tessera.streaming import salted_join as sj
    rnd, t0, data = random.Random(5), dt.datetime(2024, 3, 1), []
    for b in range(7):
        users = [7] * 30 * (1 <= b <= 4) + [rnd.randrange(100, 140) for _ in range(40)]
        for u in users + [7, None]:
            for kind in ("click", "click", "purchase", "view"):
                data.append((u, len(data), kind, t0 + dt.timedelta(minutes=90 * b + rnd.randrange(90)), b))
    df = spark.createDataFrame(data, "user_id long, event_id long, event_type string, ts timestamp, batch int")
    rp = Replay(spark, "turns-hot")
    router = sj.Router(spark, rp.root + "/router", 4, 0.2)

    def twice(rows_in, batch_id):  # a retry after the batch was published changes nothing
        router.route(rows_in, batch_id)
        router.route(rows_in, batch_id)
    rp.run(df, "batch", lambda s: s.writeStream.foreachBatch(twice), after=lambda: rp.drain(
        sj.pairs(router.stream()).writeStream.outputMode("append").foreachBatch(rp.batch_sink()), "pairs"))
    hour = [(u, t.replace(minute=0), kind, i) for u, i, kind, t, _ in data if u is not None]
    want = sorted((u, str(w), i, j) for u, w, k, i in hour if k == "click"
                  for v, x, m, j in hour if m == "purchase" and (u, w) == (v, x))
    assert rows(rp.read_out(), "user_id", "window_start", "click_id", "purchase_id") == want
    routed = spark.read.parquet(router.path + "/salted/*")
    salted = routed.where("salt > 0").select("user_id", F.hour("ts").alias("h")).distinct().collect()
    assert {r.user_id for r in salted} == {7} and {3, 4, 5, 6} <= {r.h for r in salted} and 10 not in {r.h for r in salted}
    assert routed.where("event_type = 'click'").groupBy("event_id").count().where("count > 1").count() == 0
    # the summary stays bounded: the counters, open entries and those not yet behind the watermark
    assert router.summary(6).count() <= 2 * router.capacity + 1


def test_summary_misses_no_hot_user_however_many_users_come(spark):
    from tessera.streaming import salted_join as sj
    from tessera.session import work_dir
    router = sj.Router(spark, work_dir(spark, "many-users"), 4, 0.1, decay=1.0)
    for b in range(3):
        df = spark.range(3000).select(
            F.when(F.col("id") % 8 == 0, F.lit(5)).otherwise(F.col("id") + 10_000 * (b + 1)).alias("user_id"),
            F.col("id").alias("event_id"), F.lit("click").alias("event_type"),
            F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * b)).alias("ts"))
        router.route(df, b)
        kept = router.summary(b)
        assert kept.count() <= router.capacity + 2
        assert [r.user_id for r in kept.where("start_us is not null and end_us is null").collect()] == [5]


def test_queue_of_files_one_per_trigger(spark):
    """Queue semantics: with maxFilesPerTrigger=1 each dropped file is its own micro-batch."""
    from tessera.session import work_dir
    from tessera.streaming.sources import file_drop_stream
    base = work_dir(spark, "queue-files")
    for i in range(3):
        spark.createDataFrame([(i, j) for j in range(i + 1)], "f long, v long").coalesce(1) \
            .write.parquet(f"{base}/in/part{i}")
    sink_dir = base + "/out"
    q = (file_drop_stream(spark, base + "/in/*", "f long, v long", "parquet", max_files_per_trigger=1)
         .groupBy("f").count().writeStream.outputMode("update")
         .foreachBatch(lambda df, i: df.withColumn("batch_id", F.lit(i)).write.mode("append").parquet(sink_dir))
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = rows(spark.read.parquet(sink_dir), "batch_id", "f", "count")
    assert len({b for b, _, _ in got}) == 3 and sorted((f, c) for _, f, c in got) == [(0, 1), (1, 2), (2, 3)]


def _brute_sliding(rows_in, length, slide):
    """Counts of every window with events, by looking at all of them."""
    out = {}
    for t, k in rows_in:
        for j in range(length // slide):
            key = ((t // slide - j) * slide, k)
            out[key] = out.get(key, 0) + 1
    return out


def test_panes_sum_to_sliding_windows_and_zeros_come_once(spark):
    import random
    from tessera.streaming import panes
    rnd = random.Random(3)
    data = [(b, 900_000 + b * 2000 + rnd.choice([rnd.randrange(200), 700 + rnd.randrange(60), 1500]), rnd.choice("aab")) for b in range(3) for _ in range(40)]
    df = spark.createDataFrame(data, "batch int, t long, k string").withColumn("ts", F.timestamp_seconds("t"))
    rp = Replay(spark, "panes")
    with panes.keyed_state(spark):
        rp.run(df, "batch", lambda s: panes.sliding_counts(s, "ts", 90, 30, ["k"], "90 seconds")
               .writeStream.outputMode("update").foreachBatch(rp.batch_sink()), state_partitions=2)
    log = rp.read_out().select(F.unix_seconds("window_start").alias("w"), "k", "n", "batch_id").collect()
    want = _brute_sliding([(t, k) for _, t, k in data], 90, 30)
    current = {}
    for r in sorted(log, key=lambda r: r.batch_id):
        current[r.w, r.k] = r.n
    assert {x: n for x, n in current.items() if n} == want
    zeros = [(r.w, r.k) for r in log if r.n == 0]
    passed = max(t for _, t, _ in data) // 30 * 30 - 90
    assert sorted(zeros) == sorted((w + 30, k) for w, k in want if (w + 30, k) not in want and w + 30 + 90 + 15 <= passed)
    held = spark.read.format("statestore").option("stateVarName", "panes").load(rp.ckpt)
    oldest = min(r.block for r in held.select("user_map_key.block").collect())
    assert oldest * panes.BLOCK * 30 > 904_000 - panes.BLOCK * 30, "panes behind the watermark have left"


def test_an_event_changes_one_pane_and_each_slide_two():
    from tessera.streaming.panes import slide_totals
    import random
    rnd = random.Random(1)
    counts = {rnd.randrange(60): rnd.randrange(1, 9) for _ in range(25)}
    got = dict(slide_totals(counts, list(counts), 7))
    assert got == {s: sum(counts.get(s + j, 0) for j in range(7)) for p in counts for s in range(p - 6, p + 1)}


def test_late_rows_change_open_windows_only(spark):
    from tessera.streaming import panes
    at = 900_000
    rows_in = [(0, at, "a"), (0, at + 600, "a"), (1, at + 10, "a"), (1, at + 590, "a"), (1, at + 700, "a")]  # at + 10 is behind the watermark
    df = spark.createDataFrame(rows_in, "batch int, t long, k string").withColumn("ts", F.timestamp_seconds("t"))
    rp = Replay(spark, "panes-late")
    with panes.keyed_state(spark):
        rp.run(df, "batch", lambda s: panes.sliding_counts(s, "ts", 90, 30, ["k"], "90 seconds")
               .writeStream.outputMode("update").foreachBatch(rp.batch_sink()), state_partitions=1)
    cur = latest(rp.read_out(), ["window_start", "window_end", "k"]).where("n > 0")
    got = {r.w: r.n for r in cur.select(F.unix_seconds("window_start").alias("w"), "n").collect()}
    assert got == {w: n for (w, _), n in _brute_sliding([(t, k) for b, t, k in rows_in if (b, t) != (1, at + 10)], 90, 30).items()}


def test_black_list_state_frees_listed_users_and_reads_no_history(spark):
    from tessera.streaming import click_state, panes
    clicks = qs._shuffled_clicks(spark, "/root/testdata/sf0.001")
    rp = Replay(spark, "bl-state")
    with panes.keyed_state(spark):
        rp.run(clicks, "batch", lambda s: click_state.judged(s, 3).writeStream.outputMode("update").foreachBatch(
            click_state.sink(spark, rp.out, 2)), state_partitions=2)
    counts, black = click_state.tables(spark, rp.out, 2)
    listed = {r[0] for r in black.read().collect()}
    exp_black, exp_counts = _brute_blacklist(clicks.select("batch", "day", "user", "ad").toPandas(), 3)
    assert listed == exp_black and {(r["dt"], r["userid"], r["adid"]): r["count"] for r in counts.read().collect()} == exp_counts
    held = spark.read.format("statestore").option("stateVarName", "counts").load(rp.ckpt).select("key.*").distinct()
    assert not listed & {r[0] for r in held.collect()}
    from tessera.streaming.click_state import click_counts
    sent = click_counts(clicks.where("user = 1").coalesce(2)).count()
    assert sent <= 2 * clicks.where("user = 1").select("day", "ad").distinct().count()


def test_black_list_state_with_ttl_keeps_the_tables(spark):
    import datetime
    from tessera.streaming import click_state, panes
    clicks = _late_clicks(spark)
    rp = Replay(spark, "bl-ttl")
    for b in rp.stage(clicks, "batch"):  # a query on the clock has no last batch: one trigger each
        rp.feed(b)
        stream = click_state.judged(rp.stream(clicks.schema), ttl=datetime.timedelta(days=30))
        with panes.keyed_state(spark), shuffle_partitions(spark, 1):
            stream.writeStream.outputMode("update").foreachBatch(click_state.sink(spark, rp.out)).option(
                "checkpointLocation", rp.ckpt).trigger(once=True).start().awaitTermination(60)
    counts, black = click_state.tables(spark, rp.out)
    b_cnt, b_black = bl.blacklist_batch(clicks)
    assert rows(black.read()) == rows(b_black) == [(1,)]
    assert rows(counts.read(), "dt", "userid", "adid", "count") == rows(b_cnt, "dt", "userid", "adid", "count")


def test_a_queue_is_one_run_of_many_batches(spark):
    df = spark.range(0, 60).select((F.col("id") % 6).cast("int").alias("batch"), "id")
    rp = Replay(spark, "queue-run")
    got = {}
    seen = rp.run_queue(df.repartition(4), "batch", lambda rows_, i: got.setdefault(i, rows(rows_.select("batch").distinct())))
    assert seen.starts == 1 and seen.batches == list(range(6))
    assert got == {i: [(i,)] for i in range(6)}


def test_a_queue_goes_on_behind_the_last_finished_batch(spark):
    df = spark.range(0, 40).select((F.col("id") % 4).cast("int").alias("batch"), "id")
    rp = Replay(spark, "queue-again")
    sink = rp.batch_sink()
    rp.run_queue(df, "batch", sink, max_batches=2)
    rp.take_queue(df.schema, sink)
    assert rows(rp.read_out().select("id")) == [(i,) for i in range(40)]


def test_black_list_counts_of_a_month_share_an_entry(spark):
    """A user's batch reads and writes one entry of the state per month and ADS ads, whatever the days and ads."""
    from tessera.streaming import click_state, panes
    data = [(b, f"2024-0{m}-{d:02d}", u, ad) for b in range(3) for u in (7, 8) for m in (1, 2) for d in (1, 2, 9)
            for ad in (1, 2, 63, 64, -1) for _ in range(1 + (u == 8 and b == 1 and ad == 2) * 6)]
    clicks = spark.createDataFrame(data, "batch int, day string, user long, ad long").repartition(5)
    rp = Replay(spark, "bl-blocks")
    with panes.keyed_state(spark):
        rp.run(clicks, "batch", lambda s: click_state.judged(s, 6).writeStream.outputMode("update").foreachBatch(
            click_state.sink(spark, rp.out)), state_partitions=2)
    counts, black = click_state.tables(spark, rp.out)
    exp_black, exp_counts = _brute_blacklist(pd.DataFrame(data, columns=["batch", "day", "user", "ad"]), 6)
    assert {r[0] for r in black.read().collect()} == exp_black == {8}
    assert {(r["dt"], r["userid"], r["adid"]): r["count"] for r in counts.read().collect()} == exp_counts
    held = spark.read.format("statestore").option("stateVarName", "counts").load(rp.ckpt).select("key.user", "user_map_key.*")
    assert rows(held) == [(7, f"2024-0{m}/{block}") for m in (1, 2) for block in (-1, 0, 1)]


def test_counts_of_a_task_are_merged_in_a_bounded_number_of_passes(monkeypatch):
    """Batches of rows are merged into the counts so far only once there are as many rows as counts."""
    import pyarrow as pa
    from tessera.streaming import panes
    monkeypatch.setattr(panes, "MERGE_ROWS", 4)
    seen, concat = [], pa.concat_tables
    monkeypatch.setattr(panes.pa, "concat_tables", lambda t, **k: (lambda out: seen.append(out.num_rows) or out)(concat(t, **k)))
    keys = [(i * 7) % 150 for i in range(600)]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i: i + 3], "d": ["x"] * 3}) for i in range(0, 600, 3)]
    got = pa.Table.from_batches(list(panes.counted(iter(batches), ["k", "d"]))).to_pylist()
    assert sorted((r["k"], r["d"], r["n"]) for r in got) == [(k, "x", 4) for k in range(150)]
    assert sum(seen) <= 3 * 600
    assert list(panes.counted(iter([]), ["k"])) == []


def test_black_list_calls_of_a_user_with_counts_leave_out_the_flag():
    """An entry takes a read and a write behind one that was there, else a look first; it is one text."""
    import json
    from pyspark.sql import Row
    from tessera.streaming.click_state import UserClicks
    calls, held, listed = [], {}, []

    class Map:
        def containsKey(self, key):  # noqa: N802
            calls.append("look")
            return key in held

        def getValue(self, key):  # noqa: N802
            calls.append("read")
            return held.get(key)

        def updateValue(self, key, value):  # noqa: N802
            calls.append("write")
            held[key] = value

        def clear(self):
            held.clear()

    class Flag:
        def exists(self):
            calls.append("flag")
            return bool(listed)

        def update(self, value):
            listed.append(value)

    class Handle:
        def getValueState(self, *a):  # noqa: N802
            return Flag()

        def getMapState(self, *a):  # noqa: N802
            return Map()

    user = UserClicks(5)
    user.init(Handle())

    def batch(*parts):
        calls.clear()
        return [(json.loads(r.counts), r.listed) for r in user.handleInputRows((7,), iter(Row(counts=json.dumps(p)) for p in parts), None)]

    days = {f"2024-01-0{d}/{ad}": 1 for d in (1, 2) for ad in (1, 2, 3)}
    assert batch(days) == [(days, False)] and calls == ["look", "flag", "write"]
    assert batch({"2024-01-01/1": 1}, {"2024-01-01/1": 1, "2024-01-09/2": 1}) == [({"2024-01-01/1": 3, "2024-01-09/2": 1}, False)]
    assert calls == ["look", "read", "write"]
    assert {k: json.loads(v[0]) for k, v in held.items()} == {("2024-01/0",): days | {"2024-01-01/1": 3, "2024-01-09/2": 1}}
    assert batch({"2024-01-09/2": 1}) == [({"2024-01-09/2": 2}, False)] and calls == ["read", "write"]
    assert batch({"2024-01-02/1": 5, "2024-01-02/2": 1, "2024-02-02/2": 4}) == [({"2024-01-02/2": 2, "2024-02-02/2": 4}, True)]
    assert calls == ["read", "read"]  # the second was not there
    assert not held and listed
    assert batch({"2024-01-02/1": 1, "2024-02-02/1": 1}) == [] and calls == ["look", "flag"]


def test_black_list_days_of_any_text(spark):
    """Days may hold the characters that part or quote the counts' texts; ads may be negative."""
    from tessera.streaming import click_state, panes
    days = ["2024/01/03", '2024-01-03 "a"', "", "{\\", "é, ü", "2024-01-03"]
    data = [(b, day, u, ad) for b in range(2) for day in days for u in (1, 2) for ad in (-3, 0, 70)
            for _ in range(1 + 3 * (u == 2 and b == 1 and day == days[0] and ad == 70))]
    clicks = spark.createDataFrame([*data, (0, None, 1, 1), (0, "x", None, 1), (0, "x", 1, None)], "batch int, day string, user long, ad long")
    rp = Replay(spark, "bl-texts")
    with panes.keyed_state(spark):
        rp.run(clicks, "batch", lambda s: click_state.judged(s, 4).writeStream.outputMode("update").foreachBatch(
            click_state.sink(spark, rp.out)), state_partitions=2)
    counts, black = click_state.tables(spark, rp.out)
    exp_black, exp_counts = _brute_blacklist(pd.DataFrame(data, columns=["batch", "day", "user", "ad"]), 4)
    assert {r[0] for r in black.read().collect()} == exp_black == {2}
    assert {(r["dt"], r["userid"], r["adid"]): r["count"] for r in counts.read().collect()} == exp_counts
