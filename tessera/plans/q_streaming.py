"""Registered streaming queries.

Each stream replays a test table in ``N_BATCHES`` event-time batches (see
``tessera.streaming.replay``), restarting from its checkpoint for every
batch, and returns the final table.  The SQL twin is the batch answer on
the same input: a stream is right when its final table equals it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.sources import fixtures as fx
from tessera.sources.tables import Tables
from tessera.streaming import blacklist as bl
from tessera.streaming import click_state, panes, salted_join
from tessera.streaming import operators as so
from tessera.streaming.keyed_log import KeyedLog
from tessera.streaming.replay import (Replay, assign_batches, latest, shuffle_partitions, sql_batches,
                                     window_bounds)

N_BATCHES = 3


def _events(spark, sf_dir):
    return assign_batches(Tables(spark, sf_dir).events, "ts", N_BATCHES)


def _clicks(spark, sf_dir):
    return assign_batches(fx.ad_clicks(spark, sf_dir), "ts", N_BATCHES)


_SQL_EVENTS = f"SELECT *, {sql_batches('ts', N_BATCHES, 'events')} AS batch FROM events"



def _update_sink(rp: Replay, stream_df):
    return stream_df.writeStream.outputMode("update").foreachBatch(rp.batch_sink())


def _log_sink(log: KeyedLog, stream_df):
    """Changed rows as deltas of a keyed log, merged into snapshots as batches go by."""
    return stream_df.writeStream.outputMode("update").foreachBatch(log.sink())


def _append_sink(rp: Replay, stream_df):
    return stream_df.writeStream.outputMode("append").foreachBatch(rp.batch_sink())


# ------------------------------------------------------------------ stateless / per batch


@register("st_word_count", f"""
  SELECT doc_id % {N_BATCHES} AS batch, word, CAST(count(*) AS BIGINT) AS cnt
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY ALL
""")
def q_st_word_count(spark, sf_dir):
    """Stateless count per micro-batch, done inside ``foreachBatch``."""
    from tessera.sources.tables import spread
    docs = spread(Tables(spark, sf_dir).documents.select(
        (F.col("doc_id") % N_BATCHES).cast("bigint").alias("batch"), "text"))
    rp = Replay(spark, "word-count")
    sink = rp.batch_sink()

    def per_batch(df, batch_id):
        words = df.select("batch", F.explode(F.split("text", " ")).alias("word"))
        sink(words.groupBy("batch", "word").agg(F.count(F.lit(1)).alias("cnt")), batch_id)

    rp.run(docs, "batch", lambda s: s.writeStream.foreachBatch(per_batch))
    return rp.read_out().drop("batch_id")


@register("st_queue_source", f"""
  SELECT batch, count(*) AS n, round(sum(value), 4) AS value_sum FROM ({_SQL_EVENTS}) e GROUP BY batch
""")
def q_st_queue_source(spark, sf_dir):
    """A queue of prepared batches consumed one per trigger, in one run of the query."""
    rp = Replay(spark, "queue")
    sink = rp.batch_sink()

    def per_batch(df, batch_id):
        sink(df.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value_sum")),
             batch_id)

    rp.run_queue(_events(spark, sf_dir), "batch", per_batch)
    return rp.read_out().drop("batch_id")


@register("st_parse", fx.with_views(
    'SELECT ts_ms, area, city, "user", ad FROM ad_clicks', "ad_clicks"))
def q_st_parse(spark, sf_dir):
    """Parse the click message text on the stream (append mode)."""
    lines = assign_batches(fx.ad_click_lines(spark, sf_dir), "ts", N_BATCHES).select("batch", "value")
    rp = Replay(spark, "parse")
    rp.run(lines, "batch",
           lambda s: _append_sink(rp, so.parse_clicks(s).select("ts_ms", "area", "city", "user", "ad")))
    return rp.read_out().drop("batch_id")


@register("st_transform", f"""
  SELECT batch, c_mktsegment, CAST(count(*) AS BIGINT) AS n
  FROM ({_SQL_EVENTS}) e JOIN customer ON e.user_id = c_custkey GROUP BY ALL
""")
def q_st_transform(spark, sf_dir):
    """Per-batch DataFrame code: each micro-batch is joined to a static table."""
    cust = Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rp = Replay(spark, "transform")
    sink = rp.batch_sink()

    def per_batch(df, batch_id):
        sink(df.join(cust, "user_id").groupBy("batch", "c_mktsegment").agg(F.count(F.lit(1)).alias("n")),
             batch_id)

    rp.run(_events(spark, sf_dir), "batch", lambda s: s.writeStream.foreachBatch(per_batch))
    return rp.read_out().drop("batch_id")


@register("st_foreach_batch", f"""
  SELECT batch, event_type, CAST(count(*) AS BIGINT) AS n FROM ({_SQL_EVENTS}) e GROUP BY ALL
""")
def q_st_foreach_batch(spark, sf_dir):
    rp = Replay(spark, "foreach")
    sink = rp.batch_sink()
    rp.run(_events(spark, sf_dir), "batch",
           lambda s: s.writeStream.foreachBatch(
               lambda df, i: sink(df.groupBy("batch", "event_type").agg(F.count(F.lit(1)).alias("n")), i)))
    return rp.read_out().drop("batch_id")


# ------------------------------------------------------------------ running state


@register("st_running_state", """
  SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word
""")
def q_st_running_state(spark, sf_dir):
    """Running word count across batches (state keyed by word)."""
    from tessera.sources.tables import spread
    docs = spread(Tables(spark, sf_dir).documents.select(
        (F.col("doc_id") % N_BATCHES).cast("int").alias("batch"), "text"))
    rp = Replay(spark, "running")
    log = KeyedLog(spark, rp.out, ["word"], "word string, n long")
    rp.run(docs, "batch",
           lambda s: _log_sink(log, so.running_count(
               s.select(F.explode(F.split("text", " ")).alias("word")), ["word"])))
    return log.read()


@register("st_resume", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_st_resume(spark, sf_dir):
    """Running count carried across restarts by the checkpoint alone."""
    rp = Replay(spark, "resume")
    rp.run(_events(spark, sf_dir), "batch",
           lambda s: _update_sink(rp, so.running_count(s, ["event_type"])))
    return latest(rp.read_out(), ["event_type"])


@register("st_graceful_stop", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_st_graceful_stop(spark, sf_dir):
    """All input present: ``availableNow`` drains it and stops by itself."""
    rp = Replay(spark, "drain")
    ev = _events(spark, sf_dir)
    for b in rp.stage(ev, "batch"):
        rp.feed(b)
    with shuffle_partitions(spark, spark.sparkContext.defaultParallelism):
        q = (so.running_count(rp.stream(ev.schema), ["event_type"]).writeStream.outputMode("complete")
             .foreachBatch(rp.batch_sink()).option("checkpointLocation", rp.ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return latest(rp.read_out(), ["event_type"])


_SQL_AREA_CITY = """
  SELECT day, area, city, ad, count(*) AS n FROM ad_clicks GROUP BY ALL
"""


def _area_city(spark, sf_dir, name):
    rp = Replay(spark, name)
    keys = ["day", "area", "city", "ad"]
    log = KeyedLog(spark, rp.out, keys, "day string, area string, city string, ad long, n long")
    rp.run(_clicks(spark, sf_dir), "batch",
           lambda s: _log_sink(log, so.running_count(s, keys, ts="ts", lateness="2 days")))
    return log.read()


@register("st_upsert_add", fx.with_views(_SQL_AREA_CITY, "ad_clicks"))
def q_st_upsert_add(spark, sf_dir):
    """Running counts written as values per key (replace, never add)."""
    return _area_city(spark, sf_dir, "upsert")


@register("q_ad_area_city", fx.with_views(_SQL_AREA_CITY, "ad_clicks"))
def q_ad_area_city(spark, sf_dir):
    return _area_city(spark, sf_dir, "area-city")


# Stand-in for the original path prefix of the counted pages.
CELL_PATH_PREFIX = "/en"

_SQL_LOG_PARSED = f"""
  SELECT try_strptime(string_split(value, ' ')[4], '%d/%m/%Y:%H:%M:%S') AS t,
         string_split(value, ' ')[7] AS path
  FROM ({fx.SQL_ACCESS_LOG}) a WHERE try_strptime(string_split(value, ' ')[4], '%d/%m/%Y:%H:%M:%S') IS NOT NULL
"""


@register("st_keyed_cells", f"""
  WITH parsed AS ({_SQL_LOG_PARSED}),
       b AS (SELECT *, {sql_batches('t', N_BATCHES, 'parsed')} AS batch FROM parsed)
  SELECT strftime(t, '%Y/%-m/%-d') || '_' || string_split(regexp_replace(path, '/+$', ''), '/')[-1] AS row_key,
         'info' AS family, 'click' AS qualifier, CAST(max(batch) AS BIGINT) AS version,
         CAST(count(*) AS VARCHAR) AS value
  FROM b WHERE starts_with(path, '{CELL_PATH_PREFIX}') GROUP BY 1
""")
def q_st_keyed_cells(spark, sf_dir):
    """Running page count per (day, page) of an access-log stream, kept as
    wide-column cells (row ``y/M/d_page``, column info:click)."""
    from tessera.functions import text as tx
    from tessera.functions import timefmt as tf
    from tessera.plans.analyses import access_records
    log = access_records(fx.access_log(spark, sf_dir)).select(
        tf.parse_access_time("time_text").alias("t"), "path").where("t is not null")
    rp = Replay(spark, "cells")

    def build(s):
        hits = s.where(F.col("path").startswith(CELL_PATH_PREFIX)).select(
            F.concat(tf.day_unpadded("t"), F.lit("_"),
                     tx.last_segment(F.regexp_replace("path", "/+$", ""))).alias("row_key"), "batch")
        counts = hits.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"),
                                             F.max("batch").cast("bigint").alias("version"))
        return _log_sink(cells, counts)
    cells = KeyedLog(spark, rp.out, ["row_key"], "row_key string, n long, version long")
    rp.run(assign_batches(log, "t", N_BATCHES), "batch", build)
    cur = cells.read()
    return cur.select("row_key", F.lit("info").alias("family"), F.lit("click").alias("qualifier"),
                      "version", F.col("n").cast("string").alias("value"))


# ------------------------------------------------------------------ event-time windows


def _sql_windows(length_s: int, slide_s: int, keys: str, table: str) -> str:
    k = length_s // slide_s
    return f"""
  SELECT strftime(make_timestamp(ws), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp(ws + {length_s} * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
         {keys}, count(*) AS n
  FROM (SELECT *, (epoch_us(ts) // {slide_s * 1000000}) * {slide_s * 1000000} - j * {slide_s * 1000000} AS ws
        FROM {table}, range({k}) r(j)) x
  GROUP BY ALL
"""


@register("st_window_tumbling", f"WITH e AS (SELECT * FROM events) {_sql_windows(360, 360, 'event_type', 'e')}")
def q_st_window_tumbling(spark, sf_dir):
    rp = Replay(spark, "tumbling")
    rp.run(_events(spark, sf_dir), "batch",
           lambda s: _update_sink(rp, so.windowed_count(s, "ts", "6 minutes", None, ["event_type"], "6 minutes")
                                  .select(*window_bounds(), "event_type", "n")))
    return latest(rp.read_out(), ["window_start", "window_end", "event_type"])


#: Windows with events, and once the empty one behind them if the watermark has passed it.
_SQL_SLIDING = f"""
  WITH e AS (SELECT * FROM events),
  w AS ({_sql_windows(540, 180, 'event_type', 'e')}),
  seen AS (SELECT max(epoch_us(ts)) // 180000000 * 180000000 - 540000000 AS passed FROM events),
  gone AS (
    SELECT strftime(CAST(window_start AS TIMESTAMP) + INTERVAL 3 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(CAST(window_end AS TIMESTAMP) + INTERVAL 3 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
           event_type, CAST(0 AS BIGINT) AS n
    FROM w, seen WHERE epoch_us(CAST(window_end AS TIMESTAMP) + INTERVAL 270 SECOND) <= passed)
  SELECT * FROM w UNION ALL
  SELECT * FROM gone WHERE (window_start, event_type) NOT IN (SELECT (window_start, event_type) FROM w)
"""


@register("st_window_sliding", _SQL_SLIDING)
def q_st_window_sliding(spark, sf_dir):
    """Counts of 9 minutes every 3 minutes, by panes that enter and leave; a key that falls
    to zero is emitted once."""
    rp = Replay(spark, "sliding")
    log = KeyedLog(spark, rp.out, ["window_start", "window_end", "event_type"],
                   "window_start string, window_end string, event_type string, n long")

    def build(s):
        counts = panes.sliding_counts(s, "ts", 540, 180, ["event_type"], "9 minutes")
        text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")]
        return counts.select(*text, "event_type", "n").writeStream.outputMode("update").foreachBatch(log.sink())
    with panes.keyed_state(spark):
        rp.run(_events(spark, sf_dir), "batch", build)
    return log.read()


_SQL_ADCLICK = f"""
  WITH b AS (SELECT make_timestamp((epoch_us(ts) // 600000000) * 600000000) AS bucket, ts FROM events)
  SELECT window_start, window_end, strftime(bucket, '%H:%M') AS xtime, count(*) AS clicks FROM (
    SELECT strftime(make_timestamp(ws), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp(ws + 3600000000), '%Y-%m-%d %H:%M:%S') AS window_end, bucket
    FROM (SELECT bucket, (epoch_us(bucket) // 600000000) * 600000000 - j * 600000000 AS ws
          FROM b, range(6) r(j)) x) y
  GROUP BY ALL
"""


def _adclick_windows(spark, sf_dir, name):
    """Clicks pre-bucketed to 10 minutes, counted over the last hour every 10 minutes."""
    rp = Replay(spark, name)

    def build(s):
        b = s.select(so.bucket_time("ts", 600, "bucket"))
        b = b.withWatermark("bucket", "1 hour").withColumn("xtime", F.date_format("bucket", "HH:mm"))
        # one event-time grouping column (the window); the bucket rides along as text
        agg = (b.groupBy(F.window("bucket", "1 hour", "10 minutes").alias("window"), "xtime")
                .agg(F.count(F.lit(1)).alias("clicks")))
        return _update_sink(rp, agg.select(*window_bounds(), "xtime", "clicks"))
    rp.run(_events(spark, sf_dir), "batch", build)
    return latest(rp.read_out(), ["window_start", "window_end", "xtime"])


@register("st_window_adclick", _SQL_ADCLICK)
def q_st_window_adclick(spark, sf_dir):
    return _adclick_windows(spark, sf_dir, "adclick")


@register("q_ad_last_minute", f"""
  SELECT window_start, CAST(to_json(list_sort(list({{'xtime': xtime, 'yval': CAST(clicks AS VARCHAR)}}))) AS VARCHAR) AS chart
  FROM ({_SQL_ADCLICK}) w GROUP BY window_start
""")
def q_ad_last_minute(spark, sf_dir):
    """Chart JSON per window, sorted by time; a window holds at most 6 buckets."""
    w = _adclick_windows(spark, sf_dir, "last-minute")
    item = F.struct("xtime", F.col("clicks").cast("string").alias("yval"))
    return w.groupBy("window_start").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("chart"))


# ------------------------------------------------------------------ stream-stream join


@register("st_batch_join", """
  SELECT c.user_id, strftime(make_timestamp((epoch_us(c.ts) // 3600000000) * 3600000000), '%Y-%m-%d %H:%M:%S') AS window_start,
         c.event_id AS click_id, p.event_id AS purchase_id
  FROM events c JOIN events p
    ON c.user_id = p.user_id AND epoch_us(c.ts) // 3600000000 = epoch_us(p.ts) // 3600000000
  WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def q_st_batch_join(spark, sf_dir, salts: int = 8, share: float = 0.05):
    """Clicks and purchases of a user in the same hour window (inner stream-stream join with
    watermarks on both sides).  Users that earlier batches have shown to be hot are salted
    (``salted_join``); nothing is read ahead of the stream."""
    rp = Replay(spark, "join")
    router = salted_join.Router(spark, rp.root + "/router", salts, share)
    rp.run(_events(spark, sf_dir), "batch", lambda s: s.writeStream.foreachBatch(router.route),
           after=lambda: rp.drain(_append_sink(rp, salted_join.pairs(router.stream())), "pairs"))
    return rp.read_out().drop("batch_id")


# ------------------------------------------------------------------ black list


def _shuffled_clicks(spark, sf_dir):
    """Clicks dealt to batches by id, so that a day's clicks come in several batches."""
    c = fx.ad_clicks(spark, sf_dir)
    return c.withColumn("batch", (F.col("event_id") % N_BATCHES).cast("int"))


_SQL_SHUFFLED = f"SELECT *, CAST(event_id % {N_BATCHES} AS INTEGER) AS batch FROM ({fx.SQL_AD_CLICKS}) a"


def _blacklist(spark, sf_dir, name, threshold=bl.THRESHOLD):
    """(user_ad_count, black_list) after the last batch."""
    rp = Replay(spark, name)
    with panes.keyed_state(spark):
        rp.run(_shuffled_clicks(spark, sf_dir).select("batch", "day", "user", "ad"), "batch",
               lambda s: click_state.judged(s, threshold).writeStream.outputMode("update").foreachBatch(
                   click_state.sink(spark, rp.out)))
    counts, black = click_state.tables(spark, rp.out)
    return counts.read(), black.read()


def _sql_bl(final: str) -> str:
    parts = bl.sql_blacklist("clicks")
    ctes = {"clicks": _SQL_SHUFFLED, **parts}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + final


@register("st_blacklist", _sql_bl("SELECT * FROM counts"))
def q_st_blacklist(spark, sf_dir):
    """user_ad_count(dt, userid, adid, count) after the last batch."""
    return _blacklist(spark, sf_dir, "blacklist-counts")[0]


@register("q_ad_blacklist", _sql_bl('SELECT DISTINCT "user" AS userid FROM trig'))
def q_ad_blacklist(spark, sf_dir):
    """black_list(userid) after the last batch."""
    return _blacklist(spark, sf_dir, "blacklist-users")[1]


# ------------------------------------------------------------------ table as a stream, task-side sink


@register("st_custom_source", "SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users_sum FROM events GROUP BY 1")
def q_st_custom_source(spark, sf_dir):
    """A table's files as the source of a running aggregate."""
    from tessera.streaming.sources import table_stream
    rp = Replay(spark, "custom")
    s = table_stream(spark, sf_dir, "events.parquet", "event_id long, user_id long, event_type string")
    agg = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users_sum"))
    with shuffle_partitions(spark, spark.sparkContext.defaultParallelism):
        q = (agg.writeStream.outputMode("complete").foreachBatch(rp.batch_sink())
             .option("checkpointLocation", rp.ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return latest(rp.read_out(), ["event_type"])


@register("st_foreach_partition_sink", "SELECT event_id, user_id, event_type FROM events")
def q_st_foreach_partition_sink(spark, sf_dir):
    """Every micro-batch written by its tasks: Spark's writer opens one stream
    per task and its committer publishes a task's file once."""
    rp = Replay(spark, "per-partition")
    rp.run(_events(spark, sf_dir), "batch",
           lambda s: s.select("event_id", "user_id", "event_type").writeStream.foreachBatch(rp.batch_sink()))
    return rp.read_out().drop("batch_id")
