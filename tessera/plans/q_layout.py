"""Registered queries: layout and materialisation (§2.14), scalar functions
and the UDF surface (§2.11), wide-column cells."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tessera.functions import text as tx
from tessera.functions import timefmt as tf
from tessera.functions import udf as fu
from tessera.operators import cells as cl
from tessera.operators import layout as lay
from tessera.operators.cell_store import CellStore
from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import fixtures as fx
from tessera.sources.tables import Tables

# ------------------------------------------------------------------ index and slices


@register("slice_assign", """
  SELECT o_orderkey, idx, CAST(((idx + 1) * 5 - 1) // n AS BIGINT) AS slice FROM (
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n FROM orders) x
""")
def q_slice_assign(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    return lay.slice_assign(o, ["o_orderkey"], 5).select("o_orderkey", "idx", "slice")


@register("row_index", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events")
def q_row_index(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    return lay.row_index(e, ["ts", "event_id"]).select("event_id", "idx")


@register("repartition", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_repartition(spark, sf_dir):
    """Grow the partition count (a full shuffle): twice the input's."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return li.repartition(2 * li.rdd.getNumPartitions())


@register("coalesce", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_coalesce(spark, sf_dir):
    """Shrink the partition count without a shuffle: a quarter of the input's."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return li.coalesce(max(1, li.rdd.getNumPartitions() // 4))


@register("partition_by_hash", "SELECT o_orderkey, o_custkey, TRUE AS placed FROM orders")
def q_partition_by_hash(spark, sf_dir):
    """Key-partitioned into the session's shuffle-partition count; ``placed``
    checks that every row sits in partition ``pmod(key, n)``."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    slot = F.pmod(F.col("o_custkey"), F.lit(n)).cast("int")
    placed = lay.partition_by_id(o.withColumn("slot", slot), n, F.col("slot"))
    return placed.select("o_orderkey", "o_custkey", (F.col("slot") == F.spark_partition_id()).alias("placed"))


_SEGMENT_PARTITION = ("CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1 ELSE 2 END")


@register("partition_by_custom", f"SELECT c_custkey, CAST({_SEGMENT_PARTITION} AS BIGINT) AS part FROM customer")
def q_partition_by_custom(spark, sf_dir):
    """Custom partitioner (two named keys, everything else in a third part);
    ``part`` is where each row actually landed.  A part is spread over several
    partitions by a hash of the row's key, so a large part is not one task."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    part = (F.when(F.col("c_mktsegment") == "BUILDING", 0)
             .when(F.col("c_mktsegment") == "AUTOMOBILE", 1).otherwise(2))
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    placed = lay.partition_by_id(c, 3 * salts, part * salts + F.pmod(F.hash("c_custkey"), F.lit(salts)))
    return placed.select("c_custkey", F.floor(F.spark_partition_id() / salts).cast("bigint").alias("part"))


@register("persist_reuse", """
  SELECT 'flag' AS dim, l_returnflag AS val, count(*) AS n FROM lineitem GROUP BY 2
  UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2
""")
def q_persist_reuse(spark, sf_dir):
    """One persisted input feeding two aggregations; the small result is
    checkpointed and the persisted blocks are released."""
    li = lay.persist(Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_linestatus"),
                     StorageLevel.DISK_ONLY)
    a = li.groupBy(F.col("l_returnflag").alias("val")).agg(F.count(F.lit(1)).alias("n"))
    b = li.groupBy(F.col("l_linestatus").alias("val")).agg(F.count(F.lit(1)).alias("n"))
    out = lay.cut_lineage(a.select(F.lit("flag").alias("dim"), "val", "n")
                          .unionByName(b.select(F.lit("status").alias("dim"), "val", "n")))
    li.unpersist()
    return out


@register("checkpoint_cut", """
  SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1
""")
def q_checkpoint_cut(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"),
                                     F.round(F.sum("o_totalprice"), 4).alias("total"))
    return lay.cut_lineage(per)


@register("rdd_df_convert", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_rdd_df_convert(spark, sf_dir):
    """DataFrame -> RDD of Rows -> DataFrame with the same schema."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    return spark.createDataFrame(c.rdd, c.schema)


# Fixed values of the demonstration: names of the return flags.
FLAG_NAMES = [("R", "returned"), ("A", "accepted"), ("N", "none")]


@register("src_collection", f"""
  SELECT flag_name, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in FLAG_NAMES)}) f(flag, flag_name)
    ON l_returnflag = flag GROUP BY 1
""")
def q_src_collection(spark, sf_dir):
    """A collection of the driver program made into a table and joined.  It comes from the
    driver's memory and has no size of its own for the planner: it is broadcast, so that the
    rows of a flag are not exchanged and sorted in one task."""
    flags = F.broadcast(spark.createDataFrame(FLAG_NAMES, "flag string, flag_name string"))
    li = Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_quantity")
    return (li.join(flags, li.l_returnflag == flags.flag).groupBy("flag_name")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")))


# ------------------------------------------------------------------ scalar functions


@register("fn_string", """
  SELECT page_id, right(url, 5) AS r5, left(url, 5) AS l5, substring(url, 3, 4) AS mid,
         trim('  ' || CAST(page_id AS VARCHAR) || '  ') AS trimmed,
         string_split(url, '/')[-1] AS last_seg,
         regexp_replace('[' || CAST(page_id AS VARCHAR) || ']', '\\[|\\]', '', 'g') AS unbracketed,
         starts_with(url, 'https') AS secure, contains(url, 'blog') AS blog
  FROM pages
""")
def q_fn_string(spark, sf_dir):
    p = Tables(spark, sf_dir).pages
    return p.select("page_id",
                    F.expr("right(url, 5)").alias("r5"), F.expr("left(url, 5)").alias("l5"),
                    F.substring("url", 3, 4).alias("mid"),
                    F.trim(F.concat(F.lit("  "), F.col("page_id").cast("string"), F.lit("  "))).alias("trimmed"),
                    tx.last_segment("url").alias("last_seg"),
                    tx.strip_brackets(F.concat(F.lit("["), F.col("page_id").cast("string"), F.lit("]")))
                    .alias("unbracketed"),
                    F.col("url").startswith("https").alias("secure"),
                    F.col("url").contains("blog").alias("blog"))


@register("fn_parse_time", fx.with_views("""
  SELECT line_id, strftime(try_strptime(string_split(value, ' ')[4], '%d/%m/%Y:%H:%M:%S'), '%H') AS hour,
         strftime(try_strptime(string_split(value, ' ')[4], '%d/%m/%Y:%H:%M:%S'), '%Y/%-m/%-d') AS day
  FROM access_log
""", "access_log"))
def q_fn_parse_time(spark, sf_dir):
    a = fx.access_log(spark, sf_dir)
    """Hour and day of each line; NULL where the line has no real time."""
    t = tf.parse_access_time(F.get(F.split("value", " "), F.lit(3)))
    return a.select("line_id", F.date_format(t, "HH").alias("hour"), tf.day_unpadded(t).alias("day"))


@register("fn_epoch", fx.with_views("""
  SELECT event_id, strftime(make_timestamp(CAST(ts_ms // 1000 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS datetime,
         strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day,
         CAST(ts_ms // 10000 * 10000 AS BIGINT) AS bucket_ms
  FROM ad_clicks
""", "ad_clicks"))
def q_fn_epoch(spark, sf_dir):
    a = fx.ad_clicks(spark, sf_dir)
    return a.select("event_id",
                    tf.epoch_seconds_text(F.floor(F.col("ts_ms") / 1000)).alias("datetime"),
                    tf.epoch_ms_day("ts_ms").alias("day"),
                    tf.floor_ms("ts_ms", 10_000).alias("bucket_ms"))


@register("fn_json_build", fx.with_views("""
  SELECT day, CAST(to_json(list_sort(list({'xtime': hh, 'yval': CAST(n AS VARCHAR)}))) AS VARCHAR) AS chart FROM (
    SELECT day, strftime(ts, '%H') AS hh, count(*) AS n FROM ad_clicks GROUP BY 1, 2) c
  GROUP BY day
""", "ad_clicks"))
def q_fn_json_build(spark, sf_dir):
    """Per day: JSON array of {xtime: hour, yval: clicks}.  A day has at most
    24 hours, so the collected list has a fixed bound."""
    a = fx.ad_clicks(spark, sf_dir)
    per = a.groupBy("day", F.date_format("ts", "HH").alias("hh")).agg(F.count(F.lit(1)).alias("n"))
    item = F.struct(F.col("hh").alias("xtime"), F.col("n").cast("string").alias("yval"))
    return per.groupBy("day").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("chart"))


@register("udf_scalar", fx.with_views(
    "SELECT id, 'Name: ' || username AS named, 'Name: ' || username AS named_builtin FROM users", "users"))
def q_udf_scalar(spark, sf_dir):
    """Registered (Arrow-batched) UDF called from SQL text, next to the
    built-in expression that the analyses use."""
    fu.register_all(spark)
    fx.users(spark, sf_dir).createOrReplaceTempView("tessera_users")
    named = spark.sql("SELECT id, username, prefixName(username) AS named FROM tessera_users")
    return named.select("id", "named", tx.prefix_name("username").alias("named_builtin"))


@register("udf_date_part", fx.with_views(
    "SELECT record_id, split_part(create_time, ' ', 1) AS day, split_part(apply_time, ' ', 1) AS day2 FROM reviews",
    "reviews"))
def q_udf_date_part(spark, sf_dir):
    r = fx.reviews(spark, sf_dir)
    return r.select("record_id", fu.text_before_space_udf("create_time").alias("day"),
                    tx.text_before("apply_time", " ").alias("day2"))


@register("udaf_avg_long", """
  SELECT o_orderpriority, CAST(sum(o_custkey) // count(o_custkey) AS BIGINT) AS avg_cust FROM orders GROUP BY 1
""")
def q_udaf_avg_long(spark, sf_dir):
    """(total, count) average with long division by a user-defined aggregate.

    A grouped pandas aggregate has no partial phase, so built-in sums make at
    most 64 (total, count) buffers per group first; the aggregate merges those."""
    o = Tables(spark, sf_dir).orders
    buffers = o.groupBy("o_orderpriority", F.pmod(F.hash("o_orderkey"), F.lit(64)).alias("part")).agg(
        F.sum("o_custkey").alias("total"), F.count("o_custkey").alias("n"))
    return buffers.groupBy("o_orderpriority").agg(fu.merge_avg_long("total", "n").alias("avg_cust"))


# ------------------------------------------------------------------ wide-column cells

def _cells(spark, sf_dir, event_type: str):
    """Click cells (row day_page, info:click) versioned by hour, from events."""
    e = Tables(spark, sf_dir).events.where(F.col("event_type") == event_type)
    k = fx.prop_k()
    per = e.groupBy(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_"), (k % 7 + 1).cast("string"))
                    .alias("row_key"), F.hour("ts").cast("bigint").alias("version")) \
           .agg(F.count(F.lit(1)).alias("n"))
    return per.select("row_key", F.lit("info").alias("family"), F.lit("click").alias("qualifier"),
                      "version", F.col("n").cast("string").alias("value"))


def _sql_cells(event_type: str) -> str:
    return f"""
    SELECT strftime(ts, '%Y-%m-%d') || '_' || CAST({fx.SQL_K} % 7 + 1 AS VARCHAR) AS row_key,
           'info' AS family, 'click' AS qualifier, CAST(hour(ts) AS BIGINT) AS version,
           CAST(count(*) AS VARCHAR) AS value
    FROM events WHERE event_type = '{event_type}' GROUP BY 1, 4"""


_SQL_CELLS = f"SELECT * FROM ({_sql_cells('click')}) a UNION ALL SELECT * FROM ({_sql_cells('view')}) b"
_SQL_LATEST = f"""
  SELECT row_key, family, qualifier, version, value FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC, value DESC) AS rn
    FROM ({_SQL_CELLS}) c) r WHERE rn = 1
"""


def _store(spark, sf_dir):
    """Click and view cells, stored as two sorted runs."""
    store = CellStore(spark, work_dir(spark, "cells"))
    for kind in ("click", "view"):
        store.put(_cells(spark, sf_dir, kind))
    return store


@register("cell_upsert", _SQL_LATEST)
def q_cell_upsert(spark, sf_dir):
    return _store(spark, sf_dir).scan()


@register("cell_versions", f"""
  SELECT row_key, family, qualifier, version, value FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC, value DESC) AS rn
    FROM ({_SQL_CELLS}) c) r WHERE rn <= 2
""")
def q_cell_versions(spark, sf_dir):
    return _store(spark, sf_dir).versions(2)


@register("cell_scan_range", f"""
  SELECT * FROM ({_SQL_LATEST}) l WHERE row_key >= '2024-01-10' AND row_key < '2024-01-20'
""")
def q_cell_scan_range(spark, sf_dir):
    return _store(spark, sf_dir).scan("2024-01-10", "2024-01-20", "info", "click")


@register("cell_delete", f"""
  SELECT * FROM ({_SQL_CELLS}) c
  WHERE NOT ends_with(row_key, '_3') AND NOT (starts_with(row_key, '2024-01-05') AND qualifier = 'click')
""")
def q_cell_delete(spark, sf_dir):
    store = _store(spark, sf_dir)
    keys = store.scan().select("row_key").distinct()
    whole = keys.where(F.col("row_key").endswith("_3")).select(
        "row_key", F.lit(None).cast("string").alias("family"), F.lit(None).cast("string").alias("qualifier"))
    single = keys.where(F.col("row_key").startswith("2024-01-05")).select(
        "row_key", F.lit("info").alias("family"), F.lit("click").alias("qualifier"))
    store.delete(whole.unionByName(single))
    return store.visible(None, None)
