"""Registered queries for the relational operators.

Each runs over whole test tables; its SQL twin runs in DuckDB on the same
Parquet files.  Doubles are rounded to 4 places on both sides, integer
sums are cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import layout as lay
from tessera.operators import relational as rel
from tessera.operators import topk
from tessera.operators.loads import LoadedSet
from tessera.operators.windows import next_in_group
from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import fixtures as fx
from tessera.sources.tables import Tables, spread

SLICES = 8  # logical slices for the partition-sensitive operators

# DuckDB twin of ``layout.slice_assign`` over orders ordered by o_orderkey.
SQL_ORDER_SLICES = f"""
  SELECT *, CAST(((idx + 1) * {SLICES} - 1) // n AS BIGINT) AS slice FROM (
    SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n
    FROM orders) x
"""


def order_slices(spark, sf_dir):
    return lay.slice_assign(Tables(spark, sf_dir).orders, ["o_orderkey"], SLICES)


# ------------------------------------------------------------------ §2.3 projections

@register("map_expr", "SELECT l_orderkey, l_linenumber, l_quantity * 2 AS qty_x2 FROM lineitem")
def q_map_expr(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("qty_x2"))


@register("project_field", fx.with_views(
    "SELECT line_id, string_split(value, ' ')[7] AS path FROM access_log", "access_log"))
def q_project_field(spark, sf_dir):
    a = fx.access_log(spark, sf_dir)
    return a.select("line_id", F.get(F.split("value", " "), F.lit(6)).alias("path"))


@register("project_columns", fx.with_views(
    "SELECT username, age, age + 1 AS age_next FROM users", "users"))
def q_project_columns(spark, sf_dir):
    u = fx.users(spark, sf_dir)
    return u.select("username", "age", (F.col("age") + 1).alias("age_next"))


@register("rename_columns", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS city FROM customer")
def q_rename_columns(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_nationkey")
    return rel.rename_columns(c, "id", "name", "city")


@register("flat_map", "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents")
def q_flat_map(spark, sf_dir):
    d = spread(Tables(spark, sf_dir).documents.select("doc_id", "text"))
    return rel.flat_map_split(d, "text", " ", "word", keep=["doc_id"])


@register("flat_map_mixed", fx.with_views("""
  SELECT action_id, unnest(coalesce(string_split(order_category_ids, ','),
                                    [CAST(click_category_id AS VARCHAR)])) AS category
  FROM visits WHERE order_category_ids IS NOT NULL OR click_category_id IS NOT NULL
""", "visits"))
def q_flat_map_mixed(spark, sf_dir):
    v = fx.visits(spark, sf_dir).where(
        F.col("order_category_ids").isNotNull() | F.col("click_category_id").isNotNull())
    v = v.select("action_id", F.split("order_category_ids", ",").alias("lst"),
                 F.col("click_category_id").cast("string").alias("one"))
    return v.select("action_id", F.explode(F.coalesce("lst", F.array("one"))).alias("category"))


@register("flat_map_csv_ids", fx.with_views("""
  SELECT action_id, CAST(unnest(string_split(pay_product_ids, ',')) AS BIGINT) AS product_id
  FROM visits WHERE pay_product_ids IS NOT NULL
""", "visits"))
def q_flat_map_csv_ids(spark, sf_dir):
    v = fx.visits(spark, sf_dir).where(F.col("pay_product_ids").isNotNull())
    return v.select("action_id", F.explode(F.split("pay_product_ids", ",")).alias("p")) \
            .select("action_id", F.col("p").try_cast("bigint").alias("product_id")).where("product_id is not null")


@register("map_values", "SELECT event_id, event_type, round(value * 10, 4) AS value FROM events")
def q_map_values(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return rel.map_values(e, "value", lambda v: F.round(v * 10, 4), keep=["event_id", "event_type"])


@register("swap_pair", "SELECT CAST(count(*) AS BIGINT) AS n, l_returnflag FROM lineitem GROUP BY l_returnflag")
def q_swap_pair(spark, sf_dir):
    counts = ag.count_by(Tables(spark, sf_dir).lineitem, "l_returnflag")
    return rel.swap_pair(counts, "l_returnflag", "n")


def _revenue_batches(batches):
    for b in batches:
        rev = pc.multiply(b.column("l_extendedprice"), pc.subtract(pa.scalar(1.0), b.column("l_discount")))
        yield pa.RecordBatch.from_arrays([b.column("l_orderkey"), b.column("l_linenumber"), rev],
                                         names=["l_orderkey", "l_linenumber", "revenue"])


@register("map_partitions", """
  SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue FROM lineitem
""")
def q_map_partitions(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    out = rel.map_in_arrow(li, _revenue_batches, "l_orderkey long, l_linenumber int, revenue double")
    # decimal rounding on the JVM side (Arrow's round can miss the nearest double by one ulp)
    return out.withColumn("revenue", F.round("revenue", 4))


@register("partition_max", f"""
  SELECT slice, max(o_totalprice) AS max_price FROM ({SQL_ORDER_SLICES}) s GROUP BY slice
""")
def q_partition_max(spark, sf_dir):
    return order_slices(spark, sf_dir).groupBy("slice").agg(F.max("o_totalprice").alias("max_price"))


@register("partition_pick", f"SELECT o_orderkey, o_totalprice FROM ({SQL_ORDER_SLICES}) s WHERE slice = 1")
def q_partition_pick(spark, sf_dir):
    return order_slices(spark, sf_dir).where(F.col("slice") == 1).select("o_orderkey", "o_totalprice")


@register("partition_tag", f"SELECT o_orderkey, slice FROM ({SQL_ORDER_SLICES}) s")
def q_partition_tag(spark, sf_dir):
    return order_slices(spark, sf_dir).select("o_orderkey", "slice")


@register("partition_glom", f"""
  SELECT CAST(sum(mx) AS BIGINT) AS sum_of_maxima, CAST(sum(cnt) AS BIGINT) AS rows_total,
         CAST(count(*) AS BIGINT) AS slices
  FROM (SELECT slice, max(o_orderkey) AS mx, count(*) AS cnt FROM ({SQL_ORDER_SLICES}) s GROUP BY slice) g
""")
def q_partition_glom(spark, sf_dir):
    per = order_slices(spark, sf_dir).groupBy("slice").agg(F.max("o_orderkey").alias("mx"),
                                                            F.count(F.lit(1)).alias("cnt"))
    return per.agg(F.sum("mx").cast("bigint").alias("sum_of_maxima"),
                   F.sum("cnt").cast("bigint").alias("rows_total"),
                   F.count(F.lit(1)).cast("bigint").alias("slices"))


@register("drop_columns", fx.with_views(
    "SELECT * EXCLUDE (created_at, updated_at) FROM reviews", "reviews"))
def q_drop_columns(spark, sf_dir):
    return rel.drop_columns(fx.reviews(spark, sf_dir), "created_at", "updated_at")


# ------------------------------------------------------------------ §2.4 filters

@register("filter_expr", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 2 <> 0")
def q_filter_expr(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.where(F.col("l_linenumber") % 2 != 0).select("l_orderkey", "l_linenumber")


@register("filter_prefix", fx.with_views("""
  SELECT line_id, string_split(value, ' ')[7] AS path FROM access_log
  WHERE starts_with(string_split(value, ' ')[4], '17/01/2024')
""", "access_log"))
def q_filter_prefix(spark, sf_dir):
    a = fx.access_log(spark, sf_dir).select("line_id", F.split("value", " ").alias("f"))
    return (a.where(F.get("f", F.lit(3)).startswith("17/01/2024"))
             .select("line_id", F.get("f", F.lit(6)).alias("path")))


@register("filter_contains", "SELECT doc_id FROM documents WHERE contains(text, 'ion')")
def q_filter_contains(spark, sf_dir):
    return rel.filter_contains(Tables(spark, sf_dir).documents, "text", "ion").select("doc_id")


_SQL_TOP_PARTS = """
  SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY sum(l_quantity) DESC, l_partkey LIMIT 10
"""


@register("filter_in_list", f"""
  SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
  WHERE l_partkey IN ({_SQL_TOP_PARTS})
""")
def q_filter_in_list(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    top = topk.top_k(li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")),
                     [F.desc("q"), F.asc("l_partkey")], 10).select("l_partkey")
    # ``top`` is a limit's output: at most 10 rows, a proven broadcast bound.
    return rel.filter_in(li, top, "l_partkey", small=True).select("l_orderkey", "l_partkey", "l_quantity")


@register("filter_not_in_list", """
  SELECT event_id, user_id FROM events
  WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error'
                        GROUP BY user_id HAVING count(*) >= 15)
""")
def q_filter_not_in_list(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    black = (e.where(F.col("event_type") == "error").groupBy("user_id").count()
              .where(F.col("count") >= 15).select("user_id"))
    # the black list grows with the data: no broadcast hint, AQE decides
    return rel.filter_not_in(e, black, "user_id").select("event_id", "user_id")


@register("filter_between", """
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
  WHERE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') BETWEEN '1995-03-01 00:00:00' AND '1996-03-01 00:00:00'
""")
def q_filter_between(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dt"))
    return (rel.filter_between(o, "dt", "1995-03-01 00:00:00", "1996-03-01 00:00:00")
            .select("o_orderkey", F.substring("dt", 1, 10).alias("day")))


@register("filter_case", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25")
def q_filter_case(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)) \
             .select("l_orderkey", "l_linenumber", "l_quantity")


def _null_count_sql(cols):
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)


_REVIEW_COLS = ["record_id", "create_time", "apply_time", "created_at", "updated_at", *fx.REVIEW_PAYLOAD]


@register("drop_sparse_rows", fx.with_views(
    f"SELECT record_id FROM reviews WHERE {_null_count_sql(_REVIEW_COLS)} <= 3", "reviews"))
def q_drop_sparse_rows(spark, sf_dir):
    return rel.drop_sparse_rows(fx.reviews(spark, sf_dir), 3).select("record_id")


_SAMPLE_SEED, _SAMPLE_SHARE, _SAMPLE_MEAN = 7, 0.1, 0.5
_SQL_DRAW = (f"CAST('0x' || substr(md5('{_SAMPLE_SEED}:' || l_orderkey || '|' || l_linenumber), 1, 13) AS BIGINT) "
             f"/ CAST({1 << 52} AS DOUBLE)")
_SQL_COPIES = " + ".join(f"CAST(u >= {step!r}::DOUBLE AS BIGINT)" for step in rel.poisson_steps(_SAMPLE_MEAN))


@register("sample_rows", f"""
  WITH drawn AS (SELECT l_orderkey, l_linenumber, {_SQL_DRAW} AS u FROM lineitem)
  SELECT 'bernoulli' AS kind, l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS copies FROM drawn WHERE u < {_SAMPLE_SHARE}
  UNION ALL
  SELECT 'poisson', l_orderkey, l_linenumber, {_SQL_COPIES} AS copies FROM drawn WHERE {_SQL_COPIES} > 0
""")
def q_sample_rows(spark, sf_dir):
    """A Bernoulli and a Poisson sample, drawn from digests of the rows' keys."""
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber")
    keys = ["l_orderkey", "l_linenumber"]
    return rel.sample_by_key(rows, keys, _SAMPLE_SHARE, _SAMPLE_SEED).select(F.lit("bernoulli").alias("kind"), "*").unionByName(
        rel.sample_by_key(rows, keys, _SAMPLE_MEAN, _SAMPLE_SEED, True).select(F.lit("poisson").alias("kind"), "*"))


# ------------------------------------------------------------------ §2.5 joins

@register("join_inner", """
  SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_join_inner(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@register("join_left", """
  SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey
""")
def q_join_left(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rel.outer_join_split(t.customer.select("c_custkey"), t.orders.select("o_orderkey", "o_custkey"),
                                "c_custkey", "o_custkey").select("c_custkey", "o_orderkey")


@register("join_right", """
  SELECT o_orderkey, s_suppkey FROM (SELECT DISTINCT l_orderkey AS o_orderkey, l_suppkey FROM lineitem) l
  RIGHT JOIN supplier ON l.l_suppkey = s_suppkey
""")
def q_join_right(spark, sf_dir):
    t = Tables(spark, sf_dir)
    l = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").distinct()
    return rel.outer_join_split(t.supplier.select("s_suppkey"), l, "s_suppkey", "l_suppkey").select(
        "o_orderkey", "s_suppkey")


@register("join_cogroup", """
  SELECT nation, side, member, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT CAST(c_nationkey AS BIGINT) AS nation, 'left' AS side, c_mktsegment AS member FROM customer
    UNION ALL
    SELECT CAST(s_nationkey AS BIGINT), 'right', s_name FROM supplier) u
  GROUP BY ALL
""")
def q_join_cogroup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_mktsegment").alias("member"))
    s = t.supplier.select(F.col("s_nationkey").cast("bigint").alias("nation"), F.col("s_name").alias("member"))
    return rel.cogroup_long(c, s, "nation", "member")


_SQL_COGROUP3 = """
  SELECT category_id,
         CAST(sum(CASE WHEN side = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click_cnt,
         CAST(sum(CASE WHEN side = 'order' THEN 1 ELSE 0 END) AS BIGINT) AS order_cnt,
         CAST(sum(CASE WHEN side = 'pay' THEN 1 ELSE 0 END) AS BIGINT) AS pay_cnt
  FROM (SELECT click_category_id AS category_id, 'click' AS side FROM visits WHERE click_category_id IS NOT NULL
        UNION ALL
        SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order' FROM visits WHERE order_category_ids IS NOT NULL
        UNION ALL
        SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay' FROM visits WHERE pay_category_ids IS NOT NULL) u
  GROUP BY category_id
"""


def _three_sides(spark, sf_dir):
    """Category mentions by click, order and pay; what is no category id is dropped."""
    v = fx.visits(spark, sf_dir)
    clicks = v.where(F.col("click_category_id").isNotNull()).select(F.col("click_category_id").alias("category_id"))
    orders = v.where(F.col("order_category_ids").isNotNull()).select(
        F.explode(F.split("order_category_ids", ",")).alias("c")).select(
            F.col("c").try_cast("bigint").alias("category_id")).where("category_id is not null")
    pays = v.where(F.col("pay_category_ids").isNotNull()).select(
        F.explode(F.split("pay_category_ids", ",")).alias("c")).select(
            F.col("c").try_cast("bigint").alias("category_id")).where("category_id is not null")
    return {"click": clicks, "order": orders, "pay": pays}


@register("join_cogroup3", fx.with_views(_SQL_COGROUP3, "visits"))
def q_join_cogroup3(spark, sf_dir):
    return rel.cogroup_counts(_three_sides(spark, sf_dir), "category_id")


@register("join_map_lookup", """
  SELECT c_custkey, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
    ON c_custkey = o_custkey
""")
def q_join_map_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    # the lookup table grows with the customers: AQE decides broadcast vs shuffle
    return rel.lookup_with_default(t.customer.select("c_custkey"), per_cust, "c_custkey", "n_orders", 0)


@register("join_zip", """
  SELECT a.idx, a.o_orderkey, b.c_custkey FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders) a
  JOIN (SELECT o_custkey AS c_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS idx FROM orders) b
    ON a.idx = b.idx
""")
def q_join_zip(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = lay.row_index(o.select("o_orderkey"), ["o_orderkey"])
    b = lay.row_index(o.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"),
                      ["c_custkey", "o_orderkey"]).drop("o_orderkey")
    z = a.join(b, "idx", "full")
    # zip requires equal sizes: fail the job (lazily) instead of dropping rows
    return z.select("idx",
                    F.when(F.col("o_orderkey").isNull() | F.col("c_custkey").isNull(),
                           F.raise_error(F.lit("zip: inputs differ in size"))).otherwise(F.col("o_orderkey"))
                    .cast("bigint").alias("o_orderkey"),
                    "c_custkey")


# ------------------------------------------------------------------ §2.6 keyed aggregations

@register("agg_reduce_by_key", """
  SELECT l_partkey, round(sum(l_quantity), 4) AS sum_qty FROM lineitem GROUP BY l_partkey
""")
def q_agg_reduce_by_key(spark, sf_dir):
    r = ag.reduce_by_key(Tables(spark, sf_dir).lineitem, ["l_partkey"], "l_quantity", "sum_qty")
    return r.select("l_partkey", F.round("sum_qty", 4).alias("sum_qty"))


@register("agg_group_by_key", """
  SELECT o_custkey, o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL
""")
def q_agg_group_by_key(spark, sf_dir):
    return ag.group_by_key_long(Tables(spark, sf_dir).orders, ["o_custkey"], "o_orderstatus")


@register("agg_group_by_fn", """
  SELECT substring(p_name, 1, 1) AS first_letter, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1
""")
def q_agg_group_by_fn(spark, sf_dir):
    return ag.group_by_expr(Tables(spark, sf_dir).part, F.substring("p_name", 1, 1), "first_letter")


@register("agg_by_slice", f"""
  SELECT o_orderstatus, round(sum(part), 4) AS value FROM (
    SELECT o_orderstatus, slice, greatest(0.0, max(o_totalprice)) AS part
    FROM ({SQL_ORDER_SLICES}) s GROUP BY o_orderstatus, slice) p
  GROUP BY o_orderstatus
""")
def q_agg_by_slice(spark, sf_dir):
    r = ag.aggregate_by_slice(order_slices(spark, sf_dir), ["o_orderstatus"], "o_totalprice", "slice",
                              0.0, "max", "sum")
    return r.select("o_orderstatus", F.round("value", 4).alias("value"))


@register("agg_fold_by_key", f"""
  SELECT o_orderpriority, CAST(sum(part) AS BIGINT) AS value FROM (
    SELECT o_orderpriority, slice, 10 + sum(o_custkey) AS part
    FROM ({SQL_ORDER_SLICES}) s GROUP BY o_orderpriority, slice) p
  GROUP BY o_orderpriority
""")
def q_agg_fold_by_key(spark, sf_dir):
    r = ag.fold_by_key(order_slices(spark, sf_dir), ["o_orderpriority"], "o_custkey", "slice", 10)
    return r.select("o_orderpriority", F.col("value").cast("bigint").alias("value"))


@register("agg_avg_sum_count", """
  SELECT l_returnflag, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) // count(l_quantity) AS BIGINT) AS avg_qty
  FROM lineitem GROUP BY l_returnflag
""")
def q_agg_avg_sum_count(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("q", F.floor("l_quantity"))
    return ag.avg_int(li, ["l_returnflag"], "q", "avg_qty")


@register("agg_combine_equiv", """
  SELECT word, CAST(count(*) AS BIGINT) AS by_reduce, CAST(sum(1) AS BIGINT) AS by_fold,
         CAST(count(word) AS BIGINT) AS by_combine
  FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word
""")
def q_agg_combine_equiv(spark, sf_dir):
    w = rel.flat_map_split(spread(Tables(spark, sf_dir).documents.select("text")), "text", " ", "word")
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("by_reduce"),
                                 F.sum(F.lit(1)).cast("bigint").alias("by_fold"),
                                 F.count("word").alias("by_combine"))


@register("agg_count_by_key", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def q_agg_count_by_key(spark, sf_dir):
    return ag.count_by(Tables(spark, sf_dir).events, "event_type")


@register("agg_count_by_value", """
  SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL
""")
def q_agg_count_by_value(spark, sf_dir):
    return ag.count_by(Tables(spark, sf_dir).events, "user_id", "event_type")


@register("agg_union_pivot", fx.with_views(_SQL_COGROUP3, "visits"))
def q_agg_union_pivot(spark, sf_dir):
    return ag.union_pivot(_three_sides(spark, sf_dir), "category_id")


@register("agg_case_sum", """
  SELECT l_linestatus,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
         CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS other
  FROM lineitem GROUP BY l_linestatus
""")
def q_agg_case_sum(spark, sf_dir):
    return ag.conditional_counts(Tables(spark, sf_dir).lineitem, ["l_linestatus"], "l_returnflag",
                                 {"returned": "R", "accepted": "A", "other": "N"})


@register("agg_count_distinct", """
  SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
  FROM lineitem GROUP BY l_returnflag
""")
def q_agg_count_distinct(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@register("agg_nested_histogram", """
  SELECT n_lines, CAST(count(*) AS BIGINT) AS n_parts
  FROM (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey) p GROUP BY n_lines
""")
def q_agg_nested_histogram(spark, sf_dir):
    return ag.nested_histogram(Tables(spark, sf_dir).lineitem, "l_partkey", "n_lines", "n_parts")


@register("agg_ratio", """
  SELECT o_orderstatus, round(sum(o_totalprice) / count(DISTINCT o_custkey), 4) AS per_customer
  FROM orders GROUP BY o_orderstatus
""")
def q_agg_ratio(spark, sf_dir):
    return Tables(spark, sf_dir).orders.groupBy("o_orderstatus").agg(
        F.round(F.sum("o_totalprice") / F.countDistinct("o_custkey"), 4).alias("per_customer"))


@register("agg_avg_sql", fx.with_views("SELECT round(avg(age), 4) AS avg_age FROM users", "users"))
def q_agg_avg_sql(spark, sf_dir):
    fx.users(spark, sf_dir).createOrReplaceTempView("tessera_users")
    return spark.sql("SELECT round(avg(age), 4) AS avg_age FROM tessera_users")


# ------------------------------------------------------------------ §2.7 global aggregates / actions

@register("act_reduce", "SELECT round(sum(l_quantity), 4) AS total_qty FROM lineitem")
def q_act_reduce(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.agg(F.round(F.sum("l_quantity"), 4).alias("total_qty"))


@register("act_aggregate_fold", f"SELECT CAST(sum(o_orderkey) + 10 * ({SLICES} + 1) AS BIGINT) AS result FROM orders")
def q_act_aggregate_fold(spark, sf_dir):
    r = ag.aggregate_with_zero(Tables(spark, sf_dir).orders, "o_orderkey", SLICES, 10)
    return r.select(F.col("result").cast("bigint").alias("result"))


@register("act_count", "SELECT count(*) AS n FROM lineitem")
def q_act_count(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.agg(F.count(F.lit(1)).alias("n"))


@register("act_stats", """
  SELECT max(n) AS max_n, min(n) AS min_n, round(avg(n), 4) AS mean_n
  FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) p
""")
def q_act_stats(spark, sf_dir):
    s = ag.stats(ag.count_by(Tables(spark, sf_dir).lineitem, "l_partkey"), "n")
    return s.select("max_n", "min_n", F.round("mean_n", 4).alias("mean_n"))


@register("act_first_take", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def q_act_first_take(spark, sf_dir):
    return topk.top_k(Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5)


@register("acc_counters", """
  SELECT count(*) AS rows, round(sum(value), 4) AS value_sum,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
  FROM events
""")
def q_acc_counters(spark, sf_dir):
    """Counters gathered as side metrics of one job over events."""
    from pyspark.sql import Observation
    obs = Observation("events_counters")
    e = Tables(spark, sf_dir).events.observe(
        obs, F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value_sum"),
        F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors"))
    e.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame([(int(m["rows"]), round(float(m["value_sum"]), 4), int(m["errors"]))],
                                 "rows long, value_sum double, errors long")


@register("acc_map_count", fx.with_views(_SQL_COGROUP3, "visits"))
def q_acc_map_count(spark, sf_dir):
    from tessera.plans.hot_categories import category_counts
    return category_counts(fx.visits(spark, sf_dir))


# ------------------------------------------------------------------ §2.8 windows

@register("win_next_page", fx.with_views("""
  SELECT session_id, action_id, page_id,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS next_page
  FROM visits
""", "visits"))
def q_win_next_page(spark, sf_dir):
    v = fx.visits(spark, sf_dir).select("session_id", "action_id", "action_time", "page_id")
    return next_in_group(v, ["session_id"], "action_time", "action_id", "page_id", "next_page") \
        .select("session_id", "action_id", "page_id", "next_page")


# ------------------------------------------------------------------ §2.9 sort / top-k

@register("sort_by", """
  SELECT CAST(o_orderkey AS VARCHAR) AS key_text, row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS pos FROM orders
""")
def q_sort_by(spark, sf_dir):
    """Texts in descending order of their number, each with its position."""
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderkey").cast("string").alias("key_text"))
    return lay.row_index(o, [F.col("key_text").try_cast("bigint").desc()], "pos")


@register("sort_by_key", """
  SELECT c_name, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_name) - 1 AS pos FROM customer
""")
def q_sort_by_key(spark, sf_dir):
    return lay.row_index(Tables(spark, sf_dir).customer.select("c_name", "c_acctbal"), ["c_acctbal", "c_name"], "pos")


@register("topk_global", """
  SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
  FROM lineitem GROUP BY l_partkey ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, l_partkey LIMIT 10
""")
def q_topk_global(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    r = li.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    return topk.top_k(r, [F.desc("rev"), F.asc("l_partkey")], 10) \
        .select("l_partkey", F.round("rev", 4).alias("revenue"))


@register("take_ordered", "SELECT o_totalprice FROM orders ORDER BY o_totalprice LIMIT 10")
def q_take_ordered(spark, sf_dir):
    return topk.take_ordered(Tables(spark, sf_dir).orders.select("o_totalprice"), "o_totalprice", 10)


# ------------------------------------------------------------------ §2.10 set operations

@register("set_union", """
  SELECT CAST(c_nationkey AS BIGINT) AS nation FROM customer
  UNION ALL SELECT CAST(s_nationkey AS BIGINT) FROM supplier
""")
def q_set_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rel.union_all(t.customer.select(F.col("c_nationkey").cast("bigint").alias("nation")),
                         t.supplier.select(F.col("s_nationkey").cast("bigint").alias("nation")))


@register("set_intersect", """
  SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
  INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0
""")
def q_set_intersect(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("custkey"))
    b = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("custkey"))
    return rel.intersect_distinct(a, b)


@register("set_subtract", """
  SELECT l_partkey FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size > 25 AND p.p_partkey IS NOT DISTINCT FROM l.l_partkey)
""")
def q_set_subtract(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.lineitem.select("l_partkey")
    b = t.part.where(F.col("p_size") > 25).select(F.col("p_partkey").alias("l_partkey"))
    return rel.subtract_all_matches(a, b)


@register("set_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def q_set_distinct(spark, sf_dir):
    return rel.distinct(Tables(spark, sf_dir).lineitem.select("l_partkey", "l_returnflag"))


@register("set_except_incremental", """
  SELECT o_orderkey, year FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL
                                 ELSE year(o_orderdate) END AS year FROM orders)
  EXCEPT
  SELECT o_orderkey, year FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL
                                 ELSE year(o_orderdate) END AS year FROM orders) WHERE year < 1996
""")
def q_set_except_incremental(spark, sf_dir):
    """New rows against those loaded before, by key filter and high-water mark."""
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.year("o_orderdate"))
        .cast("bigint").alias("year"))
    loaded = LoadedSet(spark, work_dir(spark, "loaded"), o.schema, mark="year")
    loaded.load(o.where(F.col("year") < 1996))
    return loaded.new_rows(o)


@register("win_rank_top3", """
  SELECT c_mktsegment, nation, orders, rank FROM (
    SELECT *, rank() OVER (PARTITION BY c_mktsegment ORDER BY orders DESC) AS rank FROM (
      SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS nation, count(*) AS orders
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) c) r
  WHERE rank <= 3
""")
def q_win_rank_top3(spark, sf_dir):
    """``rank() <= 3`` per group, ties kept (WindowGroupLimit before the shuffle)."""
    t = Tables(spark, sf_dir)
    c = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy("c_mktsegment", F.col("c_nationkey").cast("bigint").alias("nation"))
         .agg(F.count(F.lit(1)).alias("orders")))
    return topk.rank_top(c, ["c_mktsegment"], [F.desc("orders")], 3, rank_col="rank")


@register("win_group_topn", fx.with_views("""
  SELECT "user", ad, clicks, rn FROM (
    SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY clicks DESC, ad) AS rn
    FROM (SELECT "user", ad, count(*) AS clicks FROM ad_clicks GROUP BY ALL) c) r
  WHERE rn <= 3
""", "ad_clicks"))
def q_win_group_topn(spark, sf_dir):
    """Sort inside each group and keep 3 (ties cut by the ad id)."""
    c = fx.ad_clicks(spark, sf_dir).groupBy("user", "ad").agg(F.count(F.lit(1)).alias("clicks"))
    return topk.top_n_per_group(c, ["user"], [F.desc("clicks"), F.asc("ad")], 3, rank_col="rn")
