"""Registered end-user analyses."""

from __future__ import annotations

from tessera.plans import hot_categories as hc
from tessera.plans.registry import register
from tessera.sources import fixtures as fx


# ---------------------------------------------------------------- hot categories

_SQL_CATEGORY_COUNTS = """
  SELECT category_id,
         CAST(sum(CASE WHEN kind = 0 THEN 1 ELSE 0 END) AS BIGINT) AS click_cnt,
         CAST(sum(CASE WHEN kind = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_cnt,
         CAST(sum(CASE WHEN kind = 2 THEN 1 ELSE 0 END) AS BIGINT) AS pay_cnt
  FROM (
    SELECT CAST(cid AS BIGINT) AS category_id, kind FROM (
      SELECT kind, unnest(CASE kind WHEN 0 THEN [CAST(click_category_id AS VARCHAR)]
                                    WHEN 1 THEN string_split(order_category_ids, ',')
                                    ELSE string_split(pay_category_ids, ',') END) AS cid
      FROM (SELECT *, CASE WHEN click_category_id IS NOT NULL THEN 0
                           WHEN order_category_ids IS NOT NULL THEN 1
                           WHEN pay_category_ids IS NOT NULL THEN 2 END AS kind
            FROM visits) v
      WHERE kind IS NOT NULL) x) y
  GROUP BY category_id
"""

SQL_HOT_CATEGORIES = fx.with_views(
    "SELECT * FROM category_counts ORDER BY click_cnt DESC, order_cnt DESC, pay_cnt DESC, category_id LIMIT 10",
    "visits", extra={"category_counts": _SQL_CATEGORY_COUNTS})


@register("q_hot_categories", SQL_HOT_CATEGORIES)
def q_hot_categories(spark, sf_dir):
    return hc.hot_categories(fx.visits(spark, sf_dir), 10)


SQL_HOT_CATEGORY_SESSIONS = fx.with_views("""
  SELECT category_id, session_id, click_cnt, rn FROM (
    SELECT category_id, session_id, click_cnt,
           row_number() OVER (PARTITION BY category_id ORDER BY click_cnt DESC, session_id) AS rn
    FROM (SELECT click_category_id AS category_id, session_id, count(*) AS click_cnt
          FROM visits
          WHERE click_category_id IS NOT NULL
            AND click_category_id IN (SELECT category_id FROM hot)
          GROUP BY 1, 2) c) r
  WHERE rn <= 10
""", "visits", extra={
    "category_counts": _SQL_CATEGORY_COUNTS,
    "hot": "SELECT category_id FROM category_counts ORDER BY click_cnt DESC, order_cnt DESC, pay_cnt DESC, category_id LIMIT 10",
})


@register("q_hot_category_sessions", SQL_HOT_CATEGORY_SESSIONS)
def q_hot_category_sessions(spark, sf_dir):
    return hc.hot_category_sessions(fx.visits(spark, sf_dir), 10, 10)


# ---------------------------------------------------------------- imports for the rest
from pyspark.sql import functions as F  # noqa: E402

from tessera.plans import analyses as an  # noqa: E402
from tessera.sources.tables import Tables  # noqa: E402


def _products(spark, sf_dir):
    return Tables(spark, sf_dir).part.select(F.col("p_partkey").alias("product_id"),
                                             F.col("p_name").alias("product_name"))


# ---------------------------------------------------------------- word count / ads / logs

@register("q_word_count", """
  SELECT word, CAST(count(*) AS BIGINT) AS cnt
  FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word
""")
def q_word_count(spark, sf_dir):
    return an.word_count(fx.document_lines(spark, sf_dir))


@register("q_province_top_ads", fx.with_views("""
  SELECT province, ad, clicks, rn FROM (
    SELECT province, ad, clicks, row_number() OVER (PARTITION BY province ORDER BY clicks DESC, ad) AS rn
    FROM (SELECT area AS province, ad, count(*) AS clicks FROM ad_clicks GROUP BY ALL) c) r
  WHERE rn <= 3
""", "ad_clicks"))
def q_province_top_ads(spark, sf_dir):
    return an.province_top_ads(fx.ad_clicks(spark, sf_dir), 3)


@register("q_log_hourly", fx.with_views("""
  SELECT substring(string_split(value, ' ')[4], 12, 2) AS hour, CAST(count(*) AS BIGINT) AS requests
  FROM access_log WHERE try_strptime(string_split(value, ' ')[4], '%d/%m/%Y:%H:%M:%S') IS NOT NULL GROUP BY 1
""", "access_log"))
def q_log_hourly(spark, sf_dir):
    return an.log_hourly(fx.access_log(spark, sf_dir))


@register("q_log_day_paths", fx.with_views("""
  SELECT string_split(value, ' ')[7] AS path, CAST(count(*) AS BIGINT) AS hits
  FROM access_log WHERE starts_with(string_split(value, ' ')[4], '17/01/2024') GROUP BY 1
""", "access_log"))
def q_log_day_paths(spark, sf_dir):
    return an.log_day_paths(fx.access_log(spark, sf_dir), "17/01/2024")


# ---------------------------------------------------------------- page flow

@register("q_page_flow", fx.with_views("""
  SELECT j.from_page, j.to_page, j.jumps, coalesce(d.visits, 0) AS visits,
         round(CAST(j.jumps AS DOUBLE) / d.visits, 4) AS rate
  FROM (SELECT page_id AS from_page, next_page AS to_page, count(*) AS jumps
        FROM (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS next_page
              FROM visits) n
        WHERE page_id BETWEEN 1 AND 6 AND next_page = page_id + 1
        GROUP BY 1, 2) j
  LEFT JOIN (SELECT page_id AS from_page, count(*) AS visits FROM visits
             WHERE page_id BETWEEN 1 AND 6 GROUP BY 1) d ON j.from_page = d.from_page
""", "visits"))
def q_page_flow(spark, sf_dir):
    return an.page_flow(fx.visits(spark, sf_dir))


# ---------------------------------------------------------------- area top 3

_SQL_AREA_T2 = """
  SELECT area, p_name AS product_name, CAST(count(*) AS BIGINT) AS click_cnt
  FROM product_clicks c JOIN part ON c.click_product_id = p_partkey
                       JOIN city_info ci ON c.city_id = ci.city_id
  GROUP BY area, p_name
"""


@register("q_area_top3", fx.with_views("""
  SELECT area, product_name, click_cnt, rank FROM (
    SELECT *, rank() OVER (PARTITION BY area ORDER BY click_cnt DESC) AS rank FROM t2) r
  WHERE rank <= 3
""", "product_clicks", "city_info", extra={"t2": _SQL_AREA_T2}))
def q_area_top3(spark, sf_dir):
    return an.area_top3(fx.product_clicks(spark, sf_dir), fx.city_info(spark, sf_dir), _products(spark, sf_dir))


_SQL_REMARK = """
  SELECT area, product_name, CAST(max(total) AS BIGINT) AS click_cnt,
         concat_ws(', ',
           max(CASE WHEN rn = 1 THEN city_name || ' ' || CAST(pct AS VARCHAR) || '%' END),
           max(CASE WHEN rn = 2 THEN city_name || ' ' || CAST(pct AS VARCHAR) || '%' END),
           CASE WHEN max(ncity) > 2 THEN '其他 ' || CAST(100 - sum(pct) AS VARCHAR) || '%' END) AS city_remark
  FROM (SELECT *, cnt * 100 // total AS pct FROM (
          SELECT area, product_name, city_name, cnt,
                 sum(cnt) OVER (PARTITION BY area, product_name) AS total,
                 count(*) OVER (PARTITION BY area, product_name) AS ncity,
                 row_number() OVER (PARTITION BY area, product_name ORDER BY cnt DESC, city_name) AS rn
          FROM (SELECT area, p_name AS product_name, city_name, count(*) AS cnt
                FROM product_clicks c JOIN part ON c.click_product_id = p_partkey
                                     JOIN city_info ci ON c.city_id = ci.city_id
                GROUP BY ALL) x) y
        WHERE rn <= 2) z
  GROUP BY area, product_name
"""


@register("udaf_city_remark", fx.with_views("SELECT * FROM remark", "product_clicks", "city_info",
                                            extra={"remark": _SQL_REMARK}))
def q_udaf_city_remark(spark, sf_dir):
    counts = an.area_product_city_counts(fx.product_clicks(spark, sf_dir), fx.city_info(spark, sf_dir),
                                         _products(spark, sf_dir))
    return an.city_remark(counts, ["area", "product_name"])


@register("q_area_top3_remark", fx.with_views("""
  SELECT area, product_name, click_cnt, city_remark, rank FROM (
    SELECT *, rank() OVER (PARTITION BY area ORDER BY click_cnt DESC) AS rank FROM remark) r
  WHERE rank <= 3
""", "product_clicks", "city_info", extra={"remark": _SQL_REMARK}))
def q_area_top3_remark(spark, sf_dir):
    return an.area_top3_remark(fx.product_clicks(spark, sf_dir), fx.city_info(spark, sf_dir),
                               _products(spark, sf_dir))


@register("join_star_sql", fx.with_views("SELECT * FROM t2", "product_clicks", "city_info",
                                         extra={"t2": _SQL_AREA_T2}))
def q_join_star_sql(spark, sf_dir):
    """The star join written as Spark SQL over temp views."""
    fx.product_clicks(spark, sf_dir).createOrReplaceTempView("tessera_product_clicks")
    fx.city_info(spark, sf_dir).createOrReplaceTempView("tessera_city_info")
    Tables(spark, sf_dir).part.createOrReplaceTempView("tessera_part")
    return spark.sql("""
      SELECT area, p_name AS product_name, count(*) AS click_cnt
      FROM tessera_product_clicks c JOIN tessera_part ON c.click_product_id = p_partkey
                                   JOIN tessera_city_info ci ON c.city_id = ci.city_id
      GROUP BY area, p_name""")


# ---------------------------------------------------------------- search log

_TRIM = "trim(value, chr(1)||chr(2)||chr(3)||chr(4)||chr(5)||chr(6)||chr(7)||chr(8)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(14)||chr(15)||chr(16)||chr(17)||chr(18)||chr(19)||chr(20)||chr(21)||chr(22)||chr(23)||chr(24)||chr(25)||chr(26)||chr(27)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32))"

_SQL_SEARCH_RECORDS = f"""
  SELECT f[1] AS query_time, f[2] AS user_id, regexp_replace(f[3], '\\[|\\]', '', 'g') AS query_words,
         TRY_CAST(f[4] AS INTEGER) AS result_rank, TRY_CAST(f[5] AS INTEGER) AS click_rank, f[6] AS click_url
  FROM (SELECT regexp_split_to_array({_TRIM},
                                     '[ \\t\\n\\r\\f\\x0B]+') AS f
        FROM search_lines WHERE value IS NOT NULL) s
  WHERE len(f) = 6
"""


def _search_records(spark, sf_dir):
    return an.parse_search(fx.search_lines(spark, sf_dir))


def _search_sql(body):
    return fx.with_views(body, "search_lines", extra={"records": _SQL_SEARCH_RECORDS})


@register("src_delimited_parse", _search_sql("SELECT * FROM records"))
def q_src_delimited_parse(spark, sf_dir):
    return _search_records(spark, sf_dir)


@register("src_malformed_filter", _search_sql("SELECT CAST(count(*) AS BIGINT) AS well_formed FROM records"))
def q_src_malformed_filter(spark, sf_dir):
    return _search_records(spark, sf_dir).agg(F.count(F.lit(1)).alias("well_formed"))


@register("q_search_url", _search_sql("""
  SELECT string_split(click_url, '/')[1] AS host, CAST(count(*) AS BIGINT) AS hits
  FROM records WHERE substring(click_url, 1, 3) = 'www' GROUP BY 1
"""))
def q_search_url(spark, sf_dir):
    return an.search_url(_search_records(spark, sf_dir))


@register("q_search_rank", _search_sql(
    "SELECT result_rank, CAST(count(*) AS BIGINT) AS clicks FROM records GROUP BY 1"))
def q_search_rank(spark, sf_dir):
    return an.search_rank(_search_records(spark, sf_dir))


_SQL_TOKENS = "list_filter(regexp_split_to_array(lower(query_words), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')"


@register("q_search_keywords", _search_sql(f"""
  SELECT word, CAST(count(*) AS BIGINT) AS cnt
  FROM (SELECT unnest({_SQL_TOKENS}) AS word FROM records) w GROUP BY word
"""))
def q_search_keywords(spark, sf_dir):
    return an.search_keywords(_search_records(spark, sf_dir))


@register("fn_tokenise", _search_sql(f"""
  SELECT user_id, unnest({_SQL_TOKENS}) AS word FROM records
"""))
def q_fn_tokenise(spark, sf_dir):
    from tessera.functions import text as tx
    return tx.explode_tokens(_search_records(spark, sf_dir), "query_words", keep=["user_id"])


@register("q_search_user_query", _search_sql("""
  SELECT max(n) AS max_count, min(n) AS min_count, round(avg(n), 4) AS mean_count, count(*) AS pairs
  FROM (SELECT user_id, query_words, count(*) AS n FROM records GROUP BY 1, 2) p
"""))
def q_search_user_query(spark, sf_dir):
    return an.search_user_query(_search_records(spark, sf_dir))


@register("q_search_user_query_pairs", _search_sql(
    "SELECT user_id, query_words, count(*) AS n FROM records GROUP BY 1, 2"))
def q_search_user_query_pairs(spark, sf_dir):
    return an.search_user_query_pairs(_search_records(spark, sf_dir))


@register("q_search_best_rank", _search_sql(f"""
  SELECT CAST(sum(CASE WHEN ok AND len(f) = 6 AND TRY_CAST(f[5] AS INTEGER) = 1 AND TRY_CAST(f[4] AS INTEGER) = 1
                  THEN 1 ELSE 0 END) AS BIGINT) AS best,
         count(*) AS lines,
         round(sum(CASE WHEN ok AND len(f) = 6 AND TRY_CAST(f[5] AS INTEGER) = 1 AND TRY_CAST(f[4] AS INTEGER) = 1
                   THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS rate
  FROM (SELECT value IS NOT NULL AS ok,
               regexp_split_to_array({_TRIM},
                                     '[ \\t\\n\\r\\f\\x0B]+') AS f FROM search_lines) s
"""))
def q_search_best_rank(spark, sf_dir):
    return an.search_best_rank(fx.search_lines(spark, sf_dir))


@register("q_search_hourly", _search_sql(
    "SELECT substring(query_time, 1, 2) AS hour, CAST(count(*) AS BIGINT) AS searches FROM records GROUP BY 1"))
def q_search_hourly(spark, sf_dir):
    return an.search_hourly(_search_records(spark, sf_dir))


# ---------------------------------------------------------------- shopping behaviour

CLEAN_RANGE = ("2024-01-03 00:00:00", "2024-01-28 00:00:00")

_SQL_CLEAN = f"""
  SELECT *, substring(DateTime, 1, 10) AS Dates, substring(DateTime, 12, 2) AS Hours FROM (
    SELECT UserID, ItemID, CategoryID, BehaviorType, right(TimeStamp, 10) AS TimeStamp,
           strftime(make_timestamp(TRY_CAST(right(TimeStamp, 10) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS DateTime
    FROM behaviour_raw) t
  WHERE DateTime BETWEEN '{CLEAN_RANGE[0]}' AND '{CLEAN_RANGE[1]}'
"""


def _clean(spark, sf_dir):
    return an.clean_behaviour(fx.behaviour_raw(spark, sf_dir), *CLEAN_RANGE)


def _behaviour_sql(body):
    return fx.with_views(body, "behaviour_raw", extra={"clean": _SQL_CLEAN})


_SQL_SUMS = ", ".join(
    f"CAST(sum(CASE WHEN BehaviorType = '{b}' THEN 1 ELSE 0 END) AS BIGINT) AS {b}" for b in an.BEHAVIOURS)


@register("q_behaviour_clean", _behaviour_sql("""
  SELECT count(DISTINCT UserID) AS users, count(DISTINCT ItemID) AS items,
         count(DISTINCT CategoryID) AS categories, count(*) AS actions FROM clean
"""))
def q_behaviour_clean(spark, sf_dir):
    return an.behaviour_totals(_clean(spark, sf_dir))


@register("q_behaviour_rows", _behaviour_sql("SELECT * FROM clean"))
def q_behaviour_rows(spark, sf_dir):
    """The cleaned rows themselves."""
    return _clean(spark, sf_dir)


@register("q_daily_conversion", _behaviour_sql("""
  SELECT Dates, count(DISTINCT UserID) AS uv,
         CAST(sum(CASE WHEN BehaviorType = 'pv' THEN 1 ELSE 0 END) AS BIGINT) AS pv,
         CAST(sum(CASE WHEN BehaviorType = 'buy' THEN 1 ELSE 0 END) AS BIGINT) AS buy,
         round(sum(CASE WHEN BehaviorType = 'buy' THEN 1 ELSE 0 END) / count(DISTINCT UserID), 4) AS conversion
  FROM clean GROUP BY Dates
"""))
def q_daily_conversion(spark, sf_dir):
    return an.daily_conversion(_clean(spark, sf_dir))


@register("q_funnel_total", _behaviour_sql(f"SELECT {_SQL_SUMS} FROM clean"))
def q_funnel_total(spark, sf_dir):
    return an.funnel_total(_clean(spark, sf_dir))


@register("q_funnel_daily", _behaviour_sql(
    f"SELECT Dates, count(DISTINCT UserID) AS users, {_SQL_SUMS} FROM clean GROUP BY Dates"))
def q_funnel_daily(spark, sf_dir):
    return an.funnel_by(_clean(spark, sf_dir), "Dates")


@register("q_funnel_hourly", _behaviour_sql(
    f"SELECT Hours, count(DISTINCT UserID) AS users, {_SQL_SUMS} FROM clean GROUP BY Hours"))
def q_funnel_hourly(spark, sf_dir):
    return an.funnel_by(_clean(spark, sf_dir), "Hours")


@register("agg_case_sum_daily", _behaviour_sql(f"SELECT Dates, {_SQL_SUMS} FROM clean GROUP BY Dates"))
def q_agg_case_sum_daily(spark, sf_dir):
    from tessera.operators import aggregates as ag
    return ag.conditional_counts(_clean(spark, sf_dir), ["Dates"], "BehaviorType", {b: b for b in an.BEHAVIOURS})


_SQL_ITEM_TOP = """
  SELECT BehaviorType, ItemID, times, rn FROM (
    SELECT *, row_number() OVER (PARTITION BY BehaviorType ORDER BY times DESC, ItemID) AS rn
    FROM (SELECT BehaviorType, ItemID, count(BehaviorType) AS times FROM clean GROUP BY 1, 2) c) r
  WHERE rn <= 10
"""


@register("q_item_top10", _behaviour_sql(_SQL_ITEM_TOP))
def q_item_top10(spark, sf_dir):
    return an.item_top10(_clean(spark, sf_dir), 10)


@register("topk_sql", _behaviour_sql("""
  SELECT ItemID, count(BehaviorType) AS times FROM clean WHERE BehaviorType = 'buy'
  GROUP BY ItemID ORDER BY count(BehaviorType) DESC, ItemID LIMIT 10
"""))
def q_topk_sql(spark, sf_dir):
    """The SQL-text form: one parameterised statement per behaviour."""
    _clean(spark, sf_dir).createOrReplaceTempView("tessera_userbehavior")
    return spark.sql("""
      SELECT ItemID, count(BehaviorType) AS times FROM tessera_userbehavior WHERE BehaviorType = :b
      GROUP BY ItemID ORDER BY count(BehaviorType) DESC, ItemID LIMIT 10""", args={"b": "buy"})


@register("q_repurchase_histogram", _behaviour_sql("""
  SELECT buys, count(ItemID) AS items FROM (
    SELECT ItemID, count(BehaviorType) AS buys FROM clean WHERE BehaviorType = 'buy' GROUP BY ItemID) a
  GROUP BY buys
"""))
def q_repurchase_histogram(spark, sf_dir):
    return an.repurchase_histogram(_clean(spark, sf_dir))


@register("temp_view", _behaviour_sql("SELECT Hours, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY Hours"))
def q_temp_view(spark, sf_dir):
    """Chained named views, as the cleaning job builds them."""
    fx.behaviour_raw(spark, sf_dir).createOrReplaceTempView("tessera_ub0")
    spark.sql("SELECT UserID, ItemID, CategoryID, BehaviorType, RIGHT(TimeStamp, 10) AS TimeStamp "
              "FROM tessera_ub0").createOrReplaceTempView("tessera_ub1")
    spark.sql("SELECT *, FROM_UNIXTIME(TRY_CAST(TimeStamp AS BIGINT)) AS DateTime FROM tessera_ub1").createOrReplaceTempView("tessera_ub2")
    spark.sql(f"SELECT * FROM tessera_ub2 WHERE DateTime BETWEEN '{CLEAN_RANGE[0]}' AND '{CLEAN_RANGE[1]}'") \
        .createOrReplaceTempView("tessera_ub3")
    return spark.sql("SELECT SUBSTRING(DateTime, 12, 2) AS Hours, count(*) AS n FROM tessera_ub3 GROUP BY 1")


# ---------------------------------------------------------------- review records

def _review_sql(body):
    return fx.with_views(body, "reviews")


_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in
                    ["record_id", "create_time", "apply_time", "created_at", "updated_at", *fx.REVIEW_PAYLOAD])


@register("q_clean_sparse", _review_sql(f"""
  SELECT count(*) AS rows_in, CAST(sum(CASE WHEN {_NULLS} <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS rows_kept,
         count(*) - CAST(sum(CASE WHEN {_NULLS} <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS rows_dropped
  FROM reviews
"""))
def q_clean_sparse(spark, sf_dir):
    return an.sparse_summary(fx.reviews(spark, sf_dir), 3)


@register("q_redundant_columns", _review_sql("""
  SELECT CAST(sum(CASE WHEN split_part(apply_time, ' ', 1) = split_part(create_time, ' ', 1)
                        AND split_part(created_at, ' ', 1) = split_part(updated_at, ' ', 1)
                   THEN 1 ELSE 0 END) AS BIGINT) AS matching,
         count(*) AS rows,
         sum(CASE WHEN split_part(apply_time, ' ', 1) = split_part(create_time, ' ', 1)
                   AND split_part(created_at, ' ', 1) = split_part(updated_at, ' ', 1)
              THEN 1 ELSE 0 END) > count(*) * 0.9 AS drop_pair2
  FROM reviews
"""))
def q_redundant_columns(spark, sf_dir):
    return an.redundant_pairs(fx.reviews(spark, sf_dir))


@register("q_drop_redundant", _review_sql("""
  , decision AS (
    SELECT sum(CASE WHEN split_part(apply_time, ' ', 1) = split_part(create_time, ' ', 1)
                     AND split_part(created_at, ' ', 1) = split_part(updated_at, ' ', 1)
                THEN 1 ELSE 0 END) > count(*) * 0.5 AS redundant FROM reviews)
  SELECT record_id, create_time, apply_time, shop_name,
         CASE WHEN NOT coalesce(redundant, FALSE) THEN created_at END AS created_at,
         CASE WHEN NOT coalesce(redundant, FALSE) THEN updated_at END AS updated_at FROM reviews, decision
"""))
def q_drop_redundant(spark, sf_dir):
    """The records after the conditional drop of a redundant column pair (share 0.5).

    A dropped pair shows as nulls, so that the result has one schema."""
    kept = an.drop_if_redundant(fx.reviews(spark, sf_dir), share=0.5)
    pair = [F.col(c) if c in kept.columns else F.lit(None).cast("string").alias(c) for c in ("created_at", "updated_at")]
    return kept.select("record_id", "create_time", "apply_time", "shop_name", *pair)


_SQL_MINUTES = ("CAST(floor((epoch(date_trunc('minute', strptime(apply_time, '%Y-%m-%d %H:%M:%S'))) - "
                "epoch(date_trunc('minute', strptime(create_time, '%Y-%m-%d %H:%M:%S')))) / 60) AS BIGINT)")


@register("q_avg_processing", _review_sql(
    f"SELECT round(sum({_SQL_MINUTES}) / count({_SQL_MINUTES}), 4) AS avg_minutes FROM reviews"))
def q_avg_processing(spark, sf_dir):
    return an.avg_processing_minutes(fx.reviews(spark, sf_dir))


@register("fn_time_diff", _review_sql(f"SELECT record_id, {_SQL_MINUTES} AS minutes FROM reviews"))
def q_fn_time_diff(spark, sf_dir):
    from tessera.functions import timefmt as tf
    r = fx.reviews(spark, sf_dir)
    return r.select("record_id", tf.minutes_between_truncated("create_time", "apply_time").alias("minutes"))


@register("q_sla_overdue", _review_sql("""
  SELECT CAST(sum(CASE WHEN hour(c) < 18 AND epoch(e) - epoch(c) > 43200 THEN 1 ELSE 0 END) AS BIGINT) AS overdue_before_18,
         CAST(sum(CASE WHEN hour(c) >= 18 AND e >= date_trunc('day', c) + INTERVAL 36 HOUR THEN 1 ELSE 0 END) AS BIGINT) AS overdue_after_18
  FROM (SELECT strptime(create_time, '%Y-%m-%d %H:%M:%S') AS c, strptime(apply_time, '%Y-%m-%d %H:%M:%S') AS e
        FROM reviews) r
"""))
def q_sla_overdue(spark, sf_dir):
    return an.sla_overdue(fx.reviews(spark, sf_dir))
