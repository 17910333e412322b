"""End-user analyses as DataFrame plans.

Each function takes already-loaded input DataFrames (the stand-in views of
``tessera.sources.fixtures`` or real logs of the same shape) and returns a
lazy DataFrame.  Aggregations are partial (map-side), top-n cuts run as
WindowGroupLimit / TakeOrderedAndProject, and the only broadcasts are of
sides with a bound fixed by the plan (page list, region/nation, a limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import timefmt as tf
from tessera.operators import topk
from tessera.operators.windows import next_in_group

# ----------------------------------------------------------------------------- words


def word_count(lines: DataFrame, col: str = "value", sep: str = " ", ordered: bool = False) -> DataFrame:
    """Split on ``sep``, count every piece.  ``ordered`` sorts by count
    (descending) as the original output was; it is a global sort over the
    whole vocabulary, so it is left to callers that need it."""
    w = lines.select(F.explode(F.split(F.col(col), sep)).alias("word"))
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "word") if ordered else counts


# ----------------------------------------------------------------------------- ads (batch)


def province_top_ads(clicks: DataFrame, n: int = 3) -> DataFrame:
    """Clicks per (province, ad); the n most clicked ads per province."""
    c = clicks.groupBy(F.col("area").alias("province"), "ad").agg(F.count(F.lit(1)).alias("clicks"))
    return topk.top_n_per_group(c, ["province"], [F.desc("clicks"), F.asc("ad")], n, rank_col="rn")


# ----------------------------------------------------------------------------- access log


def access_records(log: DataFrame) -> DataFrame:
    """(line_id, ip, time_text, path) of the lines with all fields; others are dropped."""
    f = log.select("line_id", F.split("value", " ").alias("f")).where(F.size("f") >= 7)
    return f.select("line_id", F.get("f", F.lit(0)).alias("ip"), F.get("f", F.lit(3)).alias("time_text"),
                    F.get("f", F.lit(6)).alias("path"))


def log_hourly(log: DataFrame) -> DataFrame:
    """Requests per hour of the day; lines without a real time are dropped."""
    r = access_records(log).select(
        F.date_format(tf.parse_access_time("time_text"), "HH").alias("hour")).where("hour is not null")
    return r.groupBy("hour").agg(F.count(F.lit(1)).alias("requests"))


def log_day_paths(log: DataFrame, day_prefix: str) -> DataFrame:
    """Paths requested on one day (date field starts with ``day_prefix``)."""
    r = access_records(log).where(F.col("time_text").startswith(day_prefix))
    return r.groupBy("path").agg(F.count(F.lit(1)).alias("hits"))


# ----------------------------------------------------------------------------- page flow


# The page list whose consecutive jumps are measured.
PAGE_LIST = (1, 2, 3, 4, 5, 6, 7)


def page_flow(visits: DataFrame, pages: Sequence[int] = PAGE_LIST,
              split: str = "range") -> DataFrame:
    """Single-jump conversion rates along ``pages``.

    jumps(a -> b) counts, within a session ordered by (time, id), a visit of
    a directly followed by b, for the consecutive pairs of ``pages``;
    visits(a) counts all visits of a for every page but the last.  Pairs
    that never occur give no row.  The successor is found with the
    two-level ``next_in_group`` so a huge session is not one task; the
    rest is one partial aggregation over at most len(pages) keys.
    """
    pages = list(pages)
    expected = F.create_map(*[F.lit(x) for a, b in zip(pages, pages[1:]) for x in (a, b)])
    v = visits.select("session_id", "action_time", "action_id", "page_id")
    nxt = next_in_group(v, ["session_id"], "action_time", "action_id", "page_id", "next_page", split=split)
    # every page but the last has exactly one allowed successor, so one
    # grouped pass gives both the visits of a and the jumps a -> next(a)
    g = (nxt.where(F.col("page_id").isin(pages[:-1]))
            .groupBy(F.col("page_id").alias("from_page"))
            .agg(F.count(F.lit(1)).alias("visits"),
                 F.sum(F.when(F.col("next_page") == expected[F.col("page_id")], 1).otherwise(0))
                  .cast("bigint").alias("jumps")))
    return g.where(F.col("jumps") > 0).select(
        "from_page", expected[F.col("from_page")].cast("bigint").alias("to_page"), "jumps", "visits",
        F.round(F.col("jumps").cast("double") / F.col("visits"), 4).alias("rate"))


# ----------------------------------------------------------------------------- area top 3


def area_product_city_counts(clicks: DataFrame, city_info: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per (area, product_name, city_name).

    Counts are pre-aggregated per (city_id, product_id) before any join, so
    the joins see at most one row per city and product instead of one per
    click.  AQE picks the joins' strategy by the dimensions' sizes.
    """
    pre = clicks.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("cnt"))
    with_city = pre.join(city_info, "city_id")
    named = with_city.join(products, with_city.click_product_id == products.product_id)
    return named.groupBy("area", "product_name", "city_name").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def area_top3(clicks: DataFrame, city_info: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """``rank() over (partition by area order by clickCnt desc) <= n`` (ties kept)."""
    pre = clicks.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("cnt"))
    with_area = pre.join(city_info.select("city_id", "area"), "city_id")
    per_product = with_area.groupBy("area", "click_product_id").agg(F.sum("cnt").alias("cnt"))
    named = per_product.join(products, per_product.click_product_id == products.product_id)
    t2 = named.groupBy("area", "product_name").agg(F.sum("cnt").cast("bigint").alias("click_cnt"))
    return topk.rank_top(t2, ["area"], [F.desc("click_cnt")], n, rank_col="rank")


# Fixed value: label of the remainder in the city remark.
OTHER_LABEL = "其他"


def city_remark(city_counts: DataFrame, keys: Sequence[str], city: str = "city_name",
                cnt: str = "cnt") -> DataFrame:
    """Per group: top-2 cities as ``name pct%`` plus ``other pct%`` if more
    than two cities, joined by ", ".  pct = cnt*100 div total; other = 100
    minus the shown pcts.  Equal counts are ordered by city name.

    Built-ins only: the per-group window runs over (group, city) counts,
    i.e. at most one row per city, and only two rows per group survive.
    """
    g = Window.partitionBy(*keys)
    ranked = city_counts.select(
        *keys, city, cnt,
        F.sum(cnt).over(g).alias("__total"),
        F.count(F.lit(1)).over(g).alias("__ncity"),
        F.row_number().over(g.orderBy(F.desc(cnt), F.asc(city))).alias("__rn"))
    top = ranked.where(F.col("__rn") <= 2).withColumn(
        "__pct", F.expr(f"{cnt} * 100 div __total"))
    item = F.concat(F.col(city), F.lit(" "), F.col("__pct").cast("string"), F.lit("%"))
    agg = top.groupBy(*keys).agg(
        F.max(F.when(F.col("__rn") == 1, item)).alias("__c1"),
        F.max(F.when(F.col("__rn") == 2, item)).alias("__c2"),
        F.sum("__pct").alias("__shown"),
        F.max("__ncity").alias("__ncity"),
        F.max("__total").cast("bigint").alias("click_cnt"))
    other = F.when(F.col("__ncity") > 2,
                   F.concat(F.lit(OTHER_LABEL + " "), (F.lit(100) - F.col("__shown")).cast("string"), F.lit("%")))
    return agg.select(*keys, "click_cnt", F.concat_ws(", ", "__c1", "__c2", other).alias("city_remark"))


def area_top3_remark(clicks: DataFrame, city_info: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """The areas' top products with their city remark, which is built for those only."""
    counts = area_product_city_counts(clicks, city_info, products)
    totals = counts.groupBy("area", "product_name").agg(F.sum("cnt").cast("bigint").alias("total"))
    top = topk.rank_top(totals, ["area"], [F.desc("total")], n, rank_col="rank").select("area", "product_name", "rank")
    remark = city_remark(counts.join(top, ["area", "product_name"]), ["area", "product_name", "rank"])
    return remark.select("area", "product_name", "click_cnt", "city_remark", "rank")


# ----------------------------------------------------------------------------- search log


def parse_search(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines with exactly 6 whitespace-separated fields -> typed records
    (ranks that are not numbers become NULL instead of failing the job)."""
    f = lines.where(F.col(col).isNotNull()).select(tx.fields(F.col(col)).alias("f"))
    f = f.where(F.size("f") == 6)
    return f.select(F.col("f").getItem(0).alias("query_time"),
                    F.col("f").getItem(1).alias("user_id"),
                    tx.strip_brackets(F.col("f").getItem(2)).alias("query_words"),
                    F.col("f").getItem(3).try_cast("int").alias("result_rank"),
                    F.col("f").getItem(4).try_cast("int").alias("click_rank"),
                    F.col("f").getItem(5).alias("click_url"))


def search_url(records: DataFrame, ordered: bool = False) -> DataFrame:
    """Hits per host for URLs beginning with ``www``; ``ordered`` as in ``word_count``."""
    r = records.where(F.substring("click_url", 1, 3) == "www")
    counts = r.groupBy(tx.text_before("click_url", "/").alias("host")).agg(F.count(F.lit(1)).alias("hits"))
    return counts.orderBy(F.desc("hits"), "host") if ordered else counts


def search_rank(records: DataFrame) -> DataFrame:
    return (records.groupBy("result_rank").agg(F.count(F.lit(1)).alias("clicks"))
                   .orderBy(F.desc("clicks"), "result_rank"))


def search_keywords(records: DataFrame, ordered: bool = False, tokenizer=None) -> DataFrame:
    """Word frequency of the queries; ``ordered`` as in ``word_count``, ``tokenizer``
    as in ``explode_tokens``."""
    counts = tx.explode_tokens(records, "query_words", tokenizer=tokenizer).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "word") if ordered else counts


def search_user_query_pairs(records: DataFrame, ordered: bool = False) -> DataFrame:
    """Visits per (user, query).  Queries are grouped by their 256-bit digest, so a
    task sends each text once; ``ordered`` sorts by count, descending."""
    per = (records.groupBy("user_id", F.sha2("query_words", 256).alias("digest"))
           .agg(F.count(F.lit(1)).alias("n"), F.any_value("query_words").alias("query_words"))
           .select("user_id", "query_words", "n"))
    return per.orderBy(F.desc("n"), "user_id", "query_words") if ordered else per


def search_user_query(records: DataFrame) -> DataFrame:
    """Visits per (user, query) summarised as max / min / mean and #pairs."""
    per = records.groupBy("user_id", F.sha2("query_words", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("max_count"), F.min("n").alias("min_count"),
                   F.round(F.avg("n"), 4).alias("mean_count"), F.count(F.lit(1)).alias("pairs"))


def search_best_rank(lines: DataFrame, col: str = "value") -> DataFrame:
    """100 * (records with click and result rank 1) / (all raw lines)."""
    f = lines.select(F.col(col).isNotNull().alias("ok"), tx.fields(F.col(col)).alias("f"))
    parsed = F.col("ok") & (F.size("f") == 6)
    best = parsed & (F.col("f").getItem(4).try_cast("int") == 1) & (F.col("f").getItem(3).try_cast("int") == 1)
    a = f.agg(F.sum(F.when(best, 1).otherwise(0)).cast("bigint").alias("best"),
              F.count(F.lit(1)).alias("lines"))
    return a.select("best", "lines", F.round(F.try_divide(F.col("best") * 100.0, F.col("lines")), 4).alias("rate"))


def search_hourly(records: DataFrame) -> DataFrame:
    return records.groupBy(F.substring("query_time", 1, 2).alias("hour")).agg(
        F.count(F.lit(1)).alias("searches")).orderBy("hour")


# ----------------------------------------------------------------------------- shopping behaviour

# Behaviour types of the shopping log, in their original order.
BEHAVIOURS = ("pv", "cart", "fav", "buy")


def clean_behaviour(raw: DataFrame, low: str, high: str) -> DataFrame:
    """Last 10 chars of TimeStamp -> DateTime -> inclusive range -> Dates, Hours."""
    t = raw.select("UserID", "ItemID", "CategoryID", "BehaviorType",
                   F.expr("right(TimeStamp, 10)").alias("TimeStamp"))
    t = t.withColumn("DateTime", tf.epoch_seconds_text("TimeStamp"))
    t = t.where(F.col("DateTime").between(low, high))
    return t.select("*", F.substring("DateTime", 1, 10).alias("Dates"),
                    F.substring("DateTime", 12, 2).alias("Hours"))


def behaviour_totals(clean: DataFrame) -> DataFrame:
    return clean.agg(F.countDistinct("UserID").alias("users"), F.countDistinct("ItemID").alias("items"),
                     F.countDistinct("CategoryID").alias("categories"), F.count(F.lit(1)).alias("actions"))


def _behaviour_sums():
    return [F.sum(F.when(F.col("BehaviorType") == b, 1).otherwise(0)).cast("bigint").alias(b)
            for b in BEHAVIOURS]


def daily_conversion(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("Dates").agg(
        F.countDistinct("UserID").alias("uv"),
        F.sum(F.when(F.col("BehaviorType") == "pv", 1).otherwise(0)).cast("bigint").alias("pv"),
        F.sum(F.when(F.col("BehaviorType") == "buy", 1).otherwise(0)).cast("bigint").alias("buy"))
    return g.withColumn("conversion", F.round(F.col("buy") / F.col("uv"), 4)).orderBy("Dates")


def funnel_total(clean: DataFrame) -> DataFrame:
    return clean.agg(*_behaviour_sums())


def funnel_by(clean: DataFrame, key: str) -> DataFrame:
    return clean.groupBy(key).agg(F.countDistinct("UserID").alias("users"), *_behaviour_sums()).orderBy(key)


def item_top10(clean: DataFrame, n: int = 10) -> DataFrame:
    """For each behaviour: the n items with most actions (ties by item id)."""
    c = clean.groupBy("BehaviorType", "ItemID").agg(F.count("BehaviorType").alias("times"))
    return topk.top_n_per_group(c, ["BehaviorType"], [F.desc("times"), F.asc("ItemID")], n, rank_col="rn")


def repurchase_histogram(clean: DataFrame) -> DataFrame:
    per_item = clean.where(F.col("BehaviorType") == "buy").groupBy("ItemID").agg(
        F.count("BehaviorType").alias("buys"))
    return per_item.groupBy("buys").agg(F.count("ItemID").alias("items")).orderBy(F.desc("items"), "buys")


# ----------------------------------------------------------------------------- review records


def sparse_summary(records: DataFrame, max_missing: int = 3) -> DataFrame:
    """Rows in, rows kept (at most ``max_missing`` nulls), rows dropped."""
    from tessera.operators.relational import null_count
    nulls = null_count(records.columns)
    a = records.agg(F.count(F.lit(1)).alias("rows_in"),
                    F.sum(F.when(nulls <= max_missing, 1).otherwise(0)).cast("bigint").alias("rows_kept"))
    return a.withColumn("rows_dropped", F.col("rows_in") - F.col("rows_kept"))


def redundant_pairs(records: DataFrame, pair1=("apply_time", "create_time"),
                    pair2=("created_at", "updated_at"), share: float = 0.9) -> DataFrame:
    """Rows where both column pairs agree by day; decide whether pair 2 is
    redundant (matching rows > share * all rows)."""
    day = lambda c: tx.text_before(c, " ")
    both = (day(pair1[0]) == day(pair1[1])) & (day(pair2[0]) == day(pair2[1]))
    a = records.agg(F.sum(F.when(both, 1).otherwise(0)).cast("bigint").alias("matching"),
                    F.count(F.lit(1)).alias("rows"))
    return a.withColumn("drop_pair2", F.col("matching") > F.col("rows") * share)


def drop_if_redundant(records: DataFrame, pair2=("created_at", "updated_at"), share: float = 0.9) -> DataFrame:
    """Apply the decision: one scalar aggregate, then a conditional drop."""
    decision = redundant_pairs(records, pair2=pair2, share=share).first()
    return records.drop(*pair2) if decision["drop_pair2"] else records


def avg_processing_minutes(records: DataFrame, start="create_time", end="apply_time") -> DataFrame:
    m = tf.minutes_between_truncated(start, end)
    return records.agg(F.round(F.sum(m) / F.count(m), 4).alias("avg_minutes"))


def sla_overdue(records: DataFrame, start="create_time", end="apply_time") -> DataFrame:
    """Filed before 18:00: overdue when processing takes more than 12 h.
    Filed at/after 18:00: overdue when reviewed at or after 12:00 next day."""
    c = F.try_to_timestamp(F.col(start), F.lit(tf.DATETIME))
    e = F.try_to_timestamp(F.col(end), F.lit(tf.DATETIME))
    early = F.hour(c) < 18
    late_overdue = e >= F.date_trunc("day", c) + F.expr("INTERVAL 36 HOURS")
    early_overdue = (F.unix_seconds(e) - F.unix_seconds(c)) > 12 * 3600
    return records.agg(
        F.sum(F.when(early & early_overdue, 1).otherwise(0)).cast("bigint").alias("overdue_before_18"),
        F.sum(F.when(~early & late_overdue, 1).otherwise(0)).cast("bigint").alias("overdue_after_18"))
