"""Readers for the original log formats (FIXTURES F1-F9).

Each returns the columns the analyses in ``tessera.plans.analyses`` take,
so a user's own files run through the same plans as the stand-in views.
Sentinels of the original logs (``-1`` for "no category/product",
``null`` for "no order/pay") become SQL NULL; numbers that do not parse
become NULL too (``try_cast``), and lines with the wrong field count are
dropped.  All readers are plain distributed text/CSV/JSON scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field order of the visit log (separator "_").
VISIT_FIELDS = ("date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
                "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
                "pay_category_ids", "pay_product_ids", "city_id")

# Original column names of the review records and our names.
REVIEW_COLUMNS = {"创建时间": "create_time", "申请时间": "apply_time"}


def _nullify(c: Column, *sentinels: str) -> Column:
    return F.when(c.isin(*sentinels), F.lit(None)).otherwise(c)


def _line_id(col: str = "value") -> Column:
    """Deterministic id of a line (tie-break where the log has none)."""
    return F.xxhash64(F.col(col))


def read_user_visit_actions(spark: SparkSession, path: str, sep: str = "_") -> DataFrame:
    """``date_user_session_page_time_keyword_ccat_cprod_ocats_oprods_pcats_pprods_city``."""
    f = F.split(F.col("value"), sep)
    d = spark.read.text(path).where(F.size(f) == len(VISIT_FIELDS))
    g = {name: f.getItem(i) for i, name in enumerate(VISIT_FIELDS)}
    return d.select(
        g["date"].alias("action_date"),
        g["user_id"].try_cast("bigint").alias("user_id"),
        g["session_id"].alias("session_id"),
        g["page_id"].try_cast("bigint").alias("page_id"),
        _line_id().alias("action_id"),
        F.try_to_timestamp(g["action_time"]).alias("action_time"),
        _nullify(g["search_keyword"], "null", "").alias("search_keyword"),
        _nullify(g["click_category_id"], "-1").try_cast("bigint").alias("click_category_id"),
        _nullify(g["click_product_id"], "-1").try_cast("bigint").alias("click_product_id"),
        _nullify(g["order_category_ids"], "null").alias("order_category_ids"),
        _nullify(g["order_product_ids"], "null").alias("order_product_ids"),
        _nullify(g["pay_category_ids"], "null").alias("pay_category_ids"),
        _nullify(g["pay_product_ids"], "null").alias("pay_product_ids"),
        g["city_id"].try_cast("bigint").alias("city_id"),
    )


def read_product_info(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """F2 products: ``product_id, product_name, extend_info``."""
    return spark.read.schema("product_id bigint, product_name string, extend_info string") \
        .option("sep", sep).csv(path)


def read_city_info(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """F2 cities: ``city_id, city_name, area``."""
    return spark.read.schema("city_id bigint, city_name string, area string").option("sep", sep).csv(path)


def clicks_of_visits(visits: DataFrame) -> DataFrame:
    """Product clicks of the visit log, shaped for ``area_top3``."""
    return visits.where(F.col("click_product_id").isNotNull()).select("click_product_id", "city_id")


def read_agent_log(spark: SparkSession, path: str) -> DataFrame:
    """``timestamp province city user ad`` (space separated)."""
    f = F.split(F.col("value"), " ")
    d = spark.read.text(path).where(F.size(f) == 5)
    return d.select(f.getItem(0).try_cast("bigint").alias("ts_ms"), f.getItem(1).alias("area"),
                    f.getItem(2).alias("city"), f.getItem(3).alias("user"), f.getItem(4).alias("ad"))


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """raw access-log lines as (line_id, value) for ``log_hourly`` etc."""
    return spark.read.text(path).select(_line_id().alias("line_id"), "value")


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    """raw search-log lines (``value``); parse with ``parse_search``,
    and keep all of them for ``search_best_rank``'s denominator."""
    return spark.read.text(path)


def read_behaviour_csv(spark: SparkSession, path: str) -> DataFrame:
    """header-less CSV, all strings, original column names."""
    return spark.read.csv(path).toDF("UserID", "ItemID", "CategoryID", "BehaviorType", "TimeStamp")


def read_review_records(spark: SparkSession, path: str) -> DataFrame:
    """F8: JSON review records, time columns renamed to our names."""
    df = spark.read.json(path)
    for old, new in REVIEW_COLUMNS.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{username, age}``."""
    return spark.read.schema("username string, age bigint").json(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """plain text lines for ``word_count``."""
    return spark.read.text(path)


def read_click_messages(spark: SparkSession, path: str) -> DataFrame:
    """F4 as files: ``epoch_ms area city user ad`` lines (``value``)."""
    return spark.read.text(path)

