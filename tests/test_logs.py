"""The analyses on files in the original log formats."""

import os

from conftest import rows
from tessera.plans import analyses as an
from tessera.session import work_dir
from tessera.sources import logs


def _write(spark, name, lines):
    d = work_dir(spark, name).replace("file:", "")
    os.makedirs(d, exist_ok=True)
    with open(d + "/part-0", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return d


VISITS = [
    "2024-02-03_21_s1_1_2024-02-03 00:00:02_phone_-1_-1_null_null_null_null_3",
    "2024-02-03_21_s1_2_2024-02-03 00:00:10_null_16_98_null_null_null_null_19",
    "2024-02-03_21_s1_3_2024-02-03 00:00:19_null_-1_-1_15,1_15,88_null_null_7",
    "2024-02-03_22_s2_1_2024-02-03 00:01:00_null_16_98_null_null_null_null_3",
    "2024-02-03_22_s2_2_2024-02-03 00:01:05_null_-1_-1_null_null_16,1_98,7_3",
    "2024-02-03_22_s2_3_2024-02-03 00:01:09_null_1_7_null_null_null_null_3",
    "malformed_line",
]


def test_bad_values_become_null_or_leave(spark):
    """One bad line for each parser: a short line, a bad time, a bad number."""
    from tessera.plans.hot_categories import category_counts
    bad = ["2024-02-03_x_s9_y_no time_null_-1_-1_15,,abc,_null_null_null_z"]
    v = logs.read_user_visit_actions(spark, _write(spark, "bad-visits", bad))
    r = v.first()
    assert (r["user_id"], r["page_id"], r["action_time"], r["city_id"]) == (None, None, None, None)
    assert rows(category_counts(v)) == [(15, 0, 1, 0)]
    raw = spark.createDataFrame([("u", "i", "c", "pv", "n/a"), ("u", "i", "c", "pv", None), ("u", "i", "c", "pv", "t1704103200")],
                                "UserID string, ItemID string, CategoryID string, BehaviorType string, TimeStamp string")
    assert an.clean_behaviour(raw, "2024-01-01 00:00:00", "2024-02-01 00:00:00").count() == 1
    rec = spark.createDataFrame([("no", "2024-01-01 10:00:00"), ("2024-01-01 10:00:00", "2024-01-01 10:30:00")],
                                "create_time string, apply_time string")
    assert an.avg_processing_minutes(rec).first()[0] == 30.0


def test_pluggable_tokenizer(spark):
    from pyspark.sql import functions as F
    from tessera.functions import text as tx
    df = spark.createDataFrame([("ab cd",), ("",), (None,)], "q string")
    got = tx.explode_tokens(df, "q", tokenizer=lambda c: F.split(c, ""))
    assert sorted(r[0] for r in got.collect()) == [" ", "a", "b", "c", "d"]


def test_visit_log_runs_hot_categories_and_page_flow(spark):
    v = logs.read_user_visit_actions(spark, _write(spark, "visits", VISITS))
    assert v.count() == 6
    from tessera.plans.hot_categories import category_counts
    hot = rows(category_counts(v))
    assert hot == [(1, 1, 1, 1), (15, 0, 1, 0), (16, 2, 0, 1)]
    flow = rows(an.page_flow(v, split="time"), "from_page", "to_page", "jumps", "visits")
    assert flow == [(1, 2, 2, 2), (2, 3, 2, 2)]


def test_dimension_files_run_area_top3(spark):
    v = logs.read_user_visit_actions(spark, _write(spark, "visits2", VISITS))
    prod = logs.read_product_info(spark, _write(spark, "prod", ["98\tphone\tself", "7\tbook\tthird"]))
    city = logs.read_city_info(spark, _write(spark, "city", ["3\tbeijing\tnorth", "19\tshanghai\teast"]))
    got = rows(an.area_top3_remark(logs.clicks_of_visits(v), city, prod), "area", "product_name", "click_cnt",
               "city_remark")
    assert got == [("east", "phone", 1, "shanghai 100%"), ("north", "book", 1, "beijing 100%"),
                   ("north", "phone", 1, "beijing 100%")]


def test_agent_access_search_behaviour_review_files(spark):
    agent = logs.read_agent_log(spark, _write(spark, "agent", [
        "1704103200000 6 7 64 16", "1704103201000 6 4 7 16", "1704103202000 9 7 16 12"]))
    assert rows(an.province_top_ads(agent), "province", "ad", "clicks") == [("6", "16", 2), ("9", "12", 1)]
    access = logs.read_access_log(spark, _write(spark, "apache", [
        "192.0.2.7 - - 03/02/2024:10:15:30 +0000 GET /shop/list.html",
        "192.0.2.9 - - 03/02/2024:11:00:01 +0000 GET /shop/cart.js",
        "192.0.2.9 - - 33/22/2024:11:00:01 +0000 GET /shop/bad-time", "too short"]))
    assert rows(an.log_hourly(access)) == [("10", 1), ("11", 1)]
    search = logs.read_search_log(spark, _write(spark, "search", [
        "08:00:00 u17 [天气预报] 8 3 files.example.net/a/b.html",
        "08:00:01 u18 [火车时刻] 1 1 www.example.net/c/1.html",
        "bad line"]))
    assert rows(an.search_url(an.parse_search(search))) == [("www.example.net", 1)]
    best = an.search_best_rank(search).first()
    assert (best["best"], best["lines"]) == (1, 3)
    beh = logs.read_behaviour_csv(spark, _write(spark, "beh", [
        "1,501,31,pv,1511800000", "1,502,32,buy,1511900000", "2,503,33,pv,n/a"]))
    clean = an.clean_behaviour(beh, "2017-11-25 00:00:00", "2017-12-04 00:00:00")
    assert rows(an.funnel_total(clean)) == [(1, 0, 0, 1)]
    rev = logs.read_review_records(spark, _write(spark, "rev", [
        '{"创建时间": "2024-01-01 08:00:00", "申请时间": "2024-01-01 21:00:00"}',
        '{"创建时间": "2024-01-01 19:00:00", "申请时间": "2024-01-02 09:00:00"}',
        '{"创建时间": "no time", "申请时间": "2024-01-02 09:00:00"}']))
    r = an.sla_overdue(rev).first()
    assert (r["overdue_before_18"], r["overdue_after_18"]) == (1, 0)
