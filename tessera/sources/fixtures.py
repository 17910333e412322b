"""Stand-in inputs built from the test tables (see FIXTURES.md).

Each view exists twice: a Spark builder (lazy DataFrame over the Parquet
tables, so its work grows with them) and a DuckDB SQL text used by the
oracle.  The two must stay equal row for row.

Sentinels of the original logs (``-1`` / ``"null"``) are SQL NULLs here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load, spread

# ---------------------------------------------------------------------------
# shared column helpers
# ---------------------------------------------------------------------------


def prop_k(props: str = "props") -> Column:
    """``props`` is JSON like ``{"k": 42}``; k drives the synthetic ids."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


SQL_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# Whitespace class understood the same way by Java regex and RE2.
WHITESPACE = r"[ \t\n\r\f\x0B]+"

# Mapping of event types to shopping behaviours (fixed stand-in rule).
BEHAVIOUR_OF_EVENT = {"view": "pv", "click": "pv", "signup": "cart", "error": "fav", "purchase": "buy"}

# Malformed records mixed into the views on purpose, by id: one in so many.
BAD_ACCESS, BAD_CLICK, BAD_SEARCH, BAD_BEHAVIOUR = 97, 83, 50, 89


# ---------------------------------------------------------------------------
# F1 user visit actions
# ---------------------------------------------------------------------------


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    k = prop_k()
    day = F.date_format("ts", "yyyy-MM-dd")
    cats = F.concat_ws(",", (k % 20).cast("string"), ((k + 7) % 20).cast("string"))
    prods = F.concat_ws(",", k.cast("string"), (k + 100).cast("string"))
    t = F.col("event_type")
    return e.select(
        day.alias("action_date"),
        F.col("user_id"),
        F.concat_ws("_", F.col("user_id").cast("string"), day).alias("session_id"),
        (k % 7 + 1).alias("page_id"),
        F.col("event_id").alias("action_id"),
        F.col("ts").alias("action_time"),
        F.when(t == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(t == "click", k % 20).alias("click_category_id"),
        F.when(t == "click", k).alias("click_product_id"),
        F.when(t == "signup", cats).alias("order_category_ids"),
        F.when(t == "signup", prods).alias("order_product_ids"),
        F.when(t == "purchase", cats).alias("pay_category_ids"),
        F.when(t == "purchase", prods).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


SQL_VISITS = f"""
  SELECT strftime(ts, '%Y-%m-%d') AS action_date,
         user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
         {SQL_K} % 7 + 1 AS page_id,
         event_id AS action_id,
         ts AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST({SQL_K} % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN {SQL_K} % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN {SQL_K} END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST({SQL_K} % 20 AS VARCHAR) || ',' || CAST(({SQL_K} + 7) % 20 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST({SQL_K} AS VARCHAR) || ',' || CAST({SQL_K} + 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST({SQL_K} % 20 AS VARCHAR) || ',' || CAST(({SQL_K} + 7) % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST({SQL_K} AS VARCHAR) || ',' || CAST({SQL_K} + 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id
  FROM events
"""


# ---------------------------------------------------------------------------
# F2 product / city dimensions and clicks (star schema over TPC-H tables)
# ---------------------------------------------------------------------------


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city = nation, area = region (25 and 5 rows: bounded, broadcastable)."""
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


SQL_CITY_INFO = """
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def product_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One click per lineitem: (click_product_id, city_id).

    lineitem -> orders (o_custkey) -> customer (c_nationkey).  Both joins
    are key joins on large tables; AQE picks the strategy at runtime.
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    order_city = (o.join(c, o.o_custkey == c.c_custkey)
                  .select("o_orderkey", F.col("c_nationkey").cast("bigint").alias("city_id")))
    return (li.join(order_city, li.l_orderkey == order_city.o_orderkey)
            .select(F.col("l_partkey").alias("click_product_id"), "city_id"))


SQL_PRODUCT_CLICKS = """
  SELECT l_partkey AS click_product_id, CAST(c_nationkey AS BIGINT) AS city_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
"""


# ---------------------------------------------------------------------------
# F3/F4 advertising clicks
# ---------------------------------------------------------------------------


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, ts_ms, day, area, city, user, ad) from ``events``.

    Two users get half of the clicks, all on one ad (a tenth and four tenths
    of the events), so that the black-list threshold is reached."""
    e = load(spark, sf_dir, "events")
    u = F.col("user_id")
    busy = F.when(u % 10 == 0, 1).when(u % 10 < 5, 2)
    return e.select(
        "event_id",
        "ts",
        F.unix_millis("ts").alias("ts_ms"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.concat(F.lit("area"), (u % 3).cast("string")).alias("area"),
        F.concat(F.lit("city"), (F.floor(u / 3) % 3).cast("string")).alias("city"),
        F.coalesce(busy.cast("bigint"), u).alias("user"),
        F.when(busy.isNotNull(), F.lit(1).cast("bigint")).otherwise(prop_k() % 6 + 1).alias("ad"),
    )


SQL_AD_CLICKS = f"""
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, strftime(ts, '%Y-%m-%d') AS day,
         'area' || CAST(user_id % 3 AS VARCHAR) AS area,
         'city' || CAST((user_id // 3) % 3 AS VARCHAR) AS city,
         CASE WHEN user_id % 10 = 0 THEN 1 WHEN user_id % 10 < 5 THEN 2 ELSE user_id END AS "user",
         CASE WHEN user_id % 10 < 5 THEN 1 ELSE {SQL_K} % 6 + 1 END AS ad
  FROM events
"""


def ad_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message text of the click stream: ``epoch_ms area city user ad``
    (with the event time alongside, for replay batching).  One click in
    BAD_CLICK comes with a malformed message beside it."""
    a = ad_clicks(spark, sf_dir)
    text = F.concat_ws(" ", F.col("ts_ms").cast("string"), "area", "city",
                       F.col("user").cast("string"), F.col("ad").cast("string"))
    lines = F.when(F.col("event_id") % BAD_CLICK == 11, F.array(text, F.lit("short message"))).otherwise(F.array(text))
    return a.select("ts", F.explode(lines).alias("value"))


# ---------------------------------------------------------------------------
# F5 web access log
# ---------------------------------------------------------------------------


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ip - - dd/MM/yyyy:HH:mm:ss +0000 GET path`` lines, one per event; one
    event in BAD_ACCESS brings a short line and a line with no real time too."""
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", prop_k().alias("k"))
    p = load(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1).alias("path"))
    j = e.join(p, e.k == p.page_id, "left")
    path = F.when(F.col("path").isNull() | (F.col("path") == ""), F.lit("/")).otherwise(F.col("path"))
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")),
        F.lit("-"), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"), path)
    bad = F.array(line, F.lit(BAD_LINES[0]), F.lit(BAD_LINES[1]))
    return j.select(F.col("event_id").alias("line_id"), F.explode(
        F.when(F.col("event_id") % BAD_ACCESS == 5, bad).otherwise(F.array(line))).alias("value"))


BAD_LINES = ("short line", "10.0.0.1 - - 99/99/2024:10:00:00 +0000 GET /en/bad")

SQL_ACCESS_LOG = f"""
  SELECT line_id, unnest(CASE WHEN line_id % {BAD_ACCESS} = 5 THEN [value, '{BAD_LINES[0]}', '{BAD_LINES[1]}']
                              ELSE [value] END) AS value FROM (
  SELECT event_id AS line_id,
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR)
         || ' - - ' || strftime(ts, '%d/%m/%Y:%H:%M:%S') || ' +0000 GET '
         || CASE WHEN p.path IS NULL OR p.path = '' THEN '/' ELSE p.path END AS value
  FROM events e
  LEFT JOIN (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages) p
    ON {SQL_K.replace('props', 'e.props')} = p.page_id) lines
"""


# ---------------------------------------------------------------------------
# F6 search query log
# ---------------------------------------------------------------------------


def search_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw log line per document: ``HH:mm:ss user [words] rank click host/path``.

    The query words are the whole document text joined by ``+``; hosts
    without a ``m.``/``blog.`` sub-domain are written as ``www.`` hosts.  Every
    document meets an event and a page (its id modulo their number).  One
    document in BAD_SEARCH brings a second, malformed line that the parser
    must drop.
    """
    d = spread(load(spark, sf_dir, "documents").select("doc_id", "text"))
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", prop_k().alias("k"))
    p = load(spark, sf_dir, "pages").select("page_id", "url")
    n_events, n_pages = e.agg(F.count("*")).scalar(), p.agg(F.count("*")).scalar()
    d = d.withColumn("of_event", F.col("doc_id") % n_events).withColumn("of_page", F.col("doc_id") % n_pages)
    j = (d.join(e, d.of_event == e.event_id, "left")
          .join(p, d.of_page == p.page_id, "left"))
    words = F.regexp_replace(F.col("text"), WHITESPACE, "+")
    line = F.concat_ws(
        " ",
        F.date_format("ts", "HH:mm:ss"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.concat(F.lit("["), words, F.lit("]")),
        (F.col("k") % 5 + 1).cast("string"),
        (F.col("k") % 3 + 1).cast("string"),
        F.when(F.regexp_replace("url", r"^[a-z]+://", "").rlike(r"^(m|blog)\."),
               F.regexp_replace("url", r"^[a-z]+://", ""))
         .otherwise(F.concat(F.lit("www."), F.regexp_replace("url", r"^[a-z]+://", ""))),
    )
    return j.select(F.col("doc_id").alias("line_id"), F.explode(F.when(
        F.col("doc_id") % BAD_SEARCH == 13, F.array(line, F.lit("bad line"))).otherwise(F.array(line))).alias("value"))


SQL_SEARCH_LINES = f"""
  SELECT line_id, unnest(CASE WHEN line_id % {BAD_SEARCH} = 13 THEN [value, 'bad line'] ELSE [value] END) AS value FROM (
  SELECT d.doc_id AS line_id,
         concat_ws(' ',
           strftime(e.ts, '%H:%M:%S'),
           'u' || CAST(e.user_id AS VARCHAR),
           '[' || regexp_replace(d.text, '{WHITESPACE}', '+', 'g') || ']',
           CAST(e.k % 5 + 1 AS VARCHAR),
           CAST(e.k % 3 + 1 AS VARCHAR),
           CASE WHEN regexp_matches(regexp_replace(p.url, '^[a-z]+://', ''), '^(m|blog)\\.')
                THEN regexp_replace(p.url, '^[a-z]+://', '')
                ELSE 'www.' || regexp_replace(p.url, '^[a-z]+://', '') END) AS value
  FROM documents d
  LEFT JOIN (SELECT event_id, ts, user_id, {SQL_K} AS k FROM events) e
    ON d.doc_id % (SELECT count(*) FROM events) = e.event_id
  LEFT JOIN pages p ON d.doc_id % (SELECT count(*) FROM pages) = p.page_id) lines
"""


# ---------------------------------------------------------------------------
# F7 shopping behaviour log
# ---------------------------------------------------------------------------


def behaviour_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string CSV-like rows: UserID, ItemID, CategoryID, BehaviorType, TimeStamp,
    one per event; one in BAD_BEHAVIOUR has no real time stamp."""
    e = load(spark, sf_dir, "events")
    k = prop_k()
    mapping = F.create_map(*[F.lit(x) for kv in BEHAVIOUR_OF_EVENT.items() for x in kv])
    return e.select(F.col("user_id").cast("string").alias("UserID"),
                    k.cast("string").alias("ItemID"),
                    (k % 10).cast("string").alias("CategoryID"),
                    mapping[F.col("event_type")].alias("BehaviorType"),
                    F.when(F.col("event_id") % BAD_BEHAVIOUR == 3, F.lit("n/a")).otherwise(
                        F.concat(F.lit("t"), F.unix_timestamp("ts").cast("string"))).alias("TimeStamp"))


SQL_BEHAVIOUR_RAW = f"""
  SELECT CAST(user_id AS VARCHAR) AS UserID,
         CAST({SQL_K} AS VARCHAR) AS ItemID,
         CAST({SQL_K} % 10 AS VARCHAR) AS CategoryID,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'pv' WHEN 'signup' THEN 'cart'
                         WHEN 'error' THEN 'fav' WHEN 'purchase' THEN 'buy' END AS BehaviorType,
         CASE WHEN event_id % {BAD_BEHAVIOUR} = 3 THEN 'n/a'
              ELSE 't' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS TimeStamp
  FROM events
"""


# ---------------------------------------------------------------------------
# F8 review records
# ---------------------------------------------------------------------------

REVIEW_PAYLOAD = ("shop_name", "shop_type", "district", "contact", "phone",
                  "address", "scope", "remark")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide review records with text times and sparse payload columns.

    create_time = ts, apply_time = ts + value*10 minutes; created_at equals
    create_time and updated_at is apply_time, except that every 7th record
    moves its pair onto another day.  Payload column i is missing when
    ``k % (i + 2) == 0``.
    """
    e = load(spark, sf_dir, "events")
    k = prop_k()
    fmt = "yyyy-MM-dd HH:mm:ss"
    applied = F.timestamp_seconds(F.unix_timestamp("ts") + F.floor(F.col("value") * 600))
    shifted = F.col("event_id") % 7 == 0
    cols = [F.col("event_id").alias("record_id"),
            F.date_format("ts", fmt).alias("create_time"),
            F.date_format(applied, fmt).alias("apply_time"),
            F.date_format(F.when(shifted, F.col("ts") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")), fmt)
             .alias("created_at"),
            F.date_format(applied, fmt).alias("updated_at")]
    for i, name in enumerate(REVIEW_PAYLOAD):
        cols.append(F.when(k % (i + 2) != 0, F.concat(F.lit(name + "_"), k.cast("string"))).alias(name))
    return e.select(*cols)


def _sql_reviews() -> str:
    applied = "(date_trunc('second', ts) + to_seconds(CAST(floor(value * 600) AS BIGINT)))"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    payload = ",\n         ".join(
        f"CASE WHEN {SQL_K} % {i + 2} <> 0 THEN '{name}_' || CAST({SQL_K} AS VARCHAR) END AS {name}"
        for i, name in enumerate(REVIEW_PAYLOAD))
    return f"""
  SELECT event_id AS record_id,
         strftime(ts, {fmt}) AS create_time,
         strftime({applied}, {fmt}) AS apply_time,
         strftime(CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 1 DAY ELSE ts END, {fmt}) AS created_at,
         strftime({applied}, {fmt}) AS updated_at,
         {payload}
  FROM events
"""


SQL_REVIEWS = _sql_reviews()


# ---------------------------------------------------------------------------
# F9 users, F10 words
# ---------------------------------------------------------------------------


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, username, age) from ``customer``: age = custkey % 60 + 18."""
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
                    (F.col("c_custkey") % 60 + 18).alias("age"))


SQL_USERS = "SELECT c_custkey AS id, c_name AS username, c_custkey % 60 + 18 AS age FROM customer"


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as the text to count words in."""
    return spread(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("line_id"),
                                                          F.col("text").alias("value")))


SQL_DOCUMENT_LINES = "SELECT doc_id AS line_id, text AS value FROM documents"


# ---------------------------------------------------------------------------
# oracle helper
# ---------------------------------------------------------------------------

SQL_VIEWS = {
    "visits": SQL_VISITS,
    "city_info": SQL_CITY_INFO,
    "product_clicks": SQL_PRODUCT_CLICKS,
    "ad_clicks": SQL_AD_CLICKS,
    "access_log": SQL_ACCESS_LOG,
    "search_lines": SQL_SEARCH_LINES,
    "behaviour_raw": SQL_BEHAVIOUR_RAW,
    "reviews": SQL_REVIEWS,
    "users": SQL_USERS,
    "document_lines": SQL_DOCUMENT_LINES,
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with ``WITH`` clauses for the named stand-in views."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
