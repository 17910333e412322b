import random

from helpers import SF

from tessera.llm import queries, url_rules

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules, default="allow"):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate(ASCII), rest[cut:]
        path = rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(h.count("."), len(p), v == "block", h + p, v) for h, p, v in rules
            if h and v and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", 1, "k") for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, reach int, key string")


def test_random_rules_equal_brute_force(spark):
    rng = random.Random(9)
    labels = ["a", "b", "org", "x-y", "é", "ab", ""]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/é"]
    rules = list(dict.fromkeys((rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)))
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts).upper() if rng.random() < .3 else rng.choice(hosts)}"
            f"{rng.choice(paths)}{rng.choice(['', '?q=/a', '#f', '/c?x#y'])}" for _ in range(600)]
    urls += [None, "", "no scheme", "a://", "http://org", "x://y://org/a", "http://org:80/a", "http://a\nb.org/\n/x", "://org/"]
    urls += ["http://hot.org/a"] * 400
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(url_rules.judged(pages(spark, urls), table).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [brute(u, rules) for u in urls]


def test_odd_rules(spark):
    rules = [(None, "/", "block"), ("", "/", "block"), ("org", None, "block"), ("com", "/", None), ("net", "/", "allow"),
             ("net", "/", "block"), ("net", "/", "block")]
    urls = ["http://x.org", "http://com/", "http://net/", "http://other/"]
    got = sorted(url_rules.judged(pages(spark, urls), spark.createDataFrame(rules, "host string, path string, verdict string")).collect())
    assert [(r.rule, r.verdict) for r in got] == [("org", "block"), (None, "allow"), ("net/", "block"), (None, "allow")]


def test_null_ids_repeats_and_empty_tables(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    two = spark.createDataFrame([(None, "http://org/"), (1, "http://org/"), (1, "http://org/")], "page_id long, url string")
    assert [r.rule for r in url_rules.judged(two, rules).collect()] == ["org/"] * 3
    assert url_rules.judged(two, rules.limit(0), "block").select("verdict").distinct().collect()[0][0] == "block"
    assert url_rules.judged(two.limit(0), rules).collect() == []


def test_query_against_brute_force(spark):
    got = sorted(queries.QUERIES["op8_url_rules"](spark, SF).collect())
    urls = sorted(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    assert [tuple(r) for r in got] == [(u.page_id, *brute(u.url, queries.URL_RULES)) for u in urls]


def test_repeated_pages_and_even_ranges(spark, monkeypatch):
    """A page that stands very often is split into parts; ranges hold about the same number of pages."""
    from tessera.llm import common
    monkeypatch.setattr(common, "SPAN", 50)
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    rows_in = [(7, "http://hot.org/es/a")] * 2000 + [(n, f"http://h{n % 9}.example.org/es/{n}") for n in range(100, 4100)]
    table = spark.createDataFrame(rows_in, "page_id long, url string")
    got = url_rules.judged(table, rules).collect()
    assert sorted((r.page_id, r.rule) for r in got) == sorted(
        (i, "org/" if i == 7 else "example.org/es/") for i, _ in rows_in)
    from pyspark.sql import functions as F
    sizes = [r["count"] for r in url_rules.judged(table, rules).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4 * 6000 / 8


def test_clashing_columns(spark):
    from helpers import clashing
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    table = clashing(pages(spark, ["http://org/a"])).selectExpr("*", "1 host", "2 path", "3 rule", "4 reach", "5 copies")
    assert [r.rule for r in url_rules.judged(table, rules).collect()] == ["org/"]
