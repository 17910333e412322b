"""Registered source / sink queries.

Each writes a test table (or a stand-in view over it) in the format under
test into a fresh folder of the shared work area, reads it back and
returns the result; the SQL twin is the same data computed by DuckDB
straight from the Parquet tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.session import work_dir
from tessera.sources import fixtures as fx
from tessera.sources import io
from tessera.sources.tables import Tables


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _read_and_drop(spark, name: str, sql: str | None = None):
    """The table's rows (or a query on it), resolved now; the catalog entry goes, the
    files at its own location stay until the work folder is cleared."""
    out = spark.sql(sql) if sql else spark.table(name)
    out.schema  # resolve before the name goes
    spark.sql(f"DROP TABLE {name}")
    return out


# ---------------------------------------------------------------- text


@register("src_text", fx.with_views("SELECT value FROM access_log", "access_log"))
def q_src_text(spark, sf_dir):
    d = work_dir(spark, "text")
    io.write_text(fx.access_log(spark, sf_dir).select("value"), d)
    return io.read_text(spark, d, glob="*.txt")


@register("sink_text", fx.with_views(
    "SELECT value FROM (SELECT CAST(user_id AS VARCHAR) || ' ' || session_id || ' ' || CAST(page_id AS VARCHAR) AS value FROM visits)",
    "visits"))
def q_sink_text(spark, sf_dir):
    d = work_dir(spark, "sink-text")
    io.write_text(fx.visits(spark, sf_dir).select("user_id", "session_id", "page_id"), d, sep=" ")
    return spark.read.text(d)


# Size of a written file: whole files are read back as single rows, so
# their size must stay bounded as the table grows.
FILE_BYTES = 64 << 20


@register("src_whole_text", fx.with_views(f"""
  SELECT CAST(sum(strlen(value) + 1) // {FILE_BYTES} + 1 AS BIGINT) AS files, count(*) AS lines,
         CAST(sum(length(value) + 1) AS BIGINT) AS chars FROM access_log
""", "access_log"))
def q_src_whole_text(spark, sf_dir):
    """Lines written round-robin into files of about FILE_BYTES, read back one
    row per file (path, content)."""
    d = work_dir(spark, "whole")
    lines = fx.access_log(spark, sf_dir).select("value")
    n_files = (lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0) // FILE_BYTES + 1
    io.write_text(lines.repartition(n_files), d)
    w = io.read_whole_text(spark, d)
    n_lines = F.size(F.split("content", "\\n")) - 1
    return w.agg(F.count(F.lit(1)).alias("files"), F.sum(n_lines).cast("bigint").alias("lines"),
                 F.sum(F.length("content")).cast("bigint").alias("chars"))


@register("sink_single_file", """
  SELECT substring(strftime(ts, '%H:%M:%S'), 1, 2) AS hour, CAST(count(*) AS BIGINT) AS searches
  FROM documents d JOIN events e ON d.doc_id % (SELECT count(*) FROM events) = e.event_id
  GROUP BY 1
""")
def q_sink_single_file(spark, sf_dir):
    """Searches per hour (at most 24 rows), sorted, written as exactly one
    CSV file.  ``coalesce(1)`` is kept for results with such a fixed bound."""
    from tessera.plans.analyses import parse_search, search_hourly
    d = work_dir(spark, "single")
    hourly = search_hourly(parse_search(fx.search_lines(spark, sf_dir))).orderBy("hour")
    io.write_single_file(hourly, d, "csv", header="true")
    return io.read_csv(spark, d, schema="hour string, searches long", header=True)


# ---------------------------------------------------------------- json / csv


@register("src_json", fx.with_views("SELECT id, username, age FROM users", "users"))
def q_src_json(spark, sf_dir):
    d = work_dir(spark, "json")
    io.write_format(fx.users(spark, sf_dir), d, "json")
    return io.read_json(spark, d).select("id", "username", "age")   # schema inferred


@register("sink_json", fx.with_views("SELECT * FROM reviews", "reviews"))
def q_sink_json(spark, sf_dir):
    """Sparse records to JSON lines (nulls are left out of each line)."""
    d = work_dir(spark, "sink-json")
    r = fx.reviews(spark, sf_dir)
    io.write_format(r, d, "json")
    return io.read_json(spark, d, r.schema)


@register("src_csv", fx.with_views("SELECT * FROM behaviour_raw", "behaviour_raw"))
def q_src_csv(spark, sf_dir):
    d = work_dir(spark, "csv")
    io.write_format(fx.behaviour_raw(spark, sf_dir), d, "csv")
    return io.read_csv(spark, d, names=["UserID", "ItemID", "CategoryID", "BehaviorType", "TimeStamp"])


@register("sink_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_sink_csv(spark, sf_dir):
    d = work_dir(spark, "sink-csv")
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    io.write_format(o, d, "csv", header="true")
    return io.read_csv(spark, d, schema=o.schema, header=True)


# ---------------------------------------------------------------- sequence / object files


@register("src_sequence", "SELECT c_custkey AS key, c_name AS value FROM customer")
def q_src_sequence(spark, sf_dir):
    d = work_dir(spark, "seq") + "/data"
    io.write_sequence(Tables(spark, sf_dir).customer, d, "c_custkey", "c_name")
    return io.read_sequence(spark, d)


@register("sink_sequence", "SELECT CAST(p_partkey AS BIGINT) AS key, p_name AS value FROM part")
def q_sink_sequence(spark, sf_dir):
    d = work_dir(spark, "sink-seq") + "/data"
    io.write_sequence(Tables(spark, sf_dir).part, d, "p_partkey", "p_name")
    return io.read_sequence(spark, d)


@register("src_object", "SELECT * FROM part")
def q_src_object(spark, sf_dir):
    d = work_dir(spark, "obj")
    io.write_objects(Tables(spark, sf_dir).part, d)
    return io.read_objects(spark, d)


@register("sink_object", "SELECT * FROM supplier")
def q_sink_object(spark, sf_dir):
    d = work_dir(spark, "sink-obj")
    io.write_objects(Tables(spark, sf_dir).supplier, d)
    return io.read_objects(spark, d)


# ---------------------------------------------------------------- catalog tables


@register("sink_create_table", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def q_sink_create_table(spark, sf_dir):
    name = _name("cust")
    io.create_table(spark, name, "id BIGINT, name STRING, balance DOUBLE", work_dir(spark, name), "parquet")
    io.append_to_table(Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal"), name)
    return _read_and_drop(spark, name)


@register("sink_load_data", fx.with_views("SELECT * FROM behaviour_raw", "behaviour_raw"))
def q_sink_load_data(spark, sf_dir):
    """Tab-delimited files loaded into a typed table."""
    src = work_dir(spark, "load-src")
    io.write_format(fx.behaviour_raw(spark, sf_dir), src, "csv", sep="\t")
    name = _name("behaviour")
    cols = "UserID STRING, ItemID STRING, CategoryID STRING, BehaviorType STRING, TimeStamp STRING"
    io.create_table(spark, name, cols, work_dir(spark, name), "parquet")
    io.load_into_table(spark, name, src, cols, "csv", "\t")
    return _read_and_drop(spark, name)


@register("sink_hive_append", """
  SELECT o_orderkey, o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""")
def q_sink_hive_append(spark, sf_dir):
    """Two appends into one catalog table."""
    name = _name("orders_app")
    io.create_table(spark, name, "o_orderkey BIGINT, o_orderstatus STRING", work_dir(spark, name))
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    io.append_to_table(o, name)
    io.append_to_table(o.where(F.col("o_orderstatus") == "F"), name)
    return _read_and_drop(spark, name)


@register("src_hive", "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def q_src_hive(spark, sf_dir):
    """Query a catalog table by name with SQL (``use db; select ...``)."""
    name = _name("li")
    loc = work_dir(spark, name)
    Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_quantity").write.parquet(loc)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{loc}'")
    return _read_and_drop(spark, name, f"SELECT l_returnflag, count(*) AS n FROM {name} GROUP BY l_returnflag")


@register("sink_dynamic_partition", """
  SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
  WHERE year(o_orderdate) >= 1997
  UNION ALL
  SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE year(o_orderdate) < 1997
""")
def q_sink_dynamic_partition(spark, sf_dir):
    """Year-partitioned table; a second write replaces only the years it holds."""
    name = _name("orders_by_year")
    loc = work_dir(spark, name)
    io.create_table(spark, name, "o_orderkey BIGINT, o_totalprice DOUBLE, year INT", loc, "parquet",
                    partitioned_by=["year"])
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice",
                                            F.year("o_orderdate").cast("int").alias("year"))
    io.append_to_table(o, name)
    late = o.where(F.col("year") >= 1997).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    io.overwrite_partitions(late, name)
    out = spark.read.schema(spark.table(name).schema).parquet(loc)  # its partitions are folders
    spark.sql(f"DROP TABLE {name}")
    return out
