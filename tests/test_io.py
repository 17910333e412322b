"""Sources and sinks that need a process-local resource (embedded Derby)."""

import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.session import work_dir
from tessera.sources import io
from tessera.sources.tables import Tables


def test_jdbc_round_trip_on_embedded_derby(spark):
    """JDBC sink (append, batch size, isolation) and source.  Embedded Derby
    lives inside this JVM only, so this runs in local mode; on a cluster the
    same calls take a real database URL."""
    url = "jdbc:derby:memory:tessera;create=true"
    cust = Tables(spark, SF_SMALL).customer.select("c_custkey", "c_name", "c_acctbal")
    io.write_jdbc(cust, url, "cust", mode="overwrite", batchsize=100, isolation_level="READ_COMMITTED",
                  num_partitions=2, driver="org.apache.derby.jdbc.EmbeddedDriver")
    io.write_jdbc(cust.where("c_custkey < 10"), url, "cust", mode="append",
                  driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = io.read_jdbc(spark, url, "cust", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert back.count() == cust.count() + cust.where("c_custkey < 10").count()
    assert rows(back.where("c_custkey >= 10"), "c_custkey") == rows(cust.where("c_custkey >= 10"), "c_custkey")


def test_single_file_sink_writes_one_file(spark):
    d = work_dir(spark, "one")
    io.write_single_file(Tables(spark, SF_SMALL).orders.orderBy("o_orderkey"), d, "csv")
    assert len([p for p in glob.glob(d.replace("file:", "") + "/part-*")]) == 1


def test_parse_delimited_drops_wrong_field_counts(spark):
    from pyspark.sql import types as T
    lines = spark.createDataFrame([("a 1 2",), ("  b 3 4  ",), ("c 5",), ("d 6 7 8",), ("",), (None,)],
                                  "value string")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.IntegerType()),
                           T.StructField("y", T.IntegerType())])
    assert rows(io.parse_delimited(lines, schema)) == [("a", 1, 2), ("b", 3, 4)]


def test_parsers_survive_ansi_mode_on_bad_numbers(spark):
    """Spark 4 runs with ANSI casts; a non-numeric rank must give NULL, not an error."""
    from tessera.plans import analyses as an
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    lines = spark.createDataFrame([("00:00:01 u1 [a+b] 1 1 www.x.com/a",), ("00:00:02 u2 [c] x 2 www.y.com/",)],
                                  "value string")
    got = rows(an.parse_search(lines), "user_id", "result_rank", "click_rank")
    assert got == [("u1", 1, 1), ("u2", None, 2)]
    assert an.search_best_rank(lines).first()["best"] == 1


def test_bucketed_tables_join_without_shuffle(spark):
    import contextlib
    import io as _io
    import uuid
    from tessera.sources.io import write_bucketed
    t = Tables(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:8]
    o = write_bucketed(t.orders.select("o_orderkey", "o_custkey"), f"orders_b_{tag}", ["o_orderkey"], 8,
                       work_dir(spark, "ob"))
    li = write_bucketed(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"),
                        f"lineitem_b_{tag}", ["o_orderkey"], 8, work_dir(spark, "lb"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle-join path
    try:
        j = li.join(o, "o_orderkey")
        buf = _io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == t.lineitem.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
