import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import cells as cl
from tessera.operators.cell_store import CellStore
from tessera.session import work_dir


def cells(spark, data):
    return spark.createDataFrame(data, cl.CELL_SCHEMA)


def many(spark, version):
    return spark.range(20_000).select(
        F.format_string("r%05d", "id").alias("row_key"), F.lit("info").alias("family"), F.lit("click").alias("qualifier"),
        F.lit(version).cast("long").alias("version"), (F.col("id") * version).cast("string").alias("value"))


def test_scan_opens_overlapping_files_only(spark):
    store = CellStore(spark, work_dir(spark, "cells"), files=16)
    store.put(many(spark, 1))
    store.put(many(spark, 2).where("row_key < 'r10000'"))
    every = store.scan().inputFiles()
    part = store.scan("r05000", "r05400")
    assert len(every) >= 24 and 2 <= len(part.inputFiles()) <= 5
    assert rows(part, "row_key", "version", "value") == [(f"r{i:05d}", 2, str(2 * i)) for i in range(5000, 5400)]
    plan = spark._jvm.PythonSQLUtils.explainString(part._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(row_key,r05000), LessThan(row_key,r05400)" in plan
    assert store.scan("s", "t").count() == 0 and len(store.get("r15000").inputFiles()) == 1
    assert rows(store.get("r15000"), "value") == [("15000",)]


def test_equal_to_the_plain_form(spark):
    a = cells(spark, [("r1", "info", "click", 1, "3"), ("r1", "info", "click", 2, "5"), ("r1", "info", "view", 1, "7"),
                      ("r2", "info", "click", 1, "1"), ("r3", "info", "click", 4, "9"), ("r3", None, None, 4, None)])
    b = cells(spark, [("r2", "info", "click", 3, "2"), ("r1", "info", "click", 2, "6"), ("é", "x", "", None, "n")])
    store = CellStore(spark, work_dir(spark, "cells"), files=3)
    store.put(a)
    store.put(b)
    both = cl.put(a, b)
    key = ["row_key", "family", "qualifier", "version", "value"]
    text = lambda df: sorted(map(str, df.select(*key).collect()))
    assert text(store.versions(2)) == text(cl.versions(both, 2))
    assert text(store.scan("r1", "r3", "info", "click")) == text(cl.scan_range(both, "r1", "r3", "info", "click"))
    store.compact()
    assert len(store.runs()) == 1 and text(store.visible(None, None)) == text(both)


def test_tombstones_hide_older_versions_in_every_run(spark):
    store = CellStore(spark, work_dir(spark, "cells"), files=2)
    store.put(cells(spark, [("a", "f", "q", 1, "1"), ("a", "f", "q", 5, "5"), ("b", "f", "q", 1, "1"), ("b", "f", "p", 1, "2"),
                            ("c", "f", "q", 9, "9"), ("c", "f", "p", None, "0")]))
    store.delete(cells(spark, [("a", "f", "q", 3, None)]))
    store.delete(spark.createDataFrame([("b", "f", "q"), ("c", None, None)], "row_key string, family string, qualifier string"))
    want = [("a", "q", 5), ("b", "p", 1)]
    assert rows(store.visible(None, None), "row_key", "qualifier", "version") == want
    store.put(cells(spark, [("a", "f", "q", 2, "late")]))
    assert rows(store.visible(None, None), "row_key", "qualifier", "version") == want
    assert rows(store.get("c")) == [] and rows(store.scan("a", "b"), "version") == [(5,)]
    store.compact()
    assert rows(store.raw(None, None), "row_key", "qualifier", "version") == want


def test_run_that_dies_is_not_seen_and_empty_store(spark, monkeypatch):
    store = CellStore(spark, work_dir(spark, "cells"), files=2)
    assert store.scan("a", "b").collect() == [] and store.scan().collect() == []
    store.put(cells(spark, []))
    store.put(cells(spark, [("a", "f", "q", 1, "1")]))
    other = CellStore(spark, store.path, files=2)
    monkeypatch.setattr(other, "_publish", lambda runs: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        other.put(cells(spark, [("a", "f", "q", 2, "2")]))
    assert rows(store.scan(), "version") == [(1,)]
    with pytest.raises(Exception, match="row key"):
        store.put(cells(spark, [(None, "f", "q", 1, "1")]))
