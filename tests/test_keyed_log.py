"""Deltas and snapshots of keyed stream results."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.session import work_dir
from tessera.streaming.keyed_log import KeyedLog

SCHEMA = "k long, n long"


def fill(spark, log, batches, table):
    for b in batches:
        part = [(k, 100 * b + k) for k in {b % 7, b % 3, 20 + b}]
        log.write(spark.createDataFrame(part, SCHEMA).coalesce(1), b)
        table.update(part)


def read_files(df):
    return len(df.inputFiles())


def test_files_read_stay_bounded_over_fifty_batches(spark):
    log, table, most = KeyedLog(spark, work_dir(spark, "log"), ["k"], SCHEMA, every=5), {}, []
    for b in range(50):
        fill(spark, log, [b], table)
        if b % 7 == 6 or b == 49:
            assert rows(log.read()) == sorted(table.items())
            most.append(read_files(log.read()))
    assert max(most) <= 2 * 5 + 8 and len(log._names("delta")) <= 3 * 5 and len(log._names("snapshot")) <= 2
    assert most[-1] <= max(most[:4])


@pytest.mark.parametrize("step", ["publish", "_merged", "clean"])
def test_a_merge_that_dies_loses_nothing(spark, monkeypatch, step):
    log, table = KeyedLog(spark, work_dir(spark, "log-die"), ["k"], SCHEMA, every=4), {}
    fill(spark, log, range(7), table)

    def die(*args):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(log, step, die)
        with pytest.raises(RuntimeError):
            fill(spark, log, [7], table)
    again = KeyedLog(spark, log.path, ["k"], SCHEMA, every=4)
    table.update([(7 % 7, 700), (7 % 3, 701), (27, 727)])
    assert rows(again.read()) == sorted(table.items())
    again.write(spark.createDataFrame([(0, 700), (1, 701), (27, 727)], SCHEMA), 7)  # the batch is retried
    fill(spark, again, range(8, 13), table)
    assert rows(again.read()) == sorted(table.items())
    assert len(again._names("snapshot")) <= 2


def test_unfinished_files_do_not_count(spark):
    log, table = KeyedLog(spark, work_dir(spark, "log-torn"), ["k"], SCHEMA, every=3), {}
    assert rows(log.read()) == []
    fill(spark, log, range(6), table)
    fs = log._fs
    fs.create(log._p("manifest/000000000099.json"), True).close()                   # cut off
    fs.mkdirs(log._p("delta/batch_id=6"))                                            # no _SUCCESS
    spark.range(1).select(F.col("id").alias("k"), F.lit(5).cast("long").alias("n")).write.parquet(f"{log.path}/snapshot/upto=5-lost")
    assert rows(log.read()) == sorted(table.items())


def test_null_keys_and_several_values(spark):
    log = KeyedLog(spark, work_dir(spark, "log-null"), ["a", "b"], "a string, b long, x string, y double", every=2)
    log.write(spark.createDataFrame([(None, 1, "p", None), ("q", None, "r", 2.0)], "a string, b long, x string, y double"), 0)
    log.write(spark.createDataFrame([(None, 1, None, 3.0)], "a string, b long, x string, y double"), 1)
    assert sorted(map(str, map(tuple, log.read().collect()))) == ["('q', None, 'r', 2.0)", "(None, 1, None, 3.0)"]
