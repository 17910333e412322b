"""Readers for the Parquet test tables.

Scans stay lazy: Catalyst prunes columns and pushes filters into the
Parquet reader, so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def pin_utc(spark: SparkSession) -> None:
    """Times are compared as UTC wall-clock text; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; timestamp columns come back as (UTC) ``timestamp``.

    The files may be typed ``timestamp_ntz``; event-time operators such as
    watermarks need ``timestamp``, and with the session pinned to UTC the
    cast keeps the wall-clock value.
    """
    pin_utc(spark)
    return _read(spark, table_path(sf_dir, name))


def _read(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    if any(isinstance(f.dataType, T.TimestampNTZType) for f in df.schema.fields):
        df = df.select(*casts)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Make sure CPU-heavy per-row work (text) can use every core.

    A scan has one task per file split; when an input has fewer splits than
    the cluster has cores (a small table, one row group), the rows are
    spread round-robin first.  Large inputs already scan in many splits and
    are returned untouched, so at scale this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)
