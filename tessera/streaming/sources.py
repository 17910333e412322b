"""Stream sources.

* ``file_drop_stream``: files appearing in a folder (the replay harness and
  queue-of-batches source).
* ``table_stream``: the files of a table, so many per trigger.
* ``kafka_stream``: Kafka topic values as text; needs the Kafka connector on
  the classpath (not installed here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_drop_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def table_stream(spark: SparkSession, folder: str, name: str, schema, max_files_per_trigger: int = 16) -> DataFrame:
    """The Parquet table ``name`` in ``folder`` (one file, or a folder of files) as a
    stream of its files, oldest first."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", "true")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return r.parquet(f"{folder}/{name}")
    return r.option("pathGlobFilter", name).parquet(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options) -> DataFrame:
    """Message values of a topic as a ``value`` string column."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).options(**options).load()
            .selectExpr("CAST(value AS STRING) AS value"))
