"""Readers and writers.

Readers return lazy DataFrames with explicit schemas where the format has
none; writers are plain ``DataFrameWriter`` calls.  Catalog tables are
created with an explicit location (normally under the shared checkpoint
folder), never in a machine-local warehouse directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import fields

# ---------------------------------------------------------------- sources


def read_text(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Lines of a file, folder or glob (``textFile``)."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.text(path)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, content) (``wholeTextFiles``)."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             names: Sequence[str] | None = None, header: bool = False, sep: str = ",",
             **options) -> DataFrame:
    """Header-less CSV, typed by ``schema`` or all strings renamed to ``names``."""
    r = spark.read.option("header", str(header).lower()).option("sep", sep).options(**options)
    if schema is not None:
        return r.schema(schema).csv(path)
    df = r.csv(path)
    return df.toDF(*names) if names else df


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, driver: str | None = None, **options) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (("user", user), ("password", password), ("driver", driver), *options.items()):
        if v is not None:
            r = r.option(k, v)
    return r.load()


def read_sequence(spark: SparkSession, path: str, schema: str = "key long, value string") -> DataFrame:
    """Hadoop SequenceFile of (key, value) pairs -> DataFrame.

    Interop for small data: the format has no DataFrame reader, so rows pass
    through Python one by one."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Typed object files are kept as Parquet (portable, columnar)."""
    return spark.read.parquet(path)


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str | None = None,
                    col: str = "value", exact: bool = True) -> DataFrame:
    """Positional parse of delimited lines into typed columns.

    ``sep`` is a regex (default: any whitespace run, after trimming).  With
    ``exact`` lines whose field count differs from the schema are dropped;
    fields that do not parse as their type become NULL (``try_cast``).
    """
    f = fields(F.col(col)) if sep is None else F.split(F.col(col), sep)
    d = lines.where(F.col(col).isNotNull()).select(f.alias("__f"))
    if exact:
        d = d.where(F.size("__f") == len(schema.fields))
    return d.select(*[F.col("__f").getItem(i).try_cast(fld.dataType).alias(fld.name)
                      for i, fld in enumerate(schema.fields)])


# ---------------------------------------------------------------- sinks


def write_text(df: DataFrame, path: str, sep: str = " ", mode: str = "overwrite") -> None:
    """One text line per row (columns joined by ``sep``), one file per partition."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")) \
      .write.mode(mode).text(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", **options) -> None:
    """``coalesce(1)`` then write: for small, already sorted results only;
    the last stage runs in one task."""
    df.coalesce(1).write.mode(mode).options(**options).format(fmt).save(path)


def write_format(df: DataFrame, path: str, fmt: str, mode: str = "overwrite",
                 partition_by: Sequence[str] = (), **options) -> None:
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int | None = None,
               isolation_level: str | None = None, num_partitions: int | None = None, **options) -> None:
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    for k, v in (("batchsize", batchsize), ("isolationLevel", isolation_level),
                 ("numPartitions", num_partitions), *options.items()):
        if v is not None:
            w = w.option(k, str(v))
    w.save()


def write_sequence(df: DataFrame, path: str, key: str, value: str) -> None:
    """(key, value) pairs as a Hadoop SequenceFile (interop for small data, as above)."""
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(path)


def write_objects(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


# ---------------------------------------------------------------- catalog tables


def create_table(spark: SparkSession, name: str, ddl_columns: str, location: str, fmt: str = "parquet",
                 partitioned_by: Sequence[str] = (), options: dict | None = None) -> None:
    """``CREATE TABLE ... USING fmt LOCATION ...`` in the session catalog."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    spark.sql(f"CREATE TABLE {name} ({ddl_columns}) USING {fmt}{opts}{part} LOCATION '{location}'")


def append_to_table(df: DataFrame, name: str) -> None:
    """Append by position into an existing table (``insertInto``)."""
    df.write.mode("append").insertInto(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df``
    are replaced (retry-safe, unlike an append)."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def load_into_table(spark: SparkSession, name: str, path: str, schema: T.StructType | str,
                    fmt: str = "csv", sep: str = "\t") -> None:
    """``LOAD DATA INPATH``: typed read of delimited files, appended into the table."""
    df = spark.read.schema(schema).option("sep", sep).format(fmt).load(path)
    append_to_table(df, name)


def write_bucketed(df: DataFrame, name: str, by: Sequence[str], buckets: int, location: str) -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted on ``by`` at
    ``location``.  Tables bucketed the same way on their join key join
    without a shuffle (co-located), which pays off when the same large
    inputs are joined repeatedly."""
    (df.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
       .option("path", location).saveAsTable(name))
    return df.sparkSession.table(name)
