"""Wide-column table kept as a long DataFrame.

A cell is (row_key, family, qualifier, version, value).  Puts are appended
rows, deletes are tombstone rows; reads resolve the newest versions with a
ranking window per cell, whose groups are one cell's versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_KEY = ["row_key", "family", "qualifier"]
CELL_SCHEMA = "row_key string, family string, qualifier string, version long, value string"


def put(cells: DataFrame, new: DataFrame) -> DataFrame:
    """Append new versions (upsert = newer version wins on read)."""
    return cells.unionByName(new.select(*CELL_KEY, "version", "value"))


def versions(cells: DataFrame, n: int = 1) -> DataFrame:
    """Keep the newest n versions of every cell (ties: larger value first)."""
    w = Window.partitionBy(*CELL_KEY).orderBy(F.desc("version"), F.desc("value"))
    return (cells.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
                 .drop("__rn"))


def latest(cells: DataFrame) -> DataFrame:
    """Newest value per cell, as a plain aggregate (max of (version, value))."""
    m = cells.groupBy(*CELL_KEY).agg(F.max(F.struct("version", "value")).alias("__m"))
    return m.select(*CELL_KEY, F.col("__m.version").alias("version"), F.col("__m.value").alias("value"))


def get(cells: DataFrame, row_key: str) -> DataFrame:
    """Point read of one row (all its newest cells)."""
    return latest(cells.where(F.col("row_key") == row_key))


def scan_range(cells: DataFrame, start: str, stop: str, family: str | None = None,
               qualifier: str | None = None) -> DataFrame:
    """Rows with start <= row_key < stop, optionally one column."""
    c = cells.where((F.col("row_key") >= start) & (F.col("row_key") < stop))
    if family is not None:
        c = c.where(F.col("family") == family)
    if qualifier is not None:
        c = c.where(F.col("qualifier") == qualifier)
    return latest(c)


def delete(cells: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Remove cells (row_key, family, qualifier) or whole rows (row_key only,
    family/qualifier NULL) named by ``tombstones``."""
    whole_rows = tombstones.where(F.col("family").isNull()).select("row_key")
    single = tombstones.where(F.col("family").isNotNull()).select(*CELL_KEY)
    return cells.join(whole_rows, "row_key", "left_anti").join(single, CELL_KEY, "left_anti")
