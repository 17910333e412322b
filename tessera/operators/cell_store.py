"""Wide-column cells stored as sorted runs (``CellStore``).

Every put writes one run: its cells range-partitioned and sorted by row key, so a file holds
one stretch of keys, with an index table of the files' first and last keys beside it.  Deletes
are cells too: a tombstone hides the versions of its cell (or, without family and qualifier, of
its row) that are not newer than its own version.  Readers merge the runs, newest version first and
the larger value first of cells alike in key and version, as ``cells.versions`` does; a
tombstone hides cells whatever run they are in, also ones put later with an older version.

A scan of [start, stop) opens only the files whose stretch overlaps it, and the key bounds reach
the Parquet reader of these.  A run is visible once the manifest that names it is renamed into
place.  ``compact`` merges all runs into one and drops what tombstones hide.

Null row keys are refused on write.  A null version is older than any other.  An empty put
makes an empty run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.cells import CELL_KEY

RUN_SCHEMA = "row_key string, family string, qualifier string, version long, value string, gone boolean"
INDEX_SCHEMA = "run string, file string, first string, last string"


class CellStore:
    """The cells at ``path``; ``files`` per run (default: the session's shuffle partitions)."""

    def __init__(self, spark: SparkSession, path: str, files: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # ------------------------------------------------------------------ files

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._p("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[str]:
        fs = self._fs
        if not fs.exists(self._p("manifest")):
            return []
        return sorted(n for s in fs.listStatus(self._p("manifest")) if (n := s.getPath().getName()).endswith(".json"))

    def runs(self) -> list[str]:
        """Published runs, oldest first."""
        known = self._manifests()
        if not known:
            return []
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{known[-1]}").collect()))

    def _publish(self, runs: list[str]) -> None:
        fs, known = self._fs, self._manifests()
        fs.mkdirs(self._p("manifest"))
        aside = self._p(f"manifest/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, True)
        stream.write(json.dumps(runs).encode())
        stream.close()
        target = self._p(f"manifest/{int(known[-1].split('.')[0]) + 1 if known else 0:012d}.json")
        if fs.exists(target) or not fs.rename(aside, target):
            raise OSError(f"{target} stands already: another writer came first")

    # ------------------------------------------------------------------ write

    def _write(self, cells: DataFrame) -> list[str]:
        run = f"run-{uuid.uuid4().hex[:12]}"
        checked = cells.withColumn("row_key", F.when(F.col("row_key").isNull(), F.raise_error(F.lit("a cell needs a row key")))
                                   .otherwise(F.col("row_key")))
        # the other parts of the key split the cells of one very wide row
        (checked.repartitionByRange(self.files, *CELL_KEY, "version")
         .sortWithinPartitions(*CELL_KEY, F.desc("version")).write.parquet(f"{self.path}/{run}/cells"))
        written = self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/{run}/cells")
        (written.groupBy(F.lit(run).alias("run"), F.col("_metadata.file_name").alias("file"))
         .agg(F.min("row_key").alias("first"), F.max("row_key").alias("last"))
         .write.parquet(f"{self.path}/{run}/index"))
        return [run]

    def put(self, cells: DataFrame) -> None:
        """Add cells (row_key, family, qualifier, version, value) as a run."""
        self._publish(self.runs() + self._write(cells.select(*CELL_KEY, "version", "value", F.lit(False).alias("gone"))))

    def delete(self, tombstones: DataFrame) -> None:
        """Hide cells, or whole rows where family and qualifier are null, up to ``version`` (null: all)."""
        t = tombstones if "version" in tombstones.columns else tombstones.withColumn("version", F.lit(None).cast("long"))
        self._publish(self.runs() + self._write(t.select(
            *CELL_KEY, F.coalesce("version", F.lit((1 << 63) - 1)).alias("version"),
            F.lit(None).cast("string").alias("value"), F.lit(True).alias("gone"))))

    def compact(self) -> None:
        """One run of all visible cells; the runs before stay for readers that have begun."""
        self._publish(self._write(self.visible(None, None).withColumn("gone", F.lit(False))))

    # ------------------------------------------------------------------ read

    def overlapping(self, start: str | None, stop: str | None) -> list[str]:
        """Files that may hold rows with start <= row_key < stop."""
        runs = self.runs()
        if not runs:
            return []
        index = self.spark.read.schema(INDEX_SCHEMA).parquet(*[f"{self.path}/{r}/index" for r in runs])
        if start is not None:
            index = index.where(F.col("last") >= start)
        if stop is not None:
            index = index.where(F.col("first") < stop)
        return [f"{self.path}/{r.run}/cells/{r.file}" for r in index.select("run", "file").collect()]

    def raw(self, start: str | None, stop: str | None) -> DataFrame:
        """Cells and tombstones of the range, from overlapping files only (all runs where it has no end)."""
        if start is None and stop is None:
            paths = [f"{self.path}/{r}/cells" for r in self.runs()]
        else:
            paths = self.overlapping(start, stop)
        if not paths:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        out = self.spark.read.schema(RUN_SCHEMA).parquet(*paths)
        if start is not None:
            out = out.where(F.col("row_key") >= start)
        return out if stop is None else out.where(F.col("row_key") < stop)

    def visible(self, start: str | None, stop: str | None) -> DataFrame:
        """All cells that no tombstone hides."""
        both = self.raw(start, stop)
        cells = both.where(~F.col("gone")).select(*CELL_KEY, "version", "value")
        tombs = both.where("gone")
        rows = tombs.where("family is null").groupBy("row_key").agg(F.max("version").alias("__until"))
        single = tombs.where("family is not null").groupBy(*CELL_KEY).agg(F.max("version").alias("__until"))

        def hide(c: DataFrame, t: DataFrame, keys: list[str]) -> DataFrame:
            t = t.select(*[F.col(k).alias(f"__{k}") for k in keys], "__until")
            on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [
                F.coalesce("version", F.lit(-(1 << 63))) <= F.col("__until")]
            return c.join(t, on, "left_anti")
        return hide(hide(cells, rows, ["row_key"]), single, CELL_KEY)

    def versions(self, n: int = 1, start: str | None = None, stop: str | None = None) -> DataFrame:
        """The newest ``n`` versions of every cell."""
        newest = Window.partitionBy(*CELL_KEY).orderBy(F.desc("version"), F.desc("value"))
        return (self.visible(start, stop).withColumn("__rn", F.row_number().over(newest))
                .where(F.col("__rn") <= n).drop("__rn"))

    def scan(self, start: str | None = None, stop: str | None = None, family: str | None = None,
             qualifier: str | None = None) -> DataFrame:
        """Newest cells of the rows start <= row_key < stop, optionally of one column."""
        c = self.visible(start, stop)
        if family is not None:
            c = c.where(F.col("family") == family)
        if qualifier is not None:
            c = c.where(F.col("qualifier") == qualifier)
        m = c.groupBy(*CELL_KEY).agg(F.max(F.struct("version", "value")).alias("__m"))
        return m.select(*CELL_KEY, "__m.version", "__m.value")

    def get(self, row_key: str) -> DataFrame:
        """Newest cells of one row."""
        return self.scan(row_key, row_key + "\0")
