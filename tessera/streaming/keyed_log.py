"""Keyed result tables of streams: per-batch deltas, merged into published snapshots.

An update-mode stream writes the rows that a micro-batch changed to ``delta/batch_id=N``
(overwriting, so a retried batch replaces its own rows).  Every ``every`` batches the
finished ones are merged, newest row per key, into ``snapshot/upto=B-<random>``; a small
manifest file, renamed into place once the snapshot is complete, publishes it.  A reader
takes the newest manifest's snapshot and the deltas after it, so the files it reads are
bounded however long the stream runs.  Until its manifest stands a merge is invisible: one
that dies half-way loses nothing, and the next one cleans up after it.  The snapshot and the
deltas of the manifest before the newest stay for readers that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVERY = 10                 # batches between merges
ORDER = "batch_id"


def newest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the highest batch of each key, with its batch_id (a partial aggregate)."""
    values = [c for c in log.columns if c not in keys]
    best = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(ORDER)).alias("__v"))
    return best.select(*keys, *[F.col("__v." + c).alias(c) for c in values])


class KeyedLog:
    """The table of ``keys`` at ``path``; ``schema`` is that of the rows written (without batch_id)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema, every: int = EVERY):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), list(keys), every
        fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(ORDER, T.LongType())])

    # ------------------------------------------------------------------ files

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._p("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs = self._fs
        return sorted(s.getPath().getName() for s in fs.listStatus(self._p(folder))) if fs.exists(self._p(folder)) else []

    def manifests(self) -> list[dict]:
        """Published merges, oldest first; a file that was not written to its end does not count."""
        out = []
        for name in self._names("manifest"):
            if name.endswith(".json"):
                text = "".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{name}").collect())
                try:
                    out.append(json.loads(text))
                except ValueError:
                    continue
        return out

    def deltas(self, after: int, upto: int | None = None) -> list[int]:
        """Batches after ``after`` whose rows are written to the end, up to ``upto``."""
        ids = [int(n.split("=")[1]) for n in self._names("delta") if n.startswith("batch_id=")]
        return [b for b in sorted(ids) if b > after and (upto is None or b <= upto)
                and self._fs.exists(self._p(f"delta/batch_id={b}/_SUCCESS"))]

    # ------------------------------------------------------------------ write

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """foreachBatch function."""
        names = [f.name for f in self.schema.fields if f.name != ORDER]
        rows.select(*names).write.mode("overwrite").parquet(f"{self.path}/delta/batch_id={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.merge(batch_id - 1)  # this batch may still be retried, those before it are finished

    def sink(self) -> Callable[[DataFrame, int], None]:
        return self.write

    def merge(self, upto: int) -> None:
        """Publish a snapshot of all batches up to ``upto``, then drop what no reader needs."""
        known = self.manifests()
        last = known[-1] if known else {"upto": -1, "snapshot": None}
        if upto <= last["upto"] or not self.deltas(last["upto"], upto):
            return
        name = f"snapshot/upto={upto}-{uuid.uuid4().hex[:12]}"
        self._merged(last, upto).write.parquet(f"{self.path}/{name}")
        self.publish(upto, name)
        self.clean()

    def publish(self, upto: int, snapshot: str) -> None:
        """Write the manifest aside and rename it, which shows it whole or not at all."""
        fs = self._fs
        fs.mkdirs(self._p("manifest"))
        aside = self._p(f"manifest/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, True)
        stream.write(json.dumps({"upto": upto, "snapshot": snapshot}).encode())
        stream.close()
        target = self._p(f"manifest/{upto:012d}.json")
        if not fs.exists(target) and not fs.rename(aside, target):
            raise OSError(f"{target} could not be written")

    def clean(self) -> None:
        """Delete what lies behind the manifest before the newest, and snapshots never published."""
        known, fs = self.manifests(), self._fs
        kept, names = known[-2:], {m["snapshot"].split("/")[1] for m in known[-2:]}
        for name in self._names("snapshot"):
            if name not in names:
                fs.delete(self._p(f"snapshot/{name}"), True)
        if len(kept) == 2:
            for name in self._names("delta"):
                if int(name.split("=")[1]) <= kept[0]["upto"]:
                    fs.delete(self._p(f"delta/{name}"), True)
            for name in self._names("manifest"):
                if name.endswith(".json") and int(name.split(".")[0]) < kept[0]["upto"]:
                    fs.delete(self._p(f"manifest/{name}"), False)

    # ------------------------------------------------------------------ read

    def _merged(self, last: dict, upto: int | None) -> DataFrame:
        parts = []
        if last["snapshot"]:
            parts.append(self.spark.read.schema(self.schema).parquet(f"{self.path}/{last['snapshot']}"))
        rows = T.StructType([f for f in self.schema.fields if f.name != ORDER])
        ids = self.deltas(last["upto"], upto)
        if ids:
            files = self.spark.read.option("basePath", f"{self.path}/delta").schema(
                T.StructType([*rows.fields, T.StructField(ORDER, T.LongType())]))
            parts.append(files.parquet(*[f"{self.path}/delta/batch_id={b}" for b in ids]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return newest(both.select(*self.schema.fieldNames()), self.keys)

    def read(self, with_batch: bool = False) -> DataFrame:
        """The current table."""
        known = self.manifests()
        out = self._merged(known[-1] if known else {"upto": -1, "snapshot": None}, None)
        return out if with_batch else out.drop(ORDER)
