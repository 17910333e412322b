"""Rows already loaded, kept as a table with a key filter per load (``LoadedSet``).

``new_rows`` answers ``EXCEPT`` of new rows against everything loaded before, without reading
the loaded rows for most new ones:

- A blocked Bloom filter stands beside every load, as a table of (block, four 64-bit words):
  all bits of a row are in one block, so probing is an equi-join on the block number and two
  bit tests per word, all built-in functions.  A block takes 20 rows on average.
- With a high-water column (``mark``), a load keeps the greatest value it holds.  A new row
  whose mark lies above is certainly new and is not probed.
- Only possible hits meet the loaded rows, in an exact null-safe anti join that reads the
  slices of the table that hold possible hits, and is left out where there are none.

Nulls are equal, as in ``EXCEPT``, and the result is distinct.  A null mark is above nothing:
such rows are probed.  A load is visible once its manifest row is renamed into place; one that
dies before leaves an unread folder.  More than ``every`` loads are merged into one.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import work_dir

SLICES = 64                # folders of a load
PER_BLOCK = 20             # rows per block of 256 bits: about 1 % false hits
WORDS = ("w0", "w1", "w2", "w3")


class LoadedSet:
    """The loaded rows of ``schema`` at ``path``; ``mark`` names an optional high-water column."""

    def __init__(self, spark: SparkSession, path: str, schema, mark: str | None = None, every: int = 8):
        self.spark, self.path, self.mark, self.every = spark, path.rstrip("/"), mark, every
        fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        self.columns = self.schema.fieldNames()

    # ------------------------------------------------------------------ files

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._p("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def loads(self) -> list[dict]:
        """The loads of the newest manifest: folder, number of blocks, greatest mark."""
        fs = self._fs
        names = sorted(s.getPath().getName() for s in fs.listStatus(self._p("manifest"))) if fs.exists(self._p("manifest")) else []
        names = [n for n in names if n.endswith(".json")]
        if not names:
            return []
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{names[-1]}").collect()))

    def _publish(self, loads: list[dict], after: int) -> None:
        fs = self._fs
        fs.mkdirs(self._p("manifest"))
        aside = self._p(f"manifest/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, True)
        stream.write(json.dumps(loads).encode())
        stream.close()
        target = self._p(f"manifest/{after:012d}.json")
        if fs.exists(target) or not fs.rename(aside, target):
            raise OSError(f"{target} stands already: another load was published meanwhile")

    def _version(self) -> int:
        fs = self._fs
        if not fs.exists(self._p("manifest")):
            return 0
        done = [s.getPath().getName() for s in fs.listStatus(self._p("manifest"))]
        return max((int(n.split(".")[0]) + 1 for n in done if n.endswith(".json")), default=0)

    # ------------------------------------------------------------------ filter

    def _hash(self, seed: int) -> Column:
        # nulls do not change xxhash64, so their places are hashed too
        return F.xxhash64(F.lit(seed), *[F.col(c) for c in self.columns], *[F.col(c).isNull() for c in self.columns])

    def _slice(self) -> Column:
        return F.pmod(self._hash(1), F.lit(SLICES)).cast("int")

    def _bits(self) -> list[Column]:
        """The two bits of each word, as masks."""
        h = self._hash(3)
        one = F.lit(1).cast("long")

        def bit(n: int) -> Column:
            return F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * n).bitwiseAND(F.lit(63)).cast("int"))
        return [bit(2 * w).bitwiseOR(bit(2 * w + 1)).alias(name) for w, name in enumerate(WORDS)]

    def _block(self, blocks: int) -> Column:
        return F.pmod(self._hash(2), F.lit(blocks).cast("long"))

    # ------------------------------------------------------------------ write

    def load(self, rows: DataFrame) -> None:
        """Add rows (distinct ones) as a load."""
        version, known = self._version(), self.loads()
        known = known + self._written(rows.select(*self.columns).distinct())
        if len(known) > self.every:
            known = self._written(self._read(known).distinct())
        self._publish(known, version)

    def _written(self, rows: DataFrame) -> list[dict]:
        folder = f"loads/{uuid.uuid4().hex[:12]}"
        # a slice is written by several tasks where there are more tasks than slices
        spread = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // SLICES)
        (rows.withColumn("__slice", self._slice()).repartition("__slice", F.pmod(self._hash(4), F.lit(spread)))
         .write.partitionBy("__slice").parquet(f"{self.path}/{folder}/rows"))
        load = {"folder": folder, "blocks": 1, "mark": None}
        stored = self._read([load])
        top = F.max(F.col(self.mark)).cast("string") if self.mark else F.lit(None).cast("string")
        n, mark = stored.agg(F.count("*"), top).first()
        if not n:
            return []
        load["blocks"], load["mark"] = n // PER_BLOCK + 1, mark
        (stored.select(self._block(load["blocks"]).alias("block"), *self._bits()).groupBy("block")
         .agg(*[F.bit_or(w).alias(w) for w in WORDS]).write.parquet(f"{self.path}/{folder}/filter"))
        return [load]

    # ------------------------------------------------------------------ read

    def _read(self, loads: list[dict], slices: list[int] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("__slice", T.IntegerType())])
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{x['folder']}/rows") for x in loads]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        both = reduce(DataFrame.unionByName, parts)
        if slices is not None:
            both = both.where(F.col("__slice").isin(slices))
        return both.select(*self.columns)

    def read(self) -> DataFrame:
        """All loaded rows, distinct."""
        return self._read(self.loads()).distinct()

    def possible(self, rows: DataFrame, loads: list[dict] | None = None) -> DataFrame:
        """``rows`` with ``__hit``: true where a filter cannot rule out that the row was loaded."""
        out = rows.withColumn("__hit", F.lit(False))
        for load in self.loads() if loads is None else loads:
            words = self.spark.read.parquet(f"{self.path}/{load['folder']}/filter").toDF("__block", *[f"__{w}" for w in WORDS])
            ask = F.lit(True)
            if load["mark"] is not None:  # rows above the high-water mark are new without a probe
                ask = ~F.coalesce(F.col(self.mark) > F.lit(load["mark"]).cast(self.schema[self.mark].dataType), F.lit(False))
            # rows that need no probe get keys of their own below 0, spread like the others
            key = F.when(ask & ~F.col("__hit"), self._block(load["blocks"])).otherwise(-1 - self._block(1 << 40))
            met = out.withColumn("__key", key).join(words, F.col("__key") == F.col("__block"), "left")
            inside = reduce(Column.__and__, [
                F.col(f"__{w}").bitwiseAND(bits) == bits for w, bits in zip(WORDS, self._bits())])
            out = met.withColumn("__hit", F.col("__hit") | F.coalesce(inside, F.lit(False))).select(*rows.columns, "__hit")
        return out

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """Distinct rows that were never loaded (``EXCEPT``)."""
        loads = self.loads()
        rows = rows.select(*self.columns).distinct()
        if not loads:
            return rows
        probed = work_dir(self.spark, "probed")
        marked = self.possible(rows, loads).withColumn("__slice", F.when(F.col("__hit"), self._slice()))
        marked.write.parquet(probed)
        marked = self.spark.read.schema(marked.schema).parquet(probed)
        fresh = marked.where(~F.col("__hit")).select(*self.columns)
        hit = [r[0] for r in marked.where("__hit").select("__slice").distinct().collect()]  # at most SLICES numbers
        if not hit:
            return fresh
        maybe = marked.where("__hit").select(*self.columns).alias("n")
        old = self._read(loads, sorted(hit)).alias("o")
        same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in self.columns])
        return fresh.unionByName(maybe.join(old, same, "left_anti"))
