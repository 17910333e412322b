"""Stream-stream join per hour window whose hot users are found while the stream runs.

Two queries follow each other.  ``Router.route`` (a ``foreachBatch`` function) keeps a
summary of the users' recent clicks, salts each row by what earlier batches have shown, and
publishes the salted rows of the batch as one folder; the join is a plain stream-stream join
over these folders, with the salt in its key.

The summary is the counter form of the heavy-hitter sketch: the counts of a batch are added
to those kept, and the ``capacity + 1``-th largest is taken off all of them, so that at most
``capacity`` rows stay and a count is short by at most ``weight / (capacity + 1)``.  A user
whose count may exceed ``share`` of all weight is hot: none is missed, none below half of it
is taken.  ``decay`` scales what earlier batches have added, so a user turns hot, and cool,
in mid-stream.

Both sides of a window must agree on its salts.  A user that turns hot is therefore salted
from the first window that no row has reached yet, and one that turns cool until such a
window.  Every row of one (user, window) then sees the same entry, whatever batch it comes
in, so each pair meets exactly once.  Entries that ended before the watermark are dropped:
the table, which is broadcast, holds at most ``capacity`` open entries and those that ended
within ``lateness``.

Rows without a user or a time link with nothing; they are routed and joined away.  A batch
that is retried writes the same summary; its folder, once published, stays as it is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_S = 3600
SUMMARY = "user_id long, weight double, start_us long, end_us long, total double, reached_us long"


def window_us(ts: Column | str) -> Column:
    """Start of the hour window in microseconds."""
    us = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return us - F.pmod(us, F.lit(WINDOW_S * 1_000_000))


class Router:
    """Salts the rows (user_id, event_id, event_type, ts) of a stream into ``path``/salted."""

    def __init__(self, spark: SparkSession, path: str, salts: int = 8, share: float = 0.05,
                 decay: float = 0.5, lateness_s: int = WINDOW_S):
        self.spark, self.path = spark, path.rstrip("/")
        self.salts, self.share, self.decay, self.lateness_us = salts, share, decay, lateness_s * 1_000_000
        self.capacity = math.ceil(2 / share)

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._p("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ summary

    def summary(self, batch_id: int) -> DataFrame:
        """What batches up to ``batch_id`` have left: one row per user kept or still salted,
        and one with a null user for the weight and the last window of all rows."""
        if batch_id < 0:
            return self.spark.createDataFrame([], SUMMARY)
        return self.spark.read.schema(SUMMARY).parquet(f"{self.path}/summary/{batch_id:012d}")

    def _summarise(self, rows: DataFrame, batch_id: int) -> None:
        before = self.summary(batch_id - 1)
        clicks = (rows.where("event_type = 'click' and user_id is not null").groupBy("user_id")
                  .agg(F.count("*").cast("double").alias("weight")))
        old = before.where("user_id is not null and weight > 0").select("user_id", (F.col("weight") * self.decay).alias("weight"))
        counts = clicks.unionByName(old).groupBy("user_id").agg(F.sum("weight").alias("weight"))
        # capacity + 1 rows, whatever the input: the least of them is taken off all
        top = counts.orderBy(F.desc("weight"), "user_id").limit(self.capacity + 1).collect()
        cut = top[-1].weight if len(top) > self.capacity else 0.0
        now = rows.agg(F.count(F.when((F.col("event_type") == "click") & F.col("user_id").isNotNull(), 1)).alias("n"),
                       F.max(window_us("ts")).alias("reached")).first()
        old_rows = before.collect()  # at most the entries named above
        head = next((r for r in old_rows if r.user_id is None), None)
        total = now.n + (head.total * self.decay if head else 0.0)
        known = [w for w in (now.reached, head.reached_us if head else None) if w is not None]
        reached = max(known) if known else None
        unseen = reached + WINDOW_S * 1_000_000 if reached is not None else None
        weight = {r.user_id: r.weight - cut for r in top if r.weight > cut}
        hot = {u for u, w in weight.items() if w > total * (self.share - 1 / (self.capacity + 1))}
        entries, open_now = [], set()
        for r in old_rows:
            if r.user_id is None or r.start_us is None:
                continue
            end = r.end_us
            if end is None and r.user_id not in hot:
                end = unseen
            if end is None:
                open_now.add(r.user_id)
            if end is None or reached is None or end > reached - self.lateness_us:
                entries.append((r.user_id, r.start_us, end))
        if unseen is not None:
            entries += [(u, unseen, None) for u in sorted(hot - open_now)]
        # one row per user and entry; the weight stands once per user
        out, named = [(None, 0.0, None, None, total, reached)], set()
        for user, start, end in entries:
            out.append((user, 0.0 if user in named else weight.get(user, 0.0), start, end, None, None))
            named.add(user)
        out += [(u, w, None, None, None, None) for u, w in weight.items() if u not in named]
        self.spark.createDataFrame(out, SUMMARY).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/summary/{batch_id:012d}")

    # ------------------------------------------------------------------ rows

    def salted(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows with ``salt``: a click of a hot user and window has one of ``salts``, a purchase all."""
        hot = self.summary(batch_id - 1).where("start_us is not null").select(
            F.col("user_id").alias("__user"), "start_us", "end_us")
        w = window_us("ts")
        met = rows.join(F.broadcast(hot), (F.col("user_id") == F.col("__user")) & (w >= F.col("start_us"))
                        & (F.col("end_us").isNull() | (w < F.col("end_us"))), "left")
        one = F.pmod(F.xxhash64("event_id"), F.lit(self.salts)).cast("int")
        salts = (F.when(F.col("__user").isNull(), F.array(F.lit(0)))
                 .when(F.col("event_type") == "purchase", F.sequence(F.lit(0), F.lit(self.salts - 1)))
                 .otherwise(F.array(one)))
        return met.select(*rows.columns, F.explode(salts).alias("salt"))

    def route(self, rows: DataFrame, batch_id: int) -> None:
        """foreachBatch function: publish the salted rows of a batch, and the summary for the next."""
        rows = rows.select("user_id", "event_id", "event_type", "ts")
        fs, target = self._fs, f"salted/part{batch_id:012d}"
        if fs.exists(self._p(target)):
            return  # a retry of a batch that was published
        self._summarise(rows, batch_id)
        wanted = rows.where(F.col("event_type").isin("click", "purchase"))
        self.salted(wanted, batch_id).write.mode("overwrite").parquet(f"{self.path}/aside/{batch_id}")
        fs.mkdirs(self._p("salted"))
        if not fs.rename(self._p(f"aside/{batch_id}"), self._p(target)):
            raise OSError(f"{self.path}/{target} could not be published")
        if batch_id > 1:  # the next batch needs this summary, a retry of it the one before
            fs.delete(self._p(f"summary/{batch_id - 2:012d}"), True)

    def stream(self) -> DataFrame:
        """The published rows as a stream."""
        return self.spark.readStream.schema("user_id long, event_id long, event_type string, ts timestamp, salt int").parquet(
            f"{self.path}/salted/*")


def pairs(salted: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """(user_id, window_start, click_id, purchase_id): clicks and purchases of a user in the same hour."""
    def side(kind: str, name: str) -> DataFrame:
        x = salted.where(F.col("event_type") == kind).withWatermark("ts", lateness)
        return x.select(F.col("user_id").alias(f"{name}_user"), F.col("event_id").alias(name),
                        F.window("ts", "1 hour").alias(f"{name}_w"), F.col("salt").alias(f"{name}_salt"))
    j = side("click", "click_id").join(
        side("purchase", "purchase_id"),
        (F.col("click_id_user") == F.col("purchase_id_user")) & (F.col("click_id_w") == F.col("purchase_id_w"))
        & (F.col("click_id_salt") == F.col("purchase_id_salt")))
    return j.select(F.col("click_id_user").alias("user_id"),
                    F.date_format(F.col("click_id_w").start, "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "click_id", "purchase_id")
