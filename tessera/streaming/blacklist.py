"""Ad-click black list as a stream of DataFrame batches.

Rule, per micro-batch, for every user not black-listed when the batch
starts: count the batch's clicks per (day, ad).  A (day, ad) count of at
least ``threshold`` black-lists the user and is not added to the running
count; otherwise it is added, and a running count reaching ``threshold``
black-lists the user.  The whole batch is judged with the flag as it was at
the batch start.  Rows of users already black-listed are dropped.

The tables live in files, written per batch id under one folder:

* ``counts/batch_id=N/dt=D``: all running counts of the days that batch N
  touched; a day's newest batch holds its current counts,
* ``black/batch_id=N``: the users that batch N listed,
* ``late/batch_id=N``: the newest click time so far and the clicks dropped.

A batch reads what earlier batches wrote (and only the days it touches) and
overwrites its own folders, so a retried batch replaces its own output.
Everything is joins and partial aggregates: a hot user's clicks are counted
in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: clicks per (day, user, ad) that black-list a user.
THRESHOLD = 30

COUNTS = "userid long, adid long, count long, batch_id int, dt string"
BLACK = "userid long, batch_id int"
LATE = "newest timestamp, dropped long, batch_id int"


def _table(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The batches' rows under ``path`` (those before a batch id); empty if none was written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return df if before is None else df.where(F.col("batch_id") < before)


def _current(counts: DataFrame) -> DataFrame:
    """Each day's counts as its newest batch wrote them."""
    newest = counts.groupBy("dt").agg(F.max("batch_id").alias("batch_id"))
    return counts.join(newest, ["dt", "batch_id"]).select("dt", "userid", "adid", "count")


def blacklist_sink(out: str, threshold: int = THRESHOLD, lateness: str | None = None
                   ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over clicks (ts, user, day, ad).

    By default every click counts, however late.  With ``lateness`` (an
    interval) clicks older than the newest click of the earlier batches by
    more than that are dropped, and their number is kept in ``late``."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession

        def save(rows: DataFrame, name: str, *by: str) -> None:
            rows.write.mode("overwrite").partitionBy(*by).parquet(f"{out}/{name}/batch_id={batch_id}")

        clicks = df.select("ts", "user", "day", "ad")
        if lateness is not None:
            newest = _table(spark, f"{out}/late", LATE, batch_id).agg(F.max("newest").alias("newest")).first()["newest"]
            late = F.lit(False) if newest is None else F.col("ts") < F.lit(newest) - F.expr(f"INTERVAL {lateness}")
            save(clicks.agg(F.greatest(F.max("ts"), F.lit(newest).cast("timestamp")).alias("newest"),
                            F.count_if(late).alias("dropped")), "late")
            clicks = clicks.where(~late)
        black = _table(spark, f"{out}/black", BLACK, batch_id).select("userid")
        live = (clicks.groupBy(F.col("day").alias("dt"), F.col("user").alias("userid"), F.col("ad").alias("adid"))
                .agg(F.count(F.lit(1)).alias("count")).join(black, "userid", "left_anti").persist())
        try:
            added = live.where(F.col("count") < threshold).select("dt", "userid", "adid", "count")
            days = added.select("dt").distinct()
            before = _current(_table(spark, f"{out}/counts", COUNTS, batch_id)).join(days, "dt", "left_semi")
            save(before.unionByName(added).groupBy("dt", "userid", "adid").agg(F.sum("count").alias("count")),
                 "counts", "dt")
            mine = _table(spark, f"{out}/counts", COUNTS).where(F.col("batch_id") == batch_id)
            over = live.where(F.col("count") >= threshold).select("userid").unionByName(
                mine.where(F.col("count") >= threshold).select("userid"))
            save(over.distinct().join(black, "userid", "left_anti"), "black")
        finally:
            live.unpersist()
    return write


def sql_blacklist(clicks_with_batch: str, threshold: int = THRESHOLD) -> dict[str, str]:
    """DuckDB twin over a relation with (batch, day, "user", ad) rows.

    The flag is monotone, so a user's first black-listing batch b0 is the
    first batch where a (day, ad) batch count or its running sum of
    admitted counts reaches the threshold; rows after b0 are dropped."""
    t = threshold
    bc = f"SELECT batch, day, \"user\", ad, count(*) AS c FROM {clicks_with_batch} GROUP BY ALL"
    cum = (f"SELECT *, sum(CASE WHEN c < {t} THEN c ELSE 0 END) OVER "
           f"(PARTITION BY \"user\", day, ad ORDER BY batch ROWS UNBOUNDED PRECEDING) AS run FROM bc")
    trig = f"SELECT \"user\", min(batch) AS b0 FROM cum WHERE c >= {t} OR run >= {t} GROUP BY \"user\""
    counts = f"""
      SELECT cum.day AS dt, cum."user" AS userid, cum.ad AS adid,
             CAST(sum(CASE WHEN c < {t} THEN c ELSE 0 END) AS BIGINT) AS count
      FROM cum LEFT JOIN trig ON cum."user" = trig."user"
      WHERE trig.b0 IS NULL OR cum.batch <= trig.b0
      GROUP BY ALL HAVING sum(CASE WHEN c < {t} THEN 1 ELSE 0 END) > 0"""
    return {"bc": bc, "cum": cum, "trig": trig, "counts": counts}


def final_tables(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(user_ad_count, black_list) as the batches written so far leave them."""
    return (_current(_table(spark, f"{out}/counts", COUNTS)),
            _table(spark, f"{out}/black", BLACK).select("userid").distinct())


def dropped_clicks(spark: SparkSession, out: str) -> int:
    """Clicks that ``lateness`` has dropped so far."""
    return _table(spark, f"{out}/late", LATE).agg(F.coalesce(F.sum("dropped"), F.lit(0))).first()[0]


def blacklist_batch(clicks: DataFrame, batch_col: str = "batch",
                    threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The same rule as one batch job over clicks tagged with their batch
    (a backfill, or a cross-check of the stream).

    Clicks are counted per (batch, day, user, ad) with a partial aggregate;
    a running sum of admitted counts per (user, day, ad) over batches (a
    window whose groups hold one row per batch) finds each user's first
    listing batch b0, and only batches up to b0 count.  Returns
    (user_ad_count, black_list) like ``final_tables``."""
    from pyspark.sql import Window
    t = threshold
    bc = clicks.groupBy(batch_col, "day", "user", "ad").agg(F.count(F.lit(1)).alias("c"))
    admitted = F.when(F.col("c") < t, F.col("c")).otherwise(F.lit(0))
    w = Window.partitionBy("user", "day", "ad").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, 0)
    cum = bc.withColumn("run", F.sum(admitted).over(w))
    trig = (cum.where((F.col("c") >= t) | (F.col("run") >= t))
               .groupBy("user").agg(F.min(batch_col).alias("b0")))
    kept = (cum.join(trig, "user", "left")
               .where(F.col("b0").isNull() | (F.col(batch_col) <= F.col("b0"))))
    counts = (kept.groupBy(F.col("day").alias("dt"), F.col("user").alias("userid"), F.col("ad").alias("adid"))
                  .agg(F.sum(admitted).cast("bigint").alias("count"),
                       F.sum(F.when(F.col("c") < t, 1).otherwise(0)).alias("__admitted"))
                  .where(F.col("__admitted") > 0).drop("__admitted"))
    black = trig.select(F.col("user").alias("userid"))
    return counts, black
