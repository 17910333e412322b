"""The ad-click streaming jobs, ready to start on any message stream.

``lines`` is a streaming DataFrame with a ``value`` column holding
``epoch_ms area city user ad`` messages (Kafka values via
``sources.kafka_stream``, or files via ``sources.file_drop_stream``).
Each job writes per-batch output with the idempotent ``batch_sink`` and
keeps its progress and state in ``checkpoint``; the ``*_tables`` helpers
read the current result tables back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.streaming import blacklist as bl
from tessera.streaming import operators as so
from tessera.streaming.replay import batch_sink, latest, window_bounds

# Batch interval, chart bucket / window / slide of the original jobs.
TRIGGER = "3 seconds"
CHART_BUCKET_SECONDS = 10
CHART_WINDOW = "60 seconds"
CHART_SLIDE = "10 seconds"


def _start(df: DataFrame, mode: str, out: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).foreachBatch(batch_sink(out)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": TRIGGER})).start()


def start_blacklist(lines: DataFrame, out: str, checkpoint: str, threshold: int = bl.THRESHOLD,
                    trigger: dict | None = None, lateness: str | None = None) -> StreamingQuery:
    """Black list + per (day, user, ad) counts.  Every click counts unless
    ``lateness`` is given (see ``blacklist.blacklist_sink``)."""
    clicks = so.parse_clicks(lines)
    w = clicks.writeStream.foreachBatch(bl.blacklist_sink(out, threshold, lateness)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": TRIGGER})).start()


def blacklist_tables(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(user_ad_count, black_list) as of the last finished batch."""
    return bl.final_tables(spark, out)


def start_area_city_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                           lateness: str | None = None) -> StreamingQuery:
    """Running clicks per (day, area, city, ad); ``lateness`` bounds the state."""
    counts = so.running_count(so.parse_clicks(lines), ["day", "area", "city", "ad"], ts="ts", lateness=lateness)
    return _start(counts, "update", out, checkpoint, trigger)


def area_city_table(spark: SparkSession, out: str) -> DataFrame:
    return latest(spark.read.parquet(out), ["day", "area", "city", "ad"])


def start_last_window_chart(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                            bucket_seconds: int = CHART_BUCKET_SECONDS, window: str = CHART_WINDOW,
                            slide: str = CHART_SLIDE) -> StreamingQuery:
    """Clicks per bucket over the last window, every slide (event time)."""
    b = so.parse_clicks(lines).select(so.bucket_time("ts", bucket_seconds, "bucket"))
    b = b.withWatermark("bucket", window).withColumn("xtime", F.date_format("bucket", "mm:ss"))
    agg = b.groupBy(F.window("bucket", window, slide).alias("window"), "xtime").agg(
        F.count(F.lit(1)).alias("clicks"))
    return _start(agg.select(*window_bounds(), "xtime", "clicks"), "update", out, checkpoint, trigger)


def chart_table(spark: SparkSession, out: str) -> DataFrame:
    """One JSON chart per window: [{xtime, yval}] sorted by time (at most
    window/bucket entries per window, a fixed bound)."""
    cur = latest(spark.read.parquet(out), ["window_start", "window_end", "xtime"])
    item = F.struct("xtime", F.col("clicks").cast("string").alias("yval"))
    return cur.groupBy("window_start").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("chart"))
