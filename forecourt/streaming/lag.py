"""Lag percentiles of an event stream, by event-time window.

A window holds a histogram of the lags with buckets that grow by a fixed ratio, so
any percentile is known within ``ERROR`` of its value.  Histograms are counts by
(window, bucket): Spark keeps them as the state of a windowed aggregation with a
watermark, they merge by adding up, and a busy window is never gathered in one
task.  Each micro-batch writes the counts that it changed; as counts only grow, the
last word on a bucket is the greatest, also after a replayed batch.  Events behind the
watermark are not counted here; the main stream quarantines them.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.streaming import telematics as TM

# ---------------------------------------------------------------- FIXED VALUES
ERROR = 0.01  # relative
WINDOW = "1 day"
ZERO = -(1 << 30)  # the bucket of events that arrive at once (or before their time)
# ------------------------------------------------------------ END FIXED VALUES

_RATIO = (1 + ERROR) / (1 - ERROR)


def bucket_of(lag: Column) -> Column:
    """Lags in (ratio ^ (b - 1), ratio ^ b] are in bucket b."""
    return F.when(lag <= 0, F.lit(ZERO)).otherwise(F.ceil(F.log(lag) / F.lit(math.log(_RATIO))).cast("int"))


def value_of(bucket: Column) -> Column:
    """Within ``ERROR`` of every lag of a bucket."""
    return F.when(bucket == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(_RATIO), bucket) * F.lit(2 / (_RATIO + 1)))


def histogram(events: DataFrame) -> DataFrame:
    """(start, bucket, n) of events with a time and an arrival; a stream or a batch."""
    seen = events.where(F.col("event_ts").isNotNull() & F.col("ingest_lag_sec").isNotNull())
    if events.isStreaming:
        seen = seen.withWatermark("event_ts", f"{TM.LATE_DAYS} days")
    return seen.groupBy(F.window("event_ts", WINDOW), bucket_of(F.col("ingest_lag_sec")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "bucket", "n")


def start(spark: SparkSession, source: str, out_dir: str, checkpoint: str, fmt: str = "json", max_files_per_trigger: int | None = None):
    """Keep the histograms of a folder of events; returns the StreamingQuery."""
    counts = histogram(TM.clean_events(TM.read_stream(spark, source, fmt, max_files_per_trigger)))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    return (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
            .trigger(availableNow=True).start())


def stored(spark: SparkSession, out_dir: str) -> DataFrame:
    """(start, bucket, n) as of the last batch."""
    rows = spark.read.schema("start timestamp, bucket int, n long").parquet(os.path.join(out_dir, "batch=*"))
    return rows.groupBy("start", "bucket").agg(F.max("n").alias("n"))


def percentiles(counts: DataFrame, percents: list[int]) -> DataFrame:
    """(start, n, p<percent>...) of histograms: the smallest lag that so many percent reach, within ``ERROR``.
    A window has as many rows as its lags have buckets."""
    by_size = Window.partitionBy("start").orderBy("bucket")
    whole = Window.partitionBy("start")
    ranked = counts.select("start", value_of(F.col("bucket")).alias("lag"), F.sum("n").over(by_size).alias("upto"),
                           F.sum("n").over(whole).alias("all"))
    return ranked.groupBy("start").agg(F.max("all").alias("n"), *[
        F.min(F.when(F.col("upto") * 100 >= F.col("all") * p, F.col("lag"))).alias(f"p{p}") for p in percents])
