"""Queries for the telematics events in batch form: parsing and flags
(P40, P43, P45, P46), fault-code lookup and ingest lag (P47)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.plans import duck_sql as S
from forecourt.plans.registry import register
from forecourt.session import scratch_path
from forecourt.sources import seeds
from forecourt.sources import star_extracts as X
from forecourt.sources.bronze import run_id
from forecourt.sources.tables import Tables
from forecourt.streaming import lag
from forecourt.streaming import telematics as TM

# ---------------------------------------------------------------- FIXED VALUES
SLA_SEC = 15 * 60  # telematics freshness SLA
# ------------------------------------------------------------ END FIXED VALUES


def telematics_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = X.telematics_raw(Tables(spark, sf_dir).events)
    ev = TM.clean_events(raw)
    return ev.join(F.broadcast(seeds.fault_codes(spark)), "fault_code", "left")


@register("telematics_clean", S.with_ctes(["tm", "fault_codes"], """
SELECT tm.event_id, tm.vin, tm.is_vin_valid, tm.event_ts_ntz AS event_ts, tm.odometer_km, tm.fault_code,
       f.fault_description, f.fault_description IS NULL AND tm.fault_code IS NOT NULL AS is_unknown_fault,
       tm.is_out_of_country, tm.ingested_at, tm.ingest_lag_sec, tm.has_parse_error
FROM tm LEFT JOIN fault_codes f USING (fault_code)"""))
def telematics_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payload field, epoch ms -> UTC time, VIN check,
    fault-code description lookup, out-of-country flag (GPS itself not exposed)."""
    ev = telematics_events(spark, sf_dir)
    return ev.select("event_id", "vin", "is_vin_valid", F.col("event_ts_ntz").alias("event_ts"), "odometer_km",
                     "fault_code", "fault_description",
                     (F.col("fault_description").isNull() & F.col("fault_code").isNotNull()).alias("is_unknown_fault"),
                     "is_out_of_country", "ingested_at", "ingest_lag_sec", "has_parse_error")


_LAG_US = "(epoch_us(ingested_at) - epoch_us(event_ts_ntz))"


@register("ingest_lag_daily", S.with_ctes(["tm"], f"""
SELECT date_trunc('day', event_ts_ntz) AS event_day, count(*) AS events,
       max(ingest_lag_sec) AS lag_max_sec, avg({_LAG_US}) AS lag_mean_us,
       count(*) FILTER (WHERE ingest_lag_sec <= 60) AS within_1m,
       count(*) FILTER (WHERE ingest_lag_sec <= {SLA_SEC}) AS within_sla,
       count(*) FILTER (WHERE ingest_lag_sec > {SLA_SEC}) AS over_sla,
       count(*) FILTER (WHERE ingest_lag_sec > 3600) AS over_1h
FROM tm GROUP BY 1"""))
def ingest_lag_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest lag (arrival - event time) per event day against the
    15-minute SLA, as exact bucket counts, max and mean (partial aggregates,
    so a busy day is never gathered in one task)."""
    ev = TM.clean_events(X.telematics_raw(Tables(spark, sf_dir).events))
    day = F.date_trunc("day", F.col("event_ts")).cast("timestamp_ntz")
    lag_us = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("event_ts"))
    sec = F.col("ingest_lag_sec")
    return ev.groupBy(day.alias("event_day")).agg(
        F.count(F.lit(1)).alias("events"), F.max(sec).alias("lag_max_sec"), F.avg(lag_us).alias("lag_mean_us"),
        F.count_if(sec <= 60).alias("within_1m"), F.count_if(sec <= SLA_SEC).alias("within_sla"),
        F.count_if(sec > SLA_SEC).alias("over_sla"), F.count_if(sec > 3600).alias("over_1h"))


@register("ingest_lag_percentiles", S.with_ctes(["tm"], """
SELECT date_trunc('day', event_ts_ntz) AS event_day, count(ingest_lag_sec) AS events,
       quantile_disc(ingest_lag_sec, 0.5) AS lag_p50_sec, quantile_disc(ingest_lag_sec, 0.95) AS lag_p95_sec,
       quantile_disc(ingest_lag_sec, 0.99) AS lag_p99_sec
FROM tm WHERE ingest_lag_sec IS NOT NULL GROUP BY 1"""))
def ingest_lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact p50 / p95 / p99 ingest lag per event day.

    Events are counted per distinct (day, lag); the smallest lag whose running
    count reaches the share is the percentile.  The window runs over distinct
    lags, so a busy day costs no more than its lags differ."""
    ev = TM.clean_events(X.telematics_raw(Tables(spark, sf_dir).events)).where(F.col("ingest_lag_sec").isNotNull())
    day = F.date_trunc("day", F.col("event_ts")).cast("timestamp_ntz")
    counts = ev.groupBy(day.alias("event_day"), F.col("ingest_lag_sec").alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("event_day").orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("event_day", "lag", "n", F.sum("n").over(up_to).alias("reached"),
                           F.sum("n").over(Window.partitionBy("event_day")).alias("events"))

    def percentile(percent: int):
        return F.min(F.when(F.col("reached") * 100 >= F.col("events") * percent, F.col("lag")))

    return ranked.groupBy("event_day").agg(
        F.sum("n").alias("events"), percentile(50).alias("lag_p50_sec"), percentile(95).alias("lag_p95_sec"),
        percentile(99).alias("lag_p99_sec"))


# ----------------------------------------------------------------- P40-P44
@register("telematics_stream", S.with_ctes(["tm", "fault_codes"], """
, ok AS (SELECT * FROM tm WHERE event_id IS NOT NULL AND event_ts_ntz IS NOT NULL AND NOT has_parse_error),
r AS (SELECT *, max(odometer_km) OVER (PARTITION BY vin ORDER BY event_ts_ntz, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
      FROM ok WHERE is_vin_valid),
late AS (SELECT count(*) AS n FROM ok WHERE CAST(regexp_extract(event_id, '[0-9]+') AS BIGINT) % 3 = 0
         AND event_ts_ntz < (SELECT max(event_ts_ntz) FROM ok) - INTERVAL 3 DAY)
SELECT event_id, vin, odometer_km, CAST(CAST(event_ts_ntz AS DATE) AS VARCHAR) AS event_day, fault_description, late.n AS late_redeliveries
FROM r LEFT JOIN fault_codes USING (fault_code), late WHERE odometer_km IS NULL OR top IS NULL OR odometer_km >= top"""))
def telematics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P40-P45 as a stream over JSON files: all events, then, after a restart from the
    checkpoint, a third of them once more (dropped inside the 3-day window, quarantined as
    late behind it); the loaded events read from compacted days and deltas."""
    root = scratch_path(spark, f"stream/{run_id()}")
    raw = X.telematics_raw(Tables(spark, sf_dir).events)
    again = F.regexp_extract("event_id", "[0-9]+", 0).cast("bigint") % 3 == 0
    for delivery in (raw, raw.where(again)):
        delivery.write.mode("append").json(f"{root}/in")
        query = TM.start(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
        if TM.read_days(spark, f"{root}/out") is not None:
            TM.compact_days(spark, f"{root}/out")
    late = spark.read.schema("event_id string").parquet(f"{root}/out/quarantine_late").agg(F.count(F.lit(1)).alias("late_redeliveries"))
    loaded = TM.read_days(spark, f"{root}/out").select("event_id", "vin", "odometer_km", F.col("event_date").cast("string").alias("event_day"),
                                                       "fault_description")
    return loaded.withColumn("late_redeliveries", F.lit(late.first()[0]).cast("bigint"))


@register("ingest_lag_stream", S.with_ctes(["tm"], """
SELECT date_trunc('day', event_ts_ntz) AS event_day, count(*) AS events, true AS p50_within, true AS p95_within, true AS p99_within
FROM tm WHERE ingest_lag_sec IS NOT NULL GROUP BY 1"""))
def ingest_lag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P47 as a stream over JSON files: events per day, and whether the percentiles of the
    day's histogram are within the stated error of the exact ones."""
    root = scratch_path(spark, f"stream/{run_id()}")
    X.telematics_raw(Tables(spark, sf_dir).events).write.json(f"{root}/in")
    lag.start(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    found = lag.percentiles(lag.stored(spark, f"{root}/out"), [50, 95, 99]).withColumn("event_day", F.col("start").cast("timestamp_ntz"))
    both = found.join(ingest_lag_percentiles(spark, sf_dir).drop("events"), "event_day")
    within = lambda p: (F.abs(F.col(f"p{p}") - F.col(f"lag_p{p}_sec")) <= 1.001 * lag.ERROR * F.col(f"lag_p{p}_sec"))
    return both.select("event_day", F.col("n").alias("events"), *[within(p).alias(f"p{p}_within") for p in (50, 95, 99)])
